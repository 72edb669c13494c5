"""Facets, terms and suggestions over the indexed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.analysis import analyze_keyword, analyze_standard, tokens as token_rows
from shelfmark.functions.distance import edit_distance
from shelfmark.operators import completions, facets as fa
from shelfmark.operators import suggest as su
from shelfmark.operators import terms as te
from shelfmark.operators.predicates import P, condition
from shelfmark.operators.search import term_search
from shelfmark.plans import corpora
from shelfmark.plans.corpora import documents, parts, talks
from shelfmark.plans.sql import (
    DICTIONARY,
    SPLIT,
    STOP_LIST,
    VALUES,
    ranked,
    term_hits,
    tokens,
    top_facets,
)

FACET = ("field", "value", "count", "rank")


def facets(spark, sf_dir):
    return fa.facets(documents(spark, sf_dir), "lang,source,quality").select(*FACET)


def facets_one_index(spark, sf_dir):
    return fa.facets(documents(spark, sf_dir, "docs-fr"), ["source", "fulltext"], 5).select(*FACET)


def facets_for_query(spark, sf_dir):
    idx = documents(spark, sf_dir)
    return fa.facets(idx, "lang,source", base=condition(idx, "fulltext:from")).select(*FACET)


def facets_multi_index(spark, sf_dir):
    idx = documents(spark, sf_dir, "docs-en,docs-de")
    return fa.facets(idx, "source,toxic", 7, P.term("fulltext", "er")).select(*FACET)


def facets_all_fields(spark, sf_dir):
    idx = documents(spark, sf_dir, "docs-en")
    return fa.facets(idx, None, base=P.term("fulltext", "th")).select(*FACET)


def facets_repeated_field(spark, sf_dir):
    return fa.facets(talks(spark, sf_dir), "role", base=P.term("text", "la")).select(*FACET)


def facets_grouping_sets(spark, sf_dir):
    docs = corpora.document_docs(spark, sf_dir)
    return fa.wide_facets(docs, ["lang", "source"]).select(*FACET)


def facet_semi_join(spark, sf_dir):
    idx = documents(spark, sf_dir)
    matched = P.term("fulltext", "from").hits(idx, scored=False)
    return fa.facet_semi_join(idx, matched, ["source"])


def facet_top_n(spark, sf_dir):
    idx = documents(spark, sf_dir)
    return fa.facet_top_n(fa.facet_counts(idx, ["source", "n_chars"]), 3).select(*FACET)


def search_with_facets(spark, sf_dir):
    return fa.search_with_facets(
        documents(spark, sf_dir), P.term("fulltext", "from"), "lang,source", 5
    )


def index_terms(spark, sf_dir):
    return te.index_terms(documents(spark, sf_dir, "docs-en"), "fulltext")


def index_terms_multi(spark, sf_dir):
    return te.index_terms(documents(spark, sf_dir, "docs-en,docs-fr"), "fulltext")


def top_terms(spark, sf_dir):
    return te.top_terms(te._added_up(documents(spark, sf_dir).dictionary.where("field = 'fulltext'")))


def fuzzy_terms(spark, sf_dir):
    return te.fuzzy_terms(documents(spark, sf_dir, lookups=True), "eriner", "fulltext")


def prefix_terms(spark, sf_dir):
    return te.prefix_terms(documents(spark, sf_dir), "fro", "fulltext")


def similar_terms(spark, sf_dir):
    return te.similar_terms(parts(spark, sf_dir, lookups=True), "widge", "title,type")


def similar_terms_text(spark, sf_dir):
    return te.similar_terms(documents(spark, sf_dir, lookups=True), "thanea")


def edit_distances(spark, sf_dir):
    """Distance of every distinct word of the part names to a misspelt one."""
    rows = parts(spark, sf_dir).dictionary.where("field = 'title'")
    return rows.select("term", edit_distance(F.col("term"), F.lit("gimzo")).alias("edits"))


def analyze_standard_(spark, sf_dir):
    docs = corpora.spread(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_rows(docs, "text", analyze_standard)


def analyze_keyword_(spark, sf_dir):
    docs = corpora.table(spark, sf_dir, "documents").select("doc_id", "source")
    return token_rows(docs, "source", analyze_keyword)


def custom_analyzer(spark, sf_dir):
    """An analyzer of one's own: words of four letters or more, cut to their first six."""

    def stems(text):
        return F.transform(
            F.split(F.lower(text), r"[^\p{L}]+"),
            lambda w: F.when(F.length(w) >= 4, F.substring(w, 1, 6)),
        )

    docs = corpora.spread(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return (
        token_rows(docs, "text", stems)
        .groupBy("term")
        .agg(F.count("*").alias("uses"))
    )


SUGGESTION = ("rank", "text", "highlight", "weight")


def suggest_terms(spark, sf_dir):
    return su.suggest(
        documents(spark, sf_dir), "Fro", "fulltext", use_terms=True, results=10
    ).select(*SUGGESTION)


def suggest_documents(spark, sf_dir):
    found = su.suggest(
        parts(spark, sf_dir), "RI", "title", return_fields="brand,type", results=10
    )
    return found.select(*SUGGESTION, "doc_id", "field", "value")


def suggest_two_words(spark, sf_dir):
    return su.suggest(parts(spark, sf_dir), "wid re", "title").select(*SUGGESTION, "doc_id")


def suggest_weighted(spark, sf_dir):
    return su.suggest(
        parts(spark, sf_dir), "sm", "title,type", weights="title:1.5,broken,type:3"
    ).select(*SUGGESTION, "doc_id")


def suggest_min_chars(spark, sf_dir):
    """One letter is too short to complete, two are enough."""
    idx = parts(spark, sf_dir)
    short, enough = su.suggest(idx, "r", "title"), su.suggest(idx, "re", "title")
    return short.unionByName(enough).select(*SUGGESTION)


def suggestion_dedupe(spark, sf_dir):
    return su.suggestion_dedupe(
        su.value_candidates(parts(spark, sf_dir), ["title"], {})
    ).select("text", "weight", "doc_id")


def suggestion_documents(spark, sf_dir):
    idx = parts(spark, sf_dir)
    top = su.top_suggestions(
        su.suggestion_dedupe(su.value_candidates(idx, ["title"], {"title": 2.0})), 15
    )
    return su.suggestion_documents(top, idx, ["brand", "size"]).select(
        "rank", "text", "doc_id", "field", "ord", "value"
    )


def top_suggestions(spark, sf_dir):
    idx = documents(spark, sf_dir)
    return su.top_suggestions(su.term_candidates(idx, ["source"], {"source": 0.5})).select(
        "rank", "text", "weight"
    )


def build_suggester(spark, sf_dir):
    """The rows of a named suggester, written once per state of its index and read back."""
    idx = parts(spark, sf_dir)
    suggester = corpora.PARTS.suggester("names")
    rows = su.ensure_suggester(
        spark, corpora.PART_CORPUS.folder(spark, sf_dir) + "-suggest", idx, suggester
    )
    return rows.select("index_name", "suggester", "text", "weight", "doc_id")


def suggest_named(spark, sf_dir):
    idx = parts(spark, sf_dir)
    suggester = corpora.PARTS.suggester("names")
    rows = su.ensure_suggester(
        spark, corpora.PART_CORPUS.folder(spark, sf_dir) + "-suggest", idx, suggester
    )
    return su.use_suggester(idx, rows, suggester, "e").unionByName(
        su.use_suggester(idx, rows, suggester, "ec")
    ).select(*SUGGESTION, "doc_id", "field", "value")


def _completed(spark, sf_dir, *typed):
    """What is typed one after the other, completed from the tables of the parts' suggester."""
    idx = parts(spark, sf_dir)
    suggester = corpora.PARTS.suggester("names")
    folder = corpora.PART_CORPUS.folder(spark, sf_dir) + "-completions"
    found = completions.ensure_completions(spark, folder, idx, suggester)
    return [completions.complete(idx, found, suggester, t) for t in typed]


def complete_short(spark, sf_dir):
    """A beginning of two letters, from its heaviest texts."""
    (found,) = _completed(spark, sf_dir, "ec")
    return found.select(*SUGGESTION, "doc_id", "field", "value")


def complete_words(spark, sf_dir):
    """Several words and longer ones, from the words of the texts."""
    two, long = _completed(spark, sf_dir, "wid re", "econo")
    return two.unionByName(long).where("field IS NULL").select(*SUGGESTION, "doc_id")


def completion_starts(spark, sf_dir):
    """The heaviest titles and types of every beginning of up to four letters, three of each."""
    idx = parts(spark, sf_dir)
    rows = su.build_suggester(idx, corpora.PARTS.suggester("names"))
    return completions.heaviest(completions.by_word(rows), kept=3)


def result_suggestions(spark, sf_dir):
    return su.result_suggestions(
        documents(spark, sf_dir), "fro tionh", "fulltext", "lang:fr"
    ).select("rank", "index_name", "doc_id", "score")


def return_fields(spark, sf_dir):
    idx = documents(spark, sf_dir)
    page = term_search(idx, "fulltext", "from")
    return su.return_fields(page, idx.fields, ["source", "quality", "nothing"]).select(
        "rank", "doc_id", "field", "ord", "value"
    )


QUERIES = {
    "facets": facets,
    "facets_one_index": facets_one_index,
    "facets_for_query": facets_for_query,
    "facets_multi_index": facets_multi_index,
    "facets_all_fields": facets_all_fields,
    "facets_repeated_field": facets_repeated_field,
    "facets_grouping_sets": facets_grouping_sets,
    "facet_semi_join": facet_semi_join,
    "facet_top_n": facet_top_n,
    "search_with_facets": search_with_facets,
    "index_terms": index_terms,
    "index_terms_multi": index_terms_multi,
    "top_terms": top_terms,
    "fuzzy_terms": fuzzy_terms,
    "prefix_terms": prefix_terms,
    "similar_terms": similar_terms,
    "similar_terms_text": similar_terms_text,
    "edit_distance": edit_distances,
    "analyze_standard": analyze_standard_,
    "analyze_keyword": analyze_keyword_,
    "custom_analyzer": custom_analyzer,
    "suggest_terms": suggest_terms,
    "suggest_documents": suggest_documents,
    "suggest_two_words": suggest_two_words,
    "suggest_weighted": suggest_weighted,
    "suggest_min_chars": suggest_min_chars,
    "suggestion_dedupe": suggestion_dedupe,
    "suggestion_documents": suggestion_documents,
    "top_suggestions": top_suggestions,
    "build_suggester": build_suggester,
    "suggest_named": suggest_named,
    "complete_short": complete_short,
    "complete_words": complete_words,
    "completion_starts": completion_starts,
    "result_suggestions": result_suggestions,
    "return_fields": return_fields,
}


def _counted(fields: str, where: str = "TRUE", join: str = "") -> str:
    return (
        f"c AS (SELECT field, value, count(DISTINCT (index_name, doc_id)) AS \"count\""
        f" FROM present {join} WHERE field IN ({fields}) AND {where} GROUP BY ALL)"
    )


_TITLE_WORDS = tokens("SELECT 'parts' AS index_name, p_partkey AS doc_id, p_name AS text FROM part")
_TYPE_WORDS = tokens("SELECT 'parts' AS index_name, p_partkey AS doc_id, p_type AS text FROM part")
_TALK_WORDS = tokens("SELECT 'talks' AS index_name, conv_id AS doc_id, text FROM conversations")
_NAMES = "'lang', 'source', 'quality'"
_LONG = "'source', 'n_chars'"
# DuckDB counts bytes. A letter outside ASCII never equals one of the plain word asked for, so a
# one-byte stand-in keeps distances in letters.
_LETTERS = r"regexp_replace(term, '[^\x00-\x7F]', '~', 'g')"
_NEAR = f"damerau_levenshtein({_LETTERS}, 'eriner') <= 2"
_BEGINS = "starts_with(term, 'fro')"
_DF = "SELECT field, term, CAST(sum(doc_freq) AS BIGINT) AS doc_freq FROM dict"


def _top(where: str) -> str:
    return f"{_DF} WHERE {where} GROUP BY ALL ORDER BY doc_freq DESC, term LIMIT 20"


def _suggestions(candidates: str, n: int = 10, more: str = "") -> str:
    """Best suggestions of a CTE (text, highlight, weight, …)."""
    return f"""SELECT CAST(row_number() OVER (ORDER BY weight DESC, text) AS INTEGER) AS rank,
text, highlight, weight{more} FROM {candidates} ORDER BY weight DESC, text LIMIT {n}"""


def _marked(words: str) -> str:
    return rf"regexp_replace(text, '(^|[^\p{{L}}\p{{N}}])({words})', '\1<b>\2</b>', 'gi')"


def _with_fields(suggestions: str, columns: dict[str, str], keys: str) -> str:
    """Suggestions, then the named columns of their parts as (field, value) rows."""
    rows = "".join(
        f" UNION ALL SELECT {keys}, '{field}', CAST({column} AS VARCHAR)"
        " FROM s JOIN part ON p_partkey = doc_id"
        for field, column in columns.items()
    )
    return (
        f"SELECT {keys}, field, value FROM (WITH s AS ({suggestions})"
        f" SELECT {keys}, NULL::VARCHAR AS field, NULL::VARCHAR AS value FROM s{rows})"
    )


_KEYS = "rank, text, highlight, weight, doc_id"
_PART_TEXTS = """
heaviest AS (
  SELECT text, max(weight) AS weight,
         arg_min(doc_id, (-weight, doc_id)) AS doc_id FROM cand GROUP BY text)"""


def _cand(*parts_: tuple[str, float]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {column} AS text, {weight}::DOUBLE AS weight, p_partkey AS doc_id FROM part"
        for column, weight in parts_
    )
    return f"cand AS ({rows}),{_PART_TEXTS}"


SQL = {
    "facets": f"WITH {VALUES}, {_counted(_NAMES)} {top_facets('c')}",
    "facets_one_index": f"""WITH {VALUES}, {tokens()},
c AS (SELECT field, value, count(*) AS "count" FROM present
      WHERE field = 'source' AND index_name = 'docs-fr' GROUP BY ALL
      UNION ALL SELECT 'fulltext', term, count(DISTINCT doc_id) FROM post
      WHERE index_name = 'docs-fr' GROUP BY term) {top_facets('c', 5)}""",
    "facets_for_query": f"""WITH {VALUES}, {tokens()}, {term_hits('hits', 'from')},
{_counted("'lang', 'source'", join='SEMI JOIN hits USING (index_name, doc_id)')} {top_facets('c')}""",
    "facets_multi_index": f"""WITH {VALUES}, {tokens()}, {term_hits('hits', 'er')},
{_counted("'source', 'toxic'", "index_name IN ('docs-en', 'docs-de')",
          'SEMI JOIN hits USING (index_name, doc_id)')} {top_facets('c', 7)}""",
    "facets_all_fields": f"""WITH {VALUES}, {tokens()}, {term_hits('hits', 'th')},
{_counted("'lang', 'source', 'n_chars', 'quality', 'toxic'", "index_name = 'docs-en'",
          'SEMI JOIN hits USING (index_name, doc_id)')} {top_facets('c')}""",
    "facets_repeated_field": f"""WITH {_TALK_WORDS}, {term_hits('hits', 'la')},
c AS (SELECT 'role' AS field, role AS value, count(DISTINCT conv_id) AS "count"
      FROM conversations WHERE conv_id IN (SELECT doc_id FROM hits) GROUP BY ALL)
{top_facets('c')}""",
    "facets_grouping_sets": f"""WITH c AS (
SELECT 'lang' AS field, lang AS value, count(*) AS "count" FROM documents GROUP BY ALL
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL) {top_facets('c')}""",
    "facet_semi_join": f"""WITH {tokens()}, {term_hits('hits', 'from')}
SELECT index_name, doc_id, 'source' AS field, source AS term
FROM hits JOIN documents USING (doc_id)""",
    "facet_top_n": f"WITH {VALUES}, {_counted(_LONG)} {top_facets('c', 3)}",
    "search_with_facets": f"""WITH {VALUES}, {tokens()}, {term_hits('hits', 'from')},
page AS ({ranked('hits')}),
{_counted("'lang', 'source'", join='SEMI JOIN hits USING (index_name, doc_id)')},
best AS ({top_facets('c', 5)})
SELECT 'hit' AS part, rank, index_name, doc_id, score, NULL::VARCHAR AS field,
       NULL::VARCHAR AS value, NULL::BIGINT AS "count" FROM page
UNION ALL SELECT 'facet', rank, NULL, NULL, NULL, field, value, "count" FROM best""",
    "index_terms": f"""WITH {tokens()} SELECT term, count(DISTINCT doc_id) AS doc_freq
FROM post WHERE index_name = 'docs-en' GROUP BY ALL""",
    "index_terms_multi": f"""WITH {tokens()} SELECT term, count(DISTINCT doc_id) AS doc_freq
FROM post WHERE index_name IN ('docs-en', 'docs-fr') GROUP BY ALL""",
    "top_terms": f"WITH {tokens()}, {DICTIONARY} {_top('TRUE')}",
    "fuzzy_terms": f"WITH {tokens()}, {DICTIONARY} {_top(_NEAR)}",
    "prefix_terms": f"WITH {tokens()}, {DICTIONARY} {_top(_BEGINS)}",
    "similar_terms": f"""WITH dict AS (
  (WITH {_TITLE_WORDS} SELECT 'title' AS field, term, count(DISTINCT doc_id) AS doc_freq
   FROM post GROUP BY ALL)
  UNION ALL
  (WITH {_TYPE_WORDS} SELECT 'type' AS field, term, count(DISTINCT doc_id) AS doc_freq
   FROM post GROUP BY ALL))
{_top("damerau_levenshtein(term, 'widge') <= 2 OR starts_with(term, 'widge')")}""",
    "similar_terms_text": f"""WITH {tokens()}, {DICTIONARY}
{_top(f"damerau_levenshtein({_LETTERS}, 'thanea') <= 2 OR starts_with(term, 'thanea')")}""",
    "edit_distance": f"""WITH {_TITLE_WORDS}
SELECT DISTINCT term, CAST(damerau_levenshtein(term, 'gimzo') AS INTEGER) AS edits FROM post""",
    "analyze_standard": f"""WITH tok AS (SELECT doc_id, {SPLIT.format('text')} AS w FROM documents)
SELECT doc_id, term, CAST(position AS INTEGER) AS position FROM (
  SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS position FROM tok)
WHERE term NOT IN ({STOP_LIST})""",
    "analyze_keyword": "SELECT doc_id, 0 AS position, source AS term FROM documents",
    "custom_analyzer": r"""SELECT substr(w, 1, 6) AS term, count(*) AS uses
FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS w FROM documents)
WHERE length(w) >= 4 GROUP BY ALL""",
    "suggest_terms": f"""WITH {tokens()}, {DICTIONARY}, cand AS (
SELECT term AS text, '<b>fro</b>' || substr(term, 4) AS highlight, CAST(sum(doc_freq) AS DOUBLE) AS weight
FROM dict WHERE starts_with(term, 'fro') GROUP BY ALL) {_suggestions('cand')}""",
    "suggest_documents": f"""WITH {_cand(('p_name', 1.0))}, m AS (
SELECT h.*, {_marked('ri')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])ri'))
{_with_fields(_suggestions('m', more=', doc_id'), {'brand': 'p_brand', 'type': 'p_type'}, _KEYS)}""",
    "suggest_two_words": f"""WITH {_cand(('p_name', 1.0))}, m AS (
SELECT h.*, {_marked('wid|re')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])wid')
  AND regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])re')) {_suggestions('m', more=', doc_id')}""",
    "suggest_weighted": f"""WITH {_cand(('p_name', 1.5), ('p_type', 3.0))}, m AS (
SELECT h.*, {_marked('sm')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])sm')) {_suggestions('m', more=', doc_id')}""",
    "suggest_min_chars": f"""WITH {_cand(('p_name', 1.0))}, m AS (
SELECT h.*, {_marked('re')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])re')) {_suggestions('m')}""",
    "suggestion_dedupe": "SELECT p_name AS text, 1.0::DOUBLE AS weight, min(p_partkey) AS doc_id"
    " FROM part GROUP BY ALL",
    "suggestion_documents": """WITH c AS (
SELECT p_name AS text, min(p_partkey) AS doc_id FROM part GROUP BY ALL ORDER BY text LIMIT 15),
s AS (SELECT CAST(row_number() OVER (ORDER BY text) AS INTEGER) AS rank, * FROM c)
SELECT rank, text, doc_id, NULL::VARCHAR AS field, NULL::INTEGER AS ord, NULL::VARCHAR AS value FROM s
UNION ALL SELECT rank, text, doc_id, 'brand', 0, p_brand FROM s JOIN part ON p_partkey = doc_id
UNION ALL SELECT rank, text, doc_id, 'size', 0, CAST(p_size AS VARCHAR)
FROM s JOIN part ON p_partkey = doc_id""",
    "top_suggestions": """SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, source) AS INTEGER)
 AS rank, source AS text, count(*) * 0.5::DOUBLE AS weight
FROM documents GROUP BY source ORDER BY weight DESC, text LIMIT 10""",
    "build_suggester": f"""WITH {_cand(('p_name', 2.0), ('p_type', 1.0))}
SELECT 'parts' AS index_name, 'names' AS suggester, text, weight, doc_id FROM heaviest""",
    "suggest_named": f"""WITH {_cand(('p_name', 2.0), ('p_type', 1.0))}, m AS (
SELECT h.*, {_marked('ec')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])ec'))
{_with_fields(_suggestions('m', more=', doc_id'), {'brand': 'p_brand', 'type': 'p_type'}, _KEYS)}""",
    "complete_short": f"""WITH {_cand(('p_name', 2.0), ('p_type', 1.0))}, m AS (
SELECT h.*, {_marked('ec')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])ec'))
{_with_fields(_suggestions('m', more=', doc_id'), {'brand': 'p_brand', 'type': 'p_type'}, _KEYS)}""",
    "complete_words": f"""WITH {_cand(('p_name', 2.0), ('p_type', 1.0))}, m AS (
SELECT h.*, {_marked('wid|re')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])wid')
  AND regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])re')),
k AS (SELECT h.*, {_marked('econo')} AS highlight FROM heaviest h
WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{N}}])econo'))
SELECT * FROM ({_suggestions('m', more=', doc_id')})
UNION ALL SELECT * FROM ({_suggestions('k', more=', doc_id')})""",
    "completion_starts": f"""WITH {_cand(('p_name', 2.0), ('p_type', 1.0))}, w AS (
SELECT DISTINCT text, weight, doc_id, unnest(list_filter(
  string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')) AS word FROM heaviest),
s AS (SELECT DISTINCT text, weight, doc_id, substr(word, 1, n) AS start
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS n) WHERE length(word) >= n)
SELECT start, text, weight, 'parts' AS index_name, doc_id FROM s
QUALIFY row_number() OVER (PARTITION BY start ORDER BY weight DESC, text) <= 3""",
    "result_suggestions": f"""WITH {tokens()}, w AS (
SELECT index_name, doc_id, max(CASE WHEN starts_with(term, 'fro') THEN 1.0 ELSE 0.0 END)
       + max(CASE WHEN starts_with(term, 'tionh') THEN 1.0 ELSE 0.0 END) AS score
FROM post WHERE starts_with(term, 'fro') OR starts_with(term, 'tionh') GROUP BY ALL),
hits AS (SELECT index_name, doc_id, CAST(score AS DOUBLE) AS score FROM w
         WHERE index_name = 'docs-fr')
{ranked('hits', 10)}""",
    "return_fields": f"""WITH {tokens()}, {VALUES}, {term_hits('hits', 'from')},
page AS ({ranked('hits')})
SELECT rank, doc_id, field, 0 AS ord, value FROM page JOIN present USING (index_name, doc_id)
WHERE field IN ('source', 'quality')""",
}
