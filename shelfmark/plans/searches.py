"""Searches over the indexed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import search
from shelfmark.operators.predicates import P, Phrase, condition
from shelfmark.operators.scoring import score_hits, score_stats, term_rows
from shelfmark.plans import corpora
from shelfmark.plans.corpora import documents, parts, talks
from shelfmark.plans.sql import (
    DOCS,
    field_hits,
    phrase_hits,
    ranked,
    term_hits,
    tokens,
)
from shelfmark.session import shared_dir
from shelfmark.sources import files

HIT_COLUMNS = ("rank", "index_name", "doc_id", "score")


def _page(df):
    return df.select(*HIT_COLUMNS)


def term_search(spark, sf_dir):
    return _page(search.term_search(documents(spark, sf_dir), "fulltext", "from"))


def match_all(spark, sf_dir):
    return _page(search.term_search(documents(spark, sf_dir)))


def phrase_search(spark, sf_dir):
    return _page(search.basic_search(documents(spark, sf_dir), "Anea eriner!"))


def phrase_with_gap(spark, sf_dir):
    return _page(search.basic_search(documents(spark, sf_dir), "er the th"))


def phrase_repeated_word(spark, sf_dir):
    return _page(search.basic_search(documents(spark, sf_dir), "de de"))


def exact_search(spark, sf_dir):
    return _page(search.basic_search(documents(spark, sf_dir), "src1", field="source"))


def facet_filters(spark, sf_dir):
    return _page(
        search.basic_search(
            documents(spark, sf_dir), "de", with_="lang:es,broken,source:src16,a:b:c"
        )
    )


def predicate_search(spark, sf_dir):
    return _page(search.predicate_search(documents(spark, sf_dir), "fulltext:From lang:es"))


def predicate_raw(spark, sf_dir):
    return _page(
        search.predicate_search(documents(spark, sf_dir), "source:src2", tokenize=False)
    )


def _all_hits(df):
    return df.select("index_name", "doc_id", "score")


def predicate_boolean(spark, sf_dir):
    idx = documents(spark, sf_dir)
    wanted = P.all(
        P.any(P.term("fulltext", "from"), P.term("fulltext", "ha")),
        P.term("lang", "en"),
        P.none(P.term("fulltext", "th")),
    )
    return _all_hits(search.find(idx, wanted))


def predicate_wildcard(spark, sf_dir):
    return _all_hits(search.find(documents(spark, sf_dir), P.wildcard("fulltext", "tion?h*")))


def predicate_infix(spark, sf_dir):
    """A pattern without a fixed beginning, found by the grams of the dictionary."""
    return _all_hits(search.find(documents(spark, sf_dir, lookups=True), P.wildcard("fulltext", "*tha?ea*")))


def predicate_range(spark, sf_dir):
    wanted = P.range("fulltext", "from", "ha", include_low=True, include_high=False)
    return _all_hits(search.find(documents(spark, sf_dir), wanted))


def predicate_fuzzy(spark, sf_dir):
    return _all_hits(search.find(documents(spark, sf_dir, lookups=True), P.fuzzy("fulltext", "eriner", 1)))


def predicate_boost(spark, sf_dir):
    wanted = P.any(P.boost(P.term("fulltext", "from"), 2.0), P.term("fulltext", "ha"))
    return _page(search.search(documents(spark, sf_dir), wanted))


def base_condition(spark, sf_dir):
    idx = parts(spark, sf_dir)
    return _all_hits(search.find(idx, condition(idx, "Economy title:red")))


def repeated_field_search(spark, sf_dir):
    return _page(search.basic_search(talks(spark, sf_dir), "la", field="text"))


def repeated_field_phrase(spark, sf_dir):
    return _page(search.basic_search(talks(spark, sf_dir), "de la", field="text"))


def hits_to_documents(spark, sf_dir):
    idx = documents(spark, sf_dir)
    page = search.term_search(idx, "fulltext", "ha", results=50)
    return search.hits_to_documents(page, idx.docs).select(
        "rank", "doc_id", "index_name", "_src", "_path", "lang", "source", "n_chars"
    )


def phrase_join(spark, sf_dir):
    phrase = Phrase("fulltext", (("de", 0), ("la", 1)))
    return phrase.counts(documents(spark, sf_dir)).select(
        "index_name", "doc_id", F.col("tf").cast("long").alias("tf"), "length"
    )


def score_stats_(spark, sf_dir):
    pairs = [("fulltext", t) for t in ("from", "ha", "th")]
    stats = score_stats(documents(spark, sf_dir), pairs)
    return stats.select("term", "n", "df", F.round("avg_len", 4).alias("avg_len"))


def score_hits_(spark, sf_dir):
    idx = documents(spark, sf_dir)
    pairs = [("fulltext", t) for t in ("from", "ha")]
    scored = score_hits(term_rows(idx, pairs), score_stats(idx, pairs))
    return scored.select("index_name", "doc_id", "term", F.round("score", 4).alias("score"))


def sort_score(spark, sf_dir):
    return _page(search.basic_search(documents(spark, sf_dir), "st", sort="-any"))


def sort_document(spark, sf_dir):
    return _page(
        search.basic_search(documents(spark, sf_dir), "st", sort="-x", sort_type="document")
    )


def sort_numeric(spark, sf_dir):
    return _page(
        search.basic_search(documents(spark, sf_dir), "st", sort="-n_chars", sort_type="long")
    )


def sort_numeric_missing(spark, sf_dir):
    return _page(
        search.basic_search(documents(spark, sf_dir), "st", sort="quality", sort_type="int")
    )


def sort_double(spark, sf_dir):
    return _page(
        search.basic_search(
            parts(spark, sf_dir), "red", field="title", sort="-price", sort_type="double"
        )
    )


def sort_string(spark, sf_dir):
    return _page(
        search.basic_search(documents(spark, sf_dir), "st", sort="source", sort_type="string")
    )


def sort_set(spark, sf_dir):
    return _page(
        search.basic_search(
            talks(spark, sf_dir), "la", field="text", sort="-role", sort_type="set"
        )
    )


def paging(spark, sf_dir):
    return _page(
        search.basic_search(documents(spark, sf_dir), "er", page=3, results=20)
    )


def multi_index_search(spark, sf_dir):
    idx = documents(spark, sf_dir, "docs-es, docs-fr")
    return _page(search.basic_search(idx, "la"))


def select_indexes(spark, sf_dir):
    idx = documents(spark, sf_dir, " docs-en,docs-fr , nothing")
    return idx.docs.select("index_name", "doc_id")


def prefix_search(spark, sf_dir):
    docs = documents(spark, sf_dir).docs
    return search.prefix_search(docs, "_path", "/documents/fr/").select(
        "index_name", "doc_id", "_path"
    )


def write_results(spark, sf_dir):
    """The written answer, read back: hits nested with the fields of their documents."""
    import uuid

    idx = documents(spark, sf_dir)
    page = search.term_search(idx, "fulltext", "from")
    results = search.hits_to_documents(page, idx.docs).select(
        "rank",
        "score",
        F.struct("index_name", "doc_id", "lang", "source").alias("document"),
    )
    path = f"{shared_dir(spark)}/shelfmark/results/{uuid.uuid4().hex}"
    files.write_results(results, path, "json")
    return spark.read.schema(results.schema).json(path).select(
        "rank", "score", "document.index_name", "document.doc_id", "document.lang"
    )


QUERIES = {
    "term_search": term_search,
    "match_all": match_all,
    "phrase_search": phrase_search,
    "phrase_with_gap": phrase_with_gap,
    "phrase_repeated_word": phrase_repeated_word,
    "exact_search": exact_search,
    "facet_filters": facet_filters,
    "predicate_search": predicate_search,
    "predicate_raw": predicate_raw,
    "predicate_boolean": predicate_boolean,
    "predicate_wildcard": predicate_wildcard,
    "predicate_infix": predicate_infix,
    "predicate_range": predicate_range,
    "predicate_fuzzy": predicate_fuzzy,
    "predicate_boost": predicate_boost,
    "base_condition": base_condition,
    "repeated_field_search": repeated_field_search,
    "repeated_field_phrase": repeated_field_phrase,
    "hits_to_documents": hits_to_documents,
    "phrase_join": phrase_join,
    "score_stats": score_stats_,
    "score_hits": score_hits_,
    "sort_score": sort_score,
    "sort_document": sort_document,
    "sort_numeric": sort_numeric,
    "sort_numeric_missing": sort_numeric_missing,
    "sort_double": sort_double,
    "sort_string": sort_string,
    "sort_set": sort_set,
    "paging": paging,
    "multi_index_search": multi_index_search,
    "select_indexes": select_indexes,
    "prefix_search": prefix_search,
    "write_results": write_results,
}

_HITS = "SELECT index_name, doc_id, round(score, 4) AS score FROM "
_CONSTANT = "SELECT DISTINCT index_name, doc_id, 1.0::DOUBLE AS score FROM post WHERE "
_NEAR = r"damerau_levenshtein(regexp_replace(term, '[^\x00-\x7F]', '~', 'g'), 'eriner') <= 1"
_TALKS = tokens("SELECT 'talks' AS index_name, conv_id AS doc_id, turn, text FROM conversations")
# Repeated values: a word's place is its value and its place therein.
_TALK_TOKENS = _TALKS.replace(
    "tok AS (SELECT index_name, doc_id,", "tok AS (SELECT index_name, doc_id, turn,"
).replace("occ AS (SELECT index_name, doc_id,", "occ AS (SELECT index_name, doc_id, turn,")
_PART_TITLES = tokens("SELECT 'parts' AS index_name, p_partkey AS doc_id, p_name AS text FROM part")
_PART_TYPES = (
    tokens("SELECT 'parts' AS index_name, p_partkey AS doc_id, p_type AS text FROM part")
    + "," + term_hits("hits", "economy")
)

SQL = {
    "term_search": f"WITH {tokens()}, {term_hits('hits', 'from')} {ranked('hits')}",
    "match_all": f"WITH {DOCS}, hits AS (SELECT index_name, doc_id, 1.0::DOUBLE AS score FROM docs)"
    f" {ranked('hits')}",
    "phrase_search": f"WITH {tokens()}, {phrase_hits('hits', [('anea', 0), ('eriner', 1)])}"
    f" {ranked('hits')}",
    "phrase_with_gap": f"WITH {tokens()}, {phrase_hits('hits', [('er', 0), ('th', 2)])}"
    f" {ranked('hits')}",
    "phrase_repeated_word": f"WITH {tokens()}, {phrase_hits('hits', [('de', 0), ('de', 1)])}"
    f" {ranked('hits')}",
    "exact_search": f"WITH {field_hits('hits', 'source', 'src1')} {ranked('hits')}",
    "facet_filters": f"""WITH {tokens()}, {term_hits('all_hits', 'de')},
hits AS (SELECT h.* FROM all_hits h JOIN documents d USING (doc_id)
         WHERE d.lang = 'es' AND d.source = 'src16') {ranked('hits')}""",
    "predicate_search": f"""WITH {tokens()}, {term_hits('a', 'from')}, {field_hits('b', 'lang', 'es')},
hits AS (SELECT index_name, doc_id, sum(score) AS score
         FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL) {ranked('hits')}""",
    "predicate_raw": f"WITH {field_hits('hits', 'source', 'src2')} {ranked('hits')}",
    "predicate_boolean": f"""WITH {tokens()}, {term_hits('a', 'from')}, {term_hits('b', 'ha')},
{field_hits('c', 'lang', 'en')},
either AS (SELECT index_name, doc_id, sum(score) AS score
           FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL)
SELECT e.index_name, e.doc_id, round(e.score + c.score, 4) AS score
FROM either e JOIN c ON c.index_name = e.index_name AND c.doc_id = e.doc_id
WHERE (e.index_name, e.doc_id) NOT IN (SELECT (index_name, doc_id) FROM post WHERE term = 'th')""",
    "predicate_wildcard": f"WITH {tokens()} {_CONSTANT} regexp_full_match(term, 'tion.h.*')",
    "predicate_infix": f"WITH {tokens()} {_CONSTANT} regexp_full_match(term, '.*tha.ea.*')",
    "predicate_range": f"WITH {tokens()} {_CONSTANT} term >= 'from' AND term < 'ha'",
    "predicate_fuzzy": f"WITH {tokens()} {_CONSTANT} {_NEAR}",
    "predicate_boost": f"""WITH {tokens()}, {term_hits('a', 'from')}, {term_hits('b', 'ha')},
hits AS (SELECT index_name, doc_id, sum(score) AS score
         FROM (SELECT index_name, doc_id, score * 2.0 AS score FROM a UNION ALL SELECT * FROM b)
         GROUP BY ALL) {ranked('hits')}""",
    "base_condition": f"""SELECT index_name, doc_id, round(sum(score), 4) AS score FROM (
  (WITH {_PART_TYPES} SELECT * FROM hits)
  UNION ALL (WITH {_PART_TITLES}, {term_hits('hits', 'red')} SELECT * FROM hits)) GROUP BY ALL""",
    "repeated_field_search": f"WITH {_TALKS}, {term_hits('hits', 'la')} {ranked('hits')}",
    "repeated_field_phrase": "WITH "
    + _TALK_TOKENS
    + ","
    + phrase_hits("hits", [("de", 0), ("la", 1)]).replace(
        "p1.doc_id = p0.doc_id", "p1.doc_id = p0.doc_id AND p1.turn = p0.turn"
    )
    + ranked("hits"),
    "hits_to_documents": f"""WITH {tokens()}, {DOCS}, {term_hits('hits', 'ha')},
page AS ({ranked('hits', 50)})
SELECT rank, doc_id, index_name, _src, _path, lang, source, n_chars
FROM page JOIN docs USING (index_name, doc_id)""",
    "phrase_join": f"""WITH {tokens()}
SELECT a.index_name, a.doc_id, count(*) AS tf, CAST(any_value(len) AS INTEGER) AS length
FROM post a JOIN post b ON a.index_name = b.index_name AND a.doc_id = b.doc_id AND b.pos = a.pos + 1
     JOIN lens l ON l.index_name = a.index_name AND l.doc_id = a.doc_id
WHERE a.term = 'de' AND b.term = 'la' GROUP BY ALL""",
    "score_stats": f"""WITH {tokens()}
SELECT term, n, count(DISTINCT (index_name, doc_id)) AS df, round(avg_len, 4) AS avg_len
FROM post, stat WHERE term IN ('from', 'ha', 'th') GROUP BY term, n, avg_len""",
    "score_hits": f"""WITH {tokens()}, {term_hits('a', 'from')}, {term_hits('b', 'ha')}
SELECT index_name, doc_id, 'from' AS term, round(score, 4) AS score FROM a
UNION ALL SELECT index_name, doc_id, 'ha', round(score, 4) FROM b""",
    "sort_score": f"WITH {tokens()}, {term_hits('hits', 'st')} {ranked('hits')}",
    "sort_document": f"WITH {tokens()}, {term_hits('hits', 'st')}"
    f" {ranked('hits', order='index_name, doc_id')}",
    "sort_numeric": f"""WITH {tokens()}, {term_hits('found', 'st')},
hits AS (SELECT f.*, d.n_chars FROM found f JOIN documents d USING (doc_id))
{ranked('hits', order='n_chars DESC, index_name, doc_id')}""",
    "sort_numeric_missing": f"""WITH {tokens()}, {term_hits('found', 'st')},
hits AS (SELECT f.*, coalesce(l.quality, 0) AS q FROM found f LEFT JOIN labels l USING (doc_id))
{ranked('hits', order='q, index_name, doc_id')}""",
    "sort_double": f"""WITH {_PART_TITLES}, {term_hits('found', 'red')},
hits AS (SELECT f.*, p.p_retailprice AS price FROM found f JOIN part p ON p.p_partkey = f.doc_id)
{ranked('hits', order='price DESC, index_name, doc_id')}""",
    "sort_string": f"""WITH {tokens()}, {term_hits('found', 'st')},
hits AS (SELECT f.*, d.source FROM found f JOIN documents d USING (doc_id))
{ranked('hits', order='source ASC NULLS FIRST, index_name, doc_id')}""",
    "sort_set": f"""WITH {_TALKS}, {term_hits('found', 'la')},
roles AS (SELECT conv_id AS doc_id, min(role) AS role FROM conversations GROUP BY ALL),
hits AS (SELECT f.*, r.role FROM found f LEFT JOIN roles r USING (doc_id))
{ranked('hits', order='role DESC NULLS LAST, index_name, doc_id')}""",
    "paging": f"WITH {tokens()}, {term_hits('hits', 'er')} {ranked('hits', 20, 40)}",
    "multi_index_search": "WITH "
    + tokens(
        "SELECT 'docs-' || lang AS index_name, doc_id, text FROM documents"
        " WHERE lang IN ('es', 'fr')"
    )
    + f", {term_hits('hits', 'la')} {ranked('hits')}",
    "select_indexes": "SELECT 'docs-' || lang AS index_name, doc_id FROM documents"
    " WHERE lang IN ('en', 'fr')",
    "prefix_search": f"WITH {DOCS} SELECT index_name, doc_id, _path FROM docs"
    " WHERE starts_with(_path, '/documents/fr/')",
    "write_results": f"""WITH {tokens()}, {term_hits('hits', 'from')}, page AS ({ranked('hits')})
SELECT rank, score, index_name, doc_id, substr(index_name, 6) AS lang FROM page""",
}
