"""Pieces the stating SQL shares: tokens, lengths, scores and ranks over the raw tables."""

from __future__ import annotations

from shelfmark.functions.analysis import STOP_WORDS

STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)
SPLIT = r"list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def tokens(
    rows: str = "SELECT 'docs-' || lang AS index_name, doc_id, text FROM documents",
) -> str:
    """CTEs occ (every word) and post (kept words) of rows (index_name, doc_id, text)."""
    return f"""
src AS ({rows}),
tok AS (SELECT index_name, doc_id, {SPLIT.format('text')} AS w FROM src),
occ AS (SELECT index_name, doc_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM tok),
post AS (SELECT * FROM occ WHERE term NOT IN ({STOP_LIST})),
lens AS (SELECT index_name, doc_id, count(*) AS len FROM post GROUP BY ALL),
stat AS (SELECT count(*) AS n, sum(len) / count(*) AS avg_len FROM lens)"""


def bm25(idf: str = "idf") -> str:
    return f"({idf} * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * len / avg_len)))"


IDF = "ln(1.0 + (n - df + 0.5) / (df + 0.5))"


def term_hits(name: str, term: str) -> str:
    """CTE ``name`` (index_name, doc_id, score) of one term."""
    return f"""
{name}_tf AS (SELECT index_name, doc_id, count(*) AS tf FROM post WHERE term = '{term}' GROUP BY ALL),
{name} AS (
  SELECT index_name, doc_id, {bm25(IDF)} AS score
  FROM {name}_tf JOIN lens USING (index_name, doc_id), stat,
       (SELECT count(*) AS df FROM {name}_tf))"""


def field_hits(name: str, column: str, value: str, source: str = "documents") -> str:
    """CTE ``name`` of an untokenized column of the documents: tf and length are 1."""
    return f"""
{name} AS (
  SELECT 'docs-' || lang AS index_name, doc_id, {IDF} AS score
  FROM {source},
       (SELECT count({column}) AS n, count(*) FILTER (WHERE {column} = '{value}') AS df FROM {source})
  WHERE {column} = '{value}')"""


def phrase_hits(name: str, slots: list[tuple[str, int]]) -> str:
    """CTE ``name`` of a phrase given as (term, slot), by one self-join per further slot."""
    joins = "".join(
        f" JOIN post p{i} ON p{i}.index_name = p0.index_name AND p{i}.doc_id = p0.doc_id"
        f" AND p{i}.term = '{term}' AND p{i}.pos = p0.pos + {slot}"
        for i, (term, slot) in enumerate(slots)
        if i
    )
    idf = " + ".join(
        f"(SELECT {IDF} FROM stat, (SELECT count(DISTINCT (index_name, doc_id)) AS df FROM post"
        f" WHERE term = '{term}'))"
        for term, _ in slots
    )
    return f"""
{name}_tf AS (
  SELECT p0.index_name, p0.doc_id, count(*) AS tf FROM post p0{joins}
  WHERE p0.term = '{slots[0][0]}' GROUP BY ALL),
{name} AS (
  SELECT index_name, doc_id, {bm25()} AS score
  FROM {name}_tf JOIN lens USING (index_name, doc_id), stat, (SELECT {idf} AS idf))"""


def ranked(hits: str, limit: int = 100, offset: int = 0, order: str | None = None, more: str = "") -> str:
    """The page of a hits CTE: rank, index_name, doc_id, score."""
    order = order or "score DESC, index_name, doc_id"
    return f"""
SELECT CAST(rank AS INTEGER) AS rank, index_name, doc_id, score{more} FROM (
  SELECT *, row_number() OVER (ORDER BY {order}) AS rank
  FROM (SELECT * REPLACE (round(score, 4) AS score) FROM {hits}))
WHERE rank > {offset} AND rank <= {offset + limit}"""


DICTIONARY = """
dict AS (
  SELECT 'fulltext' AS field, index_name, term, count(DISTINCT doc_id) AS doc_freq
  FROM post GROUP BY ALL)"""

# Documents as value rows, optional labels included.
VALUES = """
vals AS (
  SELECT 'docs-' || lang AS index_name, doc_id, 'lang' AS field, lang AS value FROM documents
  UNION ALL SELECT 'docs-' || lang, doc_id, 'source', source FROM documents
  UNION ALL SELECT 'docs-' || lang, doc_id, 'n_chars', CAST(n_chars AS VARCHAR) FROM documents
  UNION ALL SELECT 'docs-' || lang, doc_id, 'quality', CAST(quality AS VARCHAR)
    FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT 'docs-' || lang, doc_id, 'toxic', CAST(toxic AS VARCHAR)
    FROM labels JOIN documents USING (doc_id)),
present AS (SELECT * FROM vals WHERE value IS NOT NULL)"""


def top_facets(counts: str, n: int = 20) -> str:
    """Best values per field of a CTE (field, value, count)."""
    return f"""
SELECT field, value, "count", CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY field ORDER BY "count" DESC, value) AS rank FROM {counts})
WHERE rank <= {n}"""


# Documents of the test tables with their system columns.
DOCS = """
docs AS (
  SELECT 'docs-' || lang AS index_name, doc_id, lang, source, n_chars,
         '/documents/' || lang || '/' || doc_id AS _path,
         '/data/documents/' || lang || '/' || doc_id || '.psml' AS _src,
         1704067200000000 + doc_id * 60000000 AS lm
  FROM documents)"""

PAGE_DOCS = r"""
page_docs AS (
  SELECT *, CASE WHEN regexp_full_match(_path, '/([\w\-]+)(/.+)?')
                 THEN 'pages-' || regexp_extract(_path, '^/([\w\-]+)', 1) END AS index_name
  FROM (SELECT page_id AS doc_id, url,
               regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/$', '') AS _path
        FROM pages))"""

EVENTS = """
ev AS (
  SELECT event_id, ts, event_id % 4 = 0 AS is_dir,
         '/psml/content/book-' || (user_id % 10) || '/f' || (user_id % 3)
           || CASE WHEN event_id % 4 = 0 THEN '' ELSE '/' || user_id || '.psml' END AS path,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'modify' END
           AS kind
  FROM events),
listing AS (SELECT DISTINCT path FROM ev WHERE NOT is_dir)"""

EVENT_CLASS = """CASE
  WHEN kind = 'delete' AND NOT contains(split_part(path, '/', -1), '.') THEN 'folder-deleted'
  WHEN kind = 'create' AND is_dir THEN 'folder-added'
  WHEN NOT is_dir THEN 'file-changed' ELSE 'ignored' END"""

SNAPSHOTS = f"""{DOCS},
existing AS (SELECT * FROM docs WHERE doc_id % 10 <> 0),
source AS (
  SELECT *, lm + CASE WHEN doc_id % 10 = 2 THEN 86400000000 ELSE 0 END AS modified
  FROM docs WHERE doc_id % 10 <> 1)"""
