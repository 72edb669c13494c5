"""Lines that many documents share, dropped from all of them but one.

Lines are exploded and hashed, distinct documents counted per hash, and the positions of lines over
the threshold gathered per document, which is then put together from the positions that stay. Texts
are shuffled at most once, for that last join; lines travel as two 64-bit hashes with different
seeds, so that a collision needs 128 equal bits.

A line in very many documents is counted before the shuffle, and in the join with the dropped lines
its partition is split by adaptive execution, as no row there needs its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ASCII_SPACE, ascii_lower, documents, narrow

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def _hashes(key: Column) -> dict[str, Column]:
    return {"h1": F.xxhash64(key), "h2": F.xxhash64(F.lit(1), key)}


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (what stays), n_lines, n_dropped.

    Keys of at least ``min_chars`` code points in at least ``min_docs`` distinct ids go, except from
    the largest id that holds them. A null or empty text is one empty line. Null ids do not count as
    documents, yet lose what others share. Repeated rows are treated alike. An empty table gives no
    rows.
    """
    rows = narrow(docs, id_col, text_col)
    lines = F.split("text", "\n", -1)
    keys = F.array_distinct(
        F.filter(F.transform(lines, line_key), lambda key: F.char_length(key) >= min_chars)
    )
    shared = (
        rows.select("doc_id", F.explode(keys).alias("key"))
        .select("doc_id", *[h.alias(name) for name, h in _hashes(F.col("key")).items()])
        .groupBy("h1", "h2")
        .agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "last")
    )
    dropped = (
        rows.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(lines).alias("pos", "line"))
        .select("doc_id", "h", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "h", "pos", *[h.alias(n) for n, h in _hashes(F.col("key")).items()])
        .join(shared, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy(F.col("doc_id").alias("of_id"), F.col("h").alias("of_h"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    joined = rows.withColumn("h", F.xxhash64("text")).join(
        dropped, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")), "left"
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return joined.withColumn("lines", lines).select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_shared_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


QUERIES = {"op4_line_dedup": op4_line_dedup}

SQL = {
    "op4_line_dedup": """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed
  WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, shared.key IS NOT NULL AND doc_id <> last AS gone
  FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
}
