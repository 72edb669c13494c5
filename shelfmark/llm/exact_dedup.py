"""Exact duplicates by sorting contents.

Rows are dealt into ranges of their content by sampled splitters, sorted inside each range (Spark's
external sort), and equal neighbours are compared in full. The sort key begins with a short prefix
and a hash, so that the samples behind the splitters stay small whatever the texts' lengths, and
ends with the whole text.

A text whose copies weigh more than a piece is cut into pieces by document, each sorted by itself;
what the pieces of one text found is put together afterwards. Only the ``HEAVIEST`` such texts are
cut, a number that bounds what is broadcast; every other text stays whole in one range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import documents

PIECE_BYTES = 16 << 20
HEAVIEST = 10_000
PREFIX = 48


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece_bytes: int = PIECE_BYTES,
    heaviest: int = HEAVIEST,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (the row itself), doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id is kept; null ids come before all others, so a group
    of null ids has a null keep_id. Rows repeated with id and text are one group, of which one row
    is kept. A null text equals an empty one. An empty table gives no rows.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
        if len(docs.columns) > 1
        else F.lit(None).cast("struct<_none:int>").alias("rest"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).isNull().alias("was_null"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    heavy = (
        rows.groupBy("h")
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
        .where((F.col("n") > 1) & (F.col("bytes") > piece_bytes))
        .orderBy(F.desc("bytes"), "h")
        .limit(heaviest)
        .select("h", F.ceil(F.col("bytes") / piece_bytes).cast("long").alias("pieces"))
    )
    dealt = rows.join(F.broadcast(heavy), "h", "left")
    merged = (
        dealt.where(F.col("pieces").isNotNull())
        .groupBy("text")
        .agg(F.max("doc_id").alias("all_keep"), F.count("*").alias("all_n"))
        .select(F.sha2("text", 256).alias("text_sha256"), "all_keep", "all_n")
    )
    key = ["prefix", "h", "piece"]
    same = Window.partitionBy(*key, "text")
    in_order = same.orderBy(F.col("doc_id").desc_nulls_last())
    marked = (
        dealt.withColumns(
            {
                "prefix": F.substring("text", 1, PREFIX),
                "piece": F.coalesce(F.pmod(F.xxhash64("doc_id"), "pieces"), F.lit(0)),
            }
        )
        .repartitionByRange(*key)
        .withColumns(
            {
                "place": F.row_number().over(in_order),
                "piece_keep": F.first("doc_id").over(in_order),
                "piece_n": F.count(F.lit(1)).over(same),
            }
        )
        .withColumn("text_sha256", F.sha2("text", 256))
    )
    keep = F.when(F.col("all_n").isNotNull(), F.col("all_keep")).otherwise(F.col("piece_keep"))
    size = F.coalesce("all_n", "piece_n")
    first = (F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep)
    text = F.when(~F.col("was_null"), F.col("text"))
    return marked.join(F.broadcast(merged), "text_sha256", "left").select(
        F.struct(
            *[
                text.alias(c) if c == text_col else F.col("rest").getField(c).alias(c)
                for c in docs.columns
            ]
        ).alias("row"),
        "doc_id",
        keep.alias("keep_id"),
        size.cast("long").alias("group_size"),
        first.alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the copies, with all their columns."""
    return mark_copies(docs).where("kept").select("row.*")


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return mark_copies(documents(spark, sf_dir)).drop("row")


QUERIES = {"op3_exact_dedup": op3_exact_dedup}

SQL = {
    "op3_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
}
