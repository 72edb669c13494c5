"""Relevance scores (BM25) of term and phrase hits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.build import IndexTables

# Fixed values of the formula, and the decimals scores are compared with. Rounding makes the order
# of equal hits depend on their names, not on the order floating point sums were made in.
K1 = 1.2
B = 0.75
SCORE_DECIMALS = 4

HIT = ["index_name", "doc_id"]


def pair_condition(pairs: Sequence[tuple[str, str]]) -> Column:
    """Rows of the given (field, term) pairs; folders are pruned and terms pushed to the scan."""
    by_field: dict[str, list[str]] = {}
    for field, term in pairs:
        by_field.setdefault(field, []).append(term)
    parts = [
        (F.col("field") == field) & F.col("term").isin(sorted(set(terms)))
        for field, terms in by_field.items()
    ]
    return reduce(or_, parts, F.lit(False)) if parts else F.lit(False)


def score_stats(idx: IndexTables, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Per (field, term): documents n, average length, document frequency and idf.

    Statistics go over all selected indexes. There is at most one row per pair asked for.
    """
    fields = sorted({field for field, _ in pairs})
    totals = (
        idx.field_stats.where(F.col("field").isin(fields))
        .groupBy("field")
        .agg(F.sum("doc_count").alias("n"), F.sum("total_len").alias("total_len"))
    )
    frequencies = (
        idx.dictionary.where(pair_condition(pairs))
        .groupBy("field", "term")
        .agg(F.sum("doc_freq").alias("df"))
    )
    return frequencies.join(F.broadcast(totals), "field").select(
        "field",
        "term",
        "n",
        "df",
        (F.col("total_len") / F.col("n")).alias("avg_len"),
        idf(F.col("n"), F.col("df")).alias("idf"),
    )


def idf(n: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25(idf_: Column, tf: Column, length: Column, avg_len: Column) -> Column:
    return (
        idf_
        * (tf * F.lit(K1 + 1))
        / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / avg_len))
    )


def term_rows(idx: IndexTables, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Postings of the pairs, one row per document and term."""
    rows = idx.postings.where(pair_condition(pairs))
    if any(idx.is_repeated(field) for field, _ in pairs):
        return rows.groupBy(*HIT, "field", "term").agg(
            F.sum("tf").alias("tf"), F.max("length").alias("length")
        )
    return rows.select(*HIT, "field", "term", "tf", "length")


def score_hits(hits: DataFrame, stats: DataFrame) -> DataFrame:
    """Score of each (document, term) hit. ``stats`` has one row per query term."""
    return hits.join(F.broadcast(stats), ["field", "term"]).select(
        *HIT,
        "field",
        "term",
        bm25(F.col("idf"), F.col("tf"), F.col("length"), F.col("avg_len")).alias("score"),
    )
