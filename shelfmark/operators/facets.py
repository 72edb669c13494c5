"""Facets: how many documents have each value of a field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import names as split_names
from shelfmark.operators.build import IndexTables, count_documents
from shelfmark.operators.predicates import Predicate
from shelfmark.operators.scoring import HIT

MAX_VALUES = 20


def facet_top_n(counts: DataFrame, n: int = MAX_VALUES) -> DataFrame:
    """Best ``n`` values per field. Each task keeps its own best before anything is shuffled."""
    best = Window.partitionBy("field").orderBy(F.desc("count"), "value")
    return (
        counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    )


def facet_semi_join(idx: IndexTables, matched: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Postings of the facet fields, of matched documents only."""
    rows = idx.postings.where(F.col("field").isin(list(fields))).select(*HIT, "field", "term")
    return rows.join(matched.select(*HIT), HIT, "left_semi")


def facet_counts(
    idx: IndexTables, fields: Sequence[str], matched: DataFrame | None = None
) -> DataFrame:
    """(field, value, count). Over all documents the dictionary already knows the counts."""
    if matched is None:
        counts = (
            idx.dictionary.where(F.col("field").isin(list(fields)))
            .groupBy("field", "term")
            .agg(F.sum("doc_freq").alias("count"))
            .where(F.col("count") > 0)
        )
    else:
        repeated = [f for f in fields if idx.is_repeated(f)]
        counts = count_documents(
            facet_semi_join(idx, matched, fields), ["field", "term"], repeated, "count"
        )
    return counts.withColumnRenamed("term", "value")


def facets(
    idx: IndexTables,
    fields: str | Sequence[str] | None,
    max_values: int = MAX_VALUES,
    base: Predicate | None = None,
) -> DataFrame:
    """Value counts per field. No fields with a condition means every visible untokenized field."""
    wanted = split_names(fields)
    if not wanted and base is not None:
        wanted = sorted(f for f in idx.untokenized if not f.startswith("_"))
    matched = base.hits(idx, scored=False) if base is not None else None
    return facet_top_n(facet_counts(idx, wanted, matched), max_values)


def wide_facets(docs: DataFrame, columns: Sequence[str], max_values: int = MAX_VALUES) -> DataFrame:
    """Facets of plain columns, each document once per column, in one pass."""
    cols = [F.col(c) for c in columns]
    sets = [[c] for c in cols]
    which = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for c in columns:
        here = F.grouping(c) == 0
        which = F.when(here, F.lit(c)).otherwise(which)
        value = F.when(here, F.col(c).cast("string")).otherwise(value)
    counts = docs.groupingSets(sets, *cols).agg(
        F.count("*").alias("count"), which.alias("field"), value.alias("value")
    )
    return facet_top_n(
        counts.where(F.col("value").isNotNull()).select("field", "value", "count"), max_values
    )


def search_with_facets(
    idx: IndexTables,
    predicate: Predicate,
    fields: str | Sequence[str] | None,
    max_values: int = MAX_VALUES,
    page: int = 1,
    results: int = 100,
) -> DataFrame:
    """One answer: the page of hits, then the facets of the same hits, told apart by ``part``.

    Facets need to know which documents match, not how well, and so read no statistics.
    """
    from shelfmark.operators.search import find, paging, sort_order

    hits, order = sort_order(find(idx, predicate), idx)
    wanted = split_names(fields)
    page_rows = paging(hits, order, page, results).select(
        F.lit("hit").alias("part"),
        "rank",
        "index_name",
        "doc_id",
        "score",
        F.lit(None).cast("string").alias("field"),
        F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("long").alias("count"),
    )
    if not wanted:
        return page_rows
    counted = facet_top_n(facet_counts(idx, wanted, predicate.hits(idx, scored=False)), max_values)
    facet_rows = counted.select(
        F.lit("facet").alias("part"),
        "rank",
        F.lit(None).cast("string").alias("index_name"),
        F.lit(None).cast(idx.docs.schema["doc_id"].dataType).alias("doc_id"),
        F.lit(None).cast("double").alias("score"),
        "field",
        "value",
        "count",
    )
    return page_rows.unionByName(facet_rows)
