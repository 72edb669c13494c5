"""Suggestions: completing what was typed from terms or from field values."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.analysis import words
from shelfmark.functions.text import highlight, java_quote
from shelfmark.functions.text import names as split_names
from shelfmark.functions.text import weights as split_weights
from shelfmark.operators.build import IndexTables
from shelfmark.operators.definitions import Suggester
from shelfmark.operators.predicates import P, condition
from shelfmark.operators.scoring import HIT
from shelfmark.operators.search import find, paging, sort_order
from shelfmark.sources.store import written_once

RESULTS = 10
MIN_CHARS = 2


def typed_words(text: str) -> list[str]:
    return text.lower().split()


def begins_words(text: Column, typed: Sequence[str]) -> Column:
    """Every typed word begins some word of the text, any letter case."""
    lower = F.lower(text)
    return reduce(
        and_,
        [lower.rlike(rf"(?:^|[^\p{{L}}\p{{N}}]){java_quote(w)}") for w in typed],
        F.lit(True),
    )


def field_weight(field: Column, weights: dict[str, float]) -> Column:
    weight = F.lit(1.0)
    for name, value in weights.items():
        weight = F.when(field == name, F.lit(float(value))).otherwise(weight)
    return weight


def suggestion_dedupe(candidates: DataFrame) -> DataFrame:
    """One row per text, the heaviest kept, then the lowest document.

    A plain aggregate, not a window: copies of one text are merged before the shuffle.
    """
    others = [c for c in candidates.columns if c != "text"]
    ordered = F.struct(F.negative("weight").alias("_w"), F.col("doc_id"), *[F.col(c) for c in others if c != "doc_id"])
    best = candidates.groupBy("text").agg(F.min(ordered).alias("best"))
    return best.select("text", *[F.col(f"best.{c}").alias(c) for c in others])


def top_suggestions(suggestions: DataFrame, n: int = RESULTS) -> DataFrame:
    best = [F.desc("weight"), F.col("text")]
    return suggestions.orderBy(*best).limit(n).withColumn(
        "rank", F.row_number().over(Window.orderBy(*best))
    )


def term_candidates(idx: IndexTables, fields: Sequence[str], weights: dict[str, float]) -> DataFrame:
    """(text, weight): terms weigh their field's weight times their document frequency."""
    return (
        idx.dictionary.where(F.col("field").isin(list(fields)))
        .groupBy("field", "term")
        .agg(F.sum("doc_freq").alias("doc_freq"))
        .where("doc_freq > 0")
        .select(
            F.col("term").alias("text"),
            (field_weight(F.col("field"), weights) * F.col("doc_freq")).alias("weight"),
        )
    )


def value_candidates(idx: IndexTables, fields: Sequence[str], weights: dict[str, float]) -> DataFrame:
    """(text, weight, index_name, doc_id): whole field values that are stored."""
    return idx.fields.where(F.col("field").isin(list(fields)) & F.col("stored")).select(
        F.col("value").alias("text"),
        field_weight(F.col("field"), weights).alias("weight"),
        *HIT,
    )


def return_fields(hits: DataFrame, fields: DataFrame, names: Sequence[str]) -> DataFrame:
    """All stored values of the asked-for fields of each hit: one row per hit and value."""
    asked = F.col("field").isin(list(names)) & F.col("stored")
    return fields.where(asked).select(*HIT, "field", "ord", "value").join(hits, HIT)


def suggestion_documents(
    suggestions: DataFrame, idx: IndexTables, names: Sequence[str]
) -> DataFrame:
    """Each suggestion as a row without a field, then a row per field value of its document.

    Values stay rows, as a document may have any number of them.
    """
    own = suggestions.withColumns(
        {
            "field": F.lit(None).cast("string"),
            "ord": F.lit(None).cast("int"),
            "value": F.lit(None).cast("string"),
        }
    )
    return own.unionByName(return_fields(suggestions, idx.fields, names))


def suggest(
    idx: IndexTables,
    term: str,
    fields: str | Sequence[str] = "fulltext",
    use_terms: bool = False,
    results: int = RESULTS,
    return_fields: str | Sequence[str] | None = None,
    weights: str | dict[str, float] | None = None,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """Best completions of what was typed: (rank, text, highlight, weight, …)."""
    by_field = split_weights(weights)
    wanted = split_names(fields)
    typed = typed_words(term) if len(term.strip()) >= min_chars else []
    if use_terms:
        source = term_candidates(idx, wanted, by_field)
    else:
        source = value_candidates(idx, wanted, by_field)
    return _complete(idx, source, typed, use_terms, results, split_names(return_fields))


def _complete(
    idx: IndexTables,
    source: DataFrame,
    typed: list[str],
    use_terms: bool,
    results: int,
    returned: list[str],
) -> DataFrame:
    matching = source.where(begins_words(F.col("text"), typed) if typed else F.lit(False))
    if use_terms:
        best = matching.groupBy("text").agg(F.max("weight").alias("weight"))
    else:
        best = suggestion_dedupe(matching)
    top = top_suggestions(best, results).withColumn("highlight", highlight(F.col("text"), typed))
    if not returned or use_terms:
        return top
    return suggestion_documents(top, idx, returned)


def build_suggester(idx: IndexTables, suggester: Suggester) -> DataFrame:
    """Rows of a named suggester, ready to be written: one per distinct text of an index.

    ``words`` holds the lowercase words of the text, so that lookups compare prefixes only.
    """
    if suggester.use_terms:
        counts = (
            idx.dictionary.where(F.col("field").isin(list(suggester.fields)))
            .groupBy("index_name", "field", "term")
            .agg(F.sum("doc_freq").alias("doc_freq"))
            .where("doc_freq > 0")
        )
        rows = counts.select(
            "index_name",
            F.col("term").alias("text"),
            (field_weight(F.col("field"), suggester.weights) * F.col("doc_freq")).alias("weight"),
            F.lit(None).cast(idx.docs.schema["doc_id"].dataType).alias("doc_id"),
        )
    else:
        rows = value_candidates(idx, suggester.fields, suggester.weights).select(
            "index_name", "text", "weight", "doc_id"
        )
    best = F.struct(F.negative("weight").alias("_w"), F.col("doc_id"))
    return (
        rows.groupBy("index_name", "text")
        .agg(F.min(best).alias("best"))
        .select(
            "index_name",
            F.lit(suggester.name).alias("suggester"),
            "text",
            words(F.col("text")).alias("words"),
            F.negative("best._w").alias("weight"),
            "best.doc_id",
        )
    )


def ensure_suggester(
    spark: SparkSession, folder: str, idx: IndexTables, suggester: Suggester
) -> DataFrame:
    """The written rows of a suggester, built when there are none for this state of its index.

    ``folder`` belongs to one state of the index; the settings of the suggester are part of the
    path, so other weights or fields never meet rows built before.
    """
    settings = hashlib.md5(repr(suggester).encode()).hexdigest()
    path = f"{folder}/{suggester.name}-{settings}"
    rows = build_suggester(idx, suggester)
    order = ["index_name", "text"]
    written = written_once(
        spark,
        path,
        lambda folder_: rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("index_name", "suggester")
        .parquet(folder_),
    )
    return spark.read.schema(rows.schema).parquet(written)


def use_suggester(
    idx: IndexTables, rows: DataFrame, suggester: Suggester, term: str, results: int = RESULTS
) -> DataFrame:
    """Complete from the rows of a built suggester."""
    typed = typed_words(term) if len(term.strip()) >= suggester.min_chars else []
    source = rows.where(F.col("suggester") == suggester.name).select(
        "text", "weight", "index_name", "doc_id"
    )
    return _complete(
        idx, source, typed, suggester.use_terms, results, list(suggester.result_fields)
    )


def result_suggestions(
    idx: IndexTables,
    terms: str,
    fields: str | Sequence[str],
    predicate: str = "",
    results: int = RESULTS,
) -> DataFrame:
    """Documents with any of the typed words beginning a term of any field, under a condition."""
    typed = typed_words(terms)
    if not typed:
        return paging(*sort_order(find(idx, P.none()), idx), 1, results)
    prefixes = P.any(*[P.prefix(f, w) for f in split_names(fields) for w in typed])
    base = condition(idx, predicate)
    wanted = P.bool(must=[prefixes], filters=[base]) if base is not None else prefixes
    return paging(*sort_order(find(idx, wanted), idx), 1, results)
