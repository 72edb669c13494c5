"""Analyzers turn a text column into an array of terms.

An analyzer is a function ``Column -> Column`` giving ``ARRAY<STRING>``. The index of an element is
the position of its word; a removed word leaves a null so that later positions keep their gaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.arrays import runs

Analyzer = Callable[[Column], Column]

# The classic English stop words.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they",
    "this", "to", "was", "will", "with",
)
# Fixed value: anything but letters and digits separates words.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lowercase words of a text, stop words included."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda word: word != "")


def analyze_standard(text: Column) -> Column:
    """Lowercase words; stop words become nulls."""
    return F.transform(
        words(text), lambda word: F.when(~word.isin(*STOP_WORDS), word)
    )


def analyze_keyword(text: Column) -> Column:
    """The whole value as one term."""
    return F.array(text)


def term_positions(terms: Column) -> Column:
    """``ARRAY<STRUCT<term, position>>`` of the kept terms."""
    placed = F.transform(
        terms, lambda term, i: F.struct(term.alias("term"), i.alias("position"))
    )
    return F.filter(placed, lambda t: t["term"].isNotNull())


def term_vector(terms: Column) -> Column:
    """``ARRAY<STRUCT<term, positions ARRAY<INT>>>``, one element per distinct term.

    Sorting the occurrences inside the row and cutting the array where the term changes needs no
    shuffle, and costs n log n however long the text is.
    """
    return F.transform(
        runs(F.sort_array(term_positions(terms)), "term"),
        lambda run: F.struct(
            run[0]["term"].alias("term"),
            F.transform(run, lambda t: t["position"]).alias("positions"),
        ),
    )


def tokens(df: DataFrame, text: str, analyzer: Analyzer = analyze_standard) -> DataFrame:
    """One row per kept token of ``text``: the other columns, ``position`` and ``term``."""
    others = [c for c in df.columns if c != text]
    # The plain form would be analyzed twice: once more to filter rows without tokens.
    return df.select(
        *others, F.explode_outer(term_positions(analyzer(F.col(text)))).alias("t")
    ).where(F.col("t").isNotNull()).select(*others, "t.position", "t.term")


def query_slots(
    spark: SparkSession, text: str, analyzer: Analyzer = analyze_standard
) -> list[tuple[str, int]]:
    """Analyzed words of a query with their slots, first slot 0; gaps of removed words stay."""
    row = spark.sql("SELECT 1").select(analyzer(F.lit(text)).alias("terms")).head()
    kept = [(term, i) for i, term in enumerate(row["terms"]) if term is not None]
    return [(term, i - kept[0][1]) for term, i in kept]
