"""Terms of the dictionary: listings and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import names as split_names
from shelfmark.operators.build import IndexTables
from shelfmark.operators.predicates import near_terms

BUCKET = 20


def _added_up(rows: DataFrame) -> DataFrame:
    """Frequencies over all indexes; terms no live document has any more drop out."""
    counts = rows.groupBy("field", "term").agg(F.sum("doc_freq").alias("doc_freq"))
    return counts.where("doc_freq > 0")


def index_terms(idx: IndexTables, field: str) -> DataFrame:
    """All terms of a field with their document frequency, added up over the indexes."""
    return _added_up(idx.dictionary.where(F.col("field") == field)).select("term", "doc_freq")


def top_terms(terms: DataFrame, n: int = BUCKET) -> DataFrame:
    """The most frequent terms; ties go alphabetically."""
    return terms.orderBy(F.desc("doc_freq"), "term", "field").limit(n)


def fuzzy_terms(idx: IndexTables, term: str, field: str = "keyword", n: int = BUCKET) -> DataFrame:
    return top_terms(_added_up(near_terms(idx, field, term)), n)


def prefix_matches(idx: IndexTables, term: str, field: str) -> DataFrame:
    return idx.dictionary.where((F.col("field") == field) & F.col("term").startswith(term))


def prefix_terms(idx: IndexTables, term: str, field: str = "keyword", n: int = BUCKET) -> DataFrame:
    return top_terms(_added_up(prefix_matches(idx, term, field)), n)


def similar_terms(
    idx: IndexTables, term: str, fields: str | Sequence[str] = "fulltext", n: int = BUCKET
) -> DataFrame:
    """Near and completing terms of several fields in one bucket, each term once per field."""
    # A term both near and completing counts once: as a completing one.
    wanted, completing = split_names(fields), F.col("term").startswith(term)
    words = idx.dictionary.where(F.col("field").isin(wanted) & completing)
    near = near_terms(idx, wanted, term).where(~completing)
    columns = ["field", "term", "doc_freq"]
    return top_terms(_added_up(words.select(columns).unionByName(near.select(columns))), n)
