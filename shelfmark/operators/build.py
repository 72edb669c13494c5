"""Building the index tables.

``values`` rows are (index_name, doc_id, field, ord, value, tokenized, stored, boost): one row per
value of a field. From them come

* ``fields``: the values with their length and term vector,
* ``postings``: one row per (index, field, term, document, value),
* ``dictionary``: document frequencies, ``field_stats``: counts and lengths, ``catalog``: fields.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.analysis import Analyzer, analyze_standard, term_vector
from shelfmark.functions.distance import deletions

#: Marks of the beginning and the end of a term in its grams.
GRAM_BEGIN, GRAM_END = "\x02", "\x03"
VALUE_COLUMNS = ("index_name", "doc_id", "field", "ord", "value", "tokenized", "stored", "boost")


def field_values(
    docs: DataFrame,
    tokenized: Sequence[str] = (),
    untokenized: Sequence[str] = (),
    boosts: dict[str, float] | None = None,
    ord_column: Column | None = None,
) -> DataFrame:
    """Value rows from the columns of ``docs`` (index_name, doc_id, …); nulls give no row.

    Tokenized and other columns are read apart, so that whoever wants the short values only does
    not read the texts.
    """
    boosts = boosts or {}
    ord_ = (F.lit(0) if ord_column is None else ord_column).cast("int").alias("ord")

    def branch(names: Sequence[str], flag: bool) -> DataFrame:
        cells = [
            F.struct(
                F.lit(name).alias("field"),
                F.col(name).cast("string").alias("value"),
                F.lit(float(boosts.get(name, 1.0))).cast("float").alias("boost"),
            )
            for name in names
        ]
        return (
            docs.select("index_name", "doc_id", ord_, F.explode(F.array(*cells)).alias("cell"))
            .where(F.col("cell.value").isNotNull())
            .select(
                "index_name",
                "doc_id",
                "cell.field",
                "ord",
                "cell.value",
                F.lit(flag).alias("tokenized"),
                F.lit(True).alias("stored"),
                "cell.boost",
            )
        )

    parts = [branch(n, flag) for n, flag in ((tokenized, True), (untokenized, False)) if n]
    return reduce(DataFrame.unionByName, parts)


def analyze_values(values: DataFrame, analyzer: Analyzer = analyze_standard) -> DataFrame:
    """Value rows with ``length`` (kept tokens) and ``terms`` (term vector). No shuffle."""
    whole = F.array(
        F.struct(F.col("value").alias("term"), F.array(F.lit(0)).alias("positions"))
    )
    terms = F.when(F.col("tokenized"), term_vector(analyzer(F.col("value")))).otherwise(whole)
    analyzed = values.select(*VALUE_COLUMNS, terms.alias("terms"))
    length = F.aggregate(
        "terms", F.lit(0), lambda n, t: n + F.size(t["positions"])
    )
    return analyzed.withColumn("length", length)


def repeated_fields(catalog: DataFrame) -> list[str]:
    """Fields with several values in some document; as few rows as there are fields."""
    return [r["field"] for r in catalog.where("repeated").select("field").distinct().collect()]


def postings(fields: DataFrame, repeated: Sequence[str]) -> DataFrame:
    """One row per term, document and value; ``length`` is the length of the whole document field.

    Carrying the length with the posting means that scoring needs no second lookup. Only fields
    with repeated values need their lengths added up. The outer form of explode keeps the optimizer
    from testing beforehand, and so before any exchange, whether a term vector is empty.
    """
    narrow = fields.select("index_name", "field", "doc_id", "ord", "length", "terms")
    many = F.col("field").isin(list(repeated)) if repeated else F.lit(False)
    rows = narrow.where(~many)
    if repeated:
        keys = ["index_name", "field", "doc_id"]
        lengths = (
            fields.where(many).groupBy(*keys).agg(F.sum("length").cast("int").alias("length"))
        )
        rows = rows.unionByName(narrow.where(many).drop("length").join(lengths, keys))
    return rows.select(
        "index_name", "field", "doc_id", "ord", "length", F.explode_outer("terms").alias("t")
    ).where(F.col("t").isNotNull()).select(
        "index_name",
        "field",
        "t.term",
        "doc_id",
        "ord",
        F.size("t.positions").alias("tf"),
        "length",
        "t.positions",
    )


def count_documents(
    rows: DataFrame, keys: Sequence[str], repeated: Sequence[str], alias: str
) -> DataFrame:
    """Documents per key. Only fields with repeated values can show a document twice."""
    many = F.col("field").isin(list(repeated)) if repeated else F.lit(False)
    single = rows.where(~many).groupBy(*keys).agg(F.count("*").alias(alias))
    if not repeated:
        return single
    doc = F.struct("index_name", "doc_id")
    return single.unionByName(
        rows.where(many).groupBy(*keys).agg(F.count_distinct(doc).alias(alias))
    )


def dictionary(postings_: DataFrame, repeated: Sequence[str]) -> DataFrame:
    return count_documents(postings_, ["index_name", "field", "term"], repeated, "doc_freq")


def variants(dictionary_: DataFrame) -> DataFrame:
    """Terms under what is left of them after deletions, so that near ones are found by equality."""
    return dictionary_.select(
        "index_name", "field", F.explode_outer(deletions(F.col("term"))).alias("variant"), "term", "doc_freq"
    )


def grams(dictionary_: DataFrame) -> DataFrame:
    """Terms under every two and three neighbouring letters, marks for beginning and end included."""
    marked = F.concat(F.lit(GRAM_BEGIN), F.col("term"), F.lit(GRAM_END))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - (n - 1)))
        return F.transform(starts, lambda i: F.substring(marked, i, F.lit(n)))

    pieces = F.concat(of_length(2), of_length(3))
    return dictionary_.select("index_name", "field", F.explode_outer(F.array_distinct(pieces)).alias("gram"), "term")


def pattern_grams(pattern: str) -> list[str]:
    """Grams that every term of a ``?``/``*`` pattern has: threes, and twos of pieces that short."""
    found = set()
    for piece in re.split(r"[?*]", f"{GRAM_BEGIN}{pattern}{GRAM_END}"):
        n = min(3, len(piece))
        if n > 1:
            found |= {piece[i : i + n] for i in range(len(piece) - n + 1)}
    return sorted(found)


def field_stats(fields: DataFrame, repeated: Sequence[str]) -> DataFrame:
    """Per index and field: documents having the field, documents with terms, and total length."""
    keys = ["index_name", "field"]
    rows = fields.select("index_name", "field", "doc_id", "length", "tokenized")
    lengths = rows.groupBy(*keys).agg(F.sum("length").alias("total_len"))
    having = count_documents(rows, keys, repeated, "documents")
    with_terms = count_documents(rows.where("length > 0"), keys, repeated, "doc_count")
    return (
        lengths.join(having, keys)
        .join(with_terms, keys, "left")
        .select(*keys, "documents", F.coalesce("doc_count", F.lit(0)).alias("doc_count"), "total_len")
    )


def catalog(fields: DataFrame, definition: Column) -> DataFrame:
    """Fields per definition with their flags, inferred from what was indexed."""
    return (
        fields.select("index_name", "doc_id", "field", "ord", "tokenized", "stored")
        .withColumn("definition", definition)
        .groupBy("definition", "field")
        .agg(
            F.bool_or("tokenized").alias("tokenized"),
            F.bool_or("stored").alias("stored"),
            (F.max("ord") > 0).alias("repeated"),
        )
    )


@dataclass(frozen=True)
class IndexTables:
    """The tables of one or several indexes, and what the catalog says of their fields."""

    docs: DataFrame
    fields: DataFrame
    postings: DataFrame
    dictionary: DataFrame
    field_stats: DataFrame
    catalog: DataFrame
    variants: DataFrame
    grams: DataFrame
    tokenized: frozenset[str] = frozenset()
    untokenized: frozenset[str] = frozenset()
    repeated: frozenset[str] = frozenset()

    def select(self, names: str | Sequence[str] | None) -> IndexTables:
        """The named indexes only. Unknown names drop out; no name at all means ``default``."""
        from shelfmark.functions.text import names as split_names

        wanted = split_names(names) or ["default"]
        keep = F.col("index_name").isin(wanted)
        return replace(
            self,
            docs=self.docs.where(keep),
            fields=self.fields.where(keep),
            postings=self.postings.where(keep),
            dictionary=self.dictionary.where(keep),
            field_stats=self.field_stats.where(keep),
            variants=self.variants.where(keep),
            grams=self.grams.where(keep),
        )

    def is_repeated(self, field: str) -> bool:
        return field in self.repeated


def with_catalog(tables: IndexTables) -> IndexTables:
    """Read the flags of the catalog: one row per field, however many documents there are."""
    rows = tables.catalog.select("field", "tokenized", "repeated").distinct().collect()
    tokenized = frozenset(r["field"] for r in rows if r["tokenized"])
    return replace(
        tables,
        tokenized=tokenized,
        untokenized=frozenset(r["field"] for r in rows) - tokenized,
        repeated=frozenset(r["field"] for r in rows if r["repeated"]),
    )


def build_index(
    docs: DataFrame,
    values: DataFrame,
    definition: Column,
    analyzer: Analyzer = analyze_standard,
) -> IndexTables:
    """All tables as plans over the input, for small inputs; large ones are written in steps."""
    fields = analyze_values(values, analyzer)
    fields_catalog = catalog(fields, definition)
    repeated = repeated_fields(fields_catalog)
    posted = postings(fields, repeated)
    words = dictionary(posted, repeated)
    return with_catalog(
        IndexTables(
            docs=docs,
            fields=fields,
            postings=posted,
            dictionary=words,
            field_stats=field_stats(fields, repeated),
            catalog=fields_catalog,
            variants=variants(words),
            grams=grams(words),
        )
    )
