"""Reports on indexes, fields and past runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import date_iso, date_kind, truncate_text
from shelfmark.operators.build import IndexTables
from shelfmark.operators.definitions import IndexDefinition, definition_name

RECENT_BATCHES = 200


def visible_fields(df: DataFrame, column: str = "field") -> DataFrame:
    return df.where(~F.col(column).startswith("_"))


def index_definition_join(
    indexes: DataFrame, definitions: Sequence[IndexDefinition]
) -> DataFrame:
    """Each index with its definition and mapping, null when it has none."""
    known = indexes.withColumn("definition", definition_name(F.col("index_name"), definitions))
    mapping = F.lit(None).cast("string")
    for d in definitions:
        mapping = F.when(F.col("definition") == d.name, F.lit(d.mapping)).otherwise(mapping)
    return known.withColumn("mapping", mapping)


def index_summary(
    docs: DataFrame, deleted: DataFrame | None, definitions: Sequence[IndexDefinition]
) -> DataFrame:
    """Per index: live documents, documents with pending deletions, last change, definition.

    ``deleted`` holds one row (index_name, …) per deletion not yet applied.
    """
    held = docs.select("index_name", F.lit(0).alias("gone"), "_lastmodified")
    if deleted is not None:
        held = held.unionByName(
            deleted.select(
                "index_name", F.lit(1).alias("gone"), F.lit(None).cast("timestamp").alias("_lastmodified")
            )
        )
    counts = held.groupBy("index_name").agg(
        F.sum(1 - F.col("gone")).alias("max_doc"),
        F.sum("gone").alias("pending"),
        F.max("_lastmodified").alias("last_modified"),
    )
    return index_definition_join(counts, definitions).select(
        "index_name",
        (F.col("max_doc") - F.col("pending")).alias("documents"),
        "max_doc",
        (F.col("pending") > 0).alias("deletions"),
        "last_modified",
        "definition",
        "mapping",
    )


def field_doc_counts(idx: IndexTables) -> DataFrame:
    """Per index and visible field, the documents having it."""
    counts = visible_fields(idx.field_stats).groupBy("index_name", "field")
    return counts.agg(F.sum("documents").alias("documents")).where("documents > 0")


def list_indexes(registry: DataFrame, docs: DataFrame) -> DataFrame:
    """Every registered index, with or without documents."""
    counts = docs.groupBy("index_name").agg(
        F.count("*").alias("n"), F.max("_lastmodified").alias("last_modified")
    )
    return registry.join(counts, "index_name", "left").select(
        "index_name",
        F.col("n").isNotNull().alias("exists"),
        F.coalesce("n", F.lit(0)).alias("documents"),
        "last_modified",
    )


def document_preview(
    fields: DataFrame, docs: DataFrame, path: str | None = None
) -> DataFrame:
    """One row per field value of the document at ``path``, or of every document."""
    keys = ["index_name", "doc_id"]
    chosen = docs.select(*keys, F.col("_path").alias("path"))
    if path is not None:
        chosen = chosen.where(F.col("path") == path)
    # Texts are cut before they meet the documents, so that no whole text is shuffled.
    shown = truncate_text(date_iso(F.col("field"), F.col("value")))
    short = fields.select(
        *keys,
        "field",
        "ord",
        date_kind(F.col("field"), F.col("value")).alias("date_kind"),
        "boost",
        "stored",
        "tokenized",
        shown.alias("cut"),
    )
    return short.join(chosen, keys).select(
        "index_name", "path", "field", "ord", "date_kind", "boost", "stored", "tokenized", "cut.text", "cut.truncated"
    )


def batch_stats(batches: DataFrame) -> DataFrame:
    """Past runs with their durations in milliseconds."""
    return batches.select(
        "batch_id",
        "index_name",
        "documents",
        "created",
        "index_ms",
        "compute_ms",
        (F.col("index_ms") + F.col("compute_ms")).alias("total_ms"),
        "finished",
    )


def recent_batches(batches: DataFrame, n: int = RECENT_BATCHES) -> DataFrame:
    return batches.orderBy(F.desc("created"), F.desc("batch_id")).limit(n)


def fingerprint(
    docs: DataFrame, params: dict[str, str] | None = None
) -> DataFrame:
    """One hash that changes when a document of an index of ``docs``, its time, or a parameter changes.

    A file put back with an older time counts as a change. Hashes are added up, of documents and then
    of indexes, which needs no order and no list of either in one place.
    """

    def hashed(state: Column) -> Column:
        return F.conv(F.substring(F.md5(state), 1, 12), 16, 10).cast("decimal(38,0)")

    document = F.concat_ws("%", F.col("doc_id").cast("string"), F.unix_millis("_lastmodified"))
    per_index = docs.groupBy("index_name").agg(F.count("*").alias("n"), F.sum(hashed(document)).alias("state"))
    part = hashed(F.concat_ws("%", "index_name", "n", "state"))
    asked = "%".join(f"{k}={v}" for k, v in sorted((params or {}).items()))
    return per_index.agg(
        F.md5(F.concat_ws("%", F.lit(asked), F.coalesce(F.sum(part), F.lit(0)))).alias(
            "fingerprint"
        )
    )
