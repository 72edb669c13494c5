"""Indexing a content folder: compare, read what changed, and bring the index up to date."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import paths
from shelfmark.functions.analysis import Analyzer, analyze_standard
from shelfmark.operators.build import VALUE_COLUMNS
from shelfmark.operators.changes import incremental_diff
from shelfmark.operators.definitions import IndexDefinition
from shelfmark.session import shared_dir
from shelfmark.sources import store
from shelfmark.sources.files import (
    CREATOR,
    list_folder,
    parse_documents,
    plain_root,
)

# Content (index_name, _src, content) -> value rows; one file may give several documents.
Mapping = Callable[[DataFrame], DataFrame]


def index_documents(content: DataFrame) -> DataFrame:
    """The default mapping: files hold index XML. Documents are told apart by file and number."""
    parsed = parse_documents(content.select("index_name", "_src", "content"))
    number = F.when(F.col("doc_no") > 0, F.concat(F.lit("#"), F.col("doc_no").cast("string")))
    return parsed.withColumn(
        "doc_id", F.concat("_src", F.coalesce(number, F.lit("")))
    ).select("_src", *VALUE_COLUMNS)


def open_path(name: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a plain path or a URI (hdfs, s3, gs and the others that Arrow knows)."""
    if "://" not in name:
        return fs.LocalFileSystem(), name
    return fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # A file at a time, so that a task holds no more than one content.
        for n, name in enumerate(batch["_src"].tolist()):
            system, path = open_path(name)
            info = system.get_file_info(path)
            if info.type != fs.FileType.File:
                continue
            try:
                with system.open_input_stream(path) as file:
                    content = file.read()
            except FileNotFoundError:
                continue
            modified = pd.Timestamp(info.mtime_ns // 1_000_000, unit="ms")
            yield batch.iloc[[n]].assign(modificationTime=modified, content=[content])


def read_files(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Content of the files named in ``wanted`` (index_name, _src) that are there.

    Names stay rows, dealt over tasks that open one file after the other; whatever their number,
    nothing else is read, a name is not taken for a pattern, and a file that is gone gives no row.
    """
    names = wanted.select("_src", "index_name")
    schema = T.StructType(names.schema.fields).add("modificationTime", "timestamp").add("content", "binary")
    return names.repartition("_src").mapInPandas(_contents, schema)


def present(
    content: DataFrame, root: str, mapping: Mapping, staging: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents and value rows of read files.

    With ``staging``, a folder every executor can reach, the value rows are written there first, so
    that contents are read and parsed once however many tables are made of them.
    """
    values = mapping(content)
    if staging is not None:
        values.write.mode("overwrite").parquet(staging)
        values = content.sparkSession.read.schema(values.schema).parquet(staging)
    times = content.select("index_name", "_src", "modificationTime")
    docs = (
        values.select("index_name", "doc_id", "_src")
        .distinct()
        .join(times, ["index_name", "_src"])
        .select(
            "index_name",
            "doc_id",
            "_src",
            paths.file_to_path(F.col("_src"), plain_root(root)).alias("_path"),
            paths.file_name(F.col("_src")).alias("_filename"),
            F.col("modificationTime").cast("timestamp").alias("_lastmodified"),
            F.lit(CREATOR).alias("_creator"),
        )
    )
    return docs, values.select(*VALUE_COLUMNS)


def index_folder(
    spark: SparkSession,
    path: str,
    root: str,
    definition: IndexDefinition,
    mapping: Mapping = index_documents,
    folder: str = "/",
    path_regex: str | None = None,
    modified_after: str | None = None,
    use_index_date: bool = True,
    analyzer: Analyzer = analyze_standard,
) -> DataFrame:
    """Bring the index under ``path`` up to date with the files below ``root``.

    Gives the difference that was worked off. Contents are read of new and changed files only.
    """
    name = F.lit(definition.name)
    index = store.read_index(spark, path)
    listed = list_folder(spark, root).select(
        F.col("path").alias("_src"), F.col("modificationTime").alias("modified")
    )
    if index is None:
        nothing = listed.where(F.lit(False)).select(
            F.lit("").alias("index_name"),
            "_src",
            F.col("modified").alias("modificationTime"),
            F.lit(b"").alias("content"),
        )
        index = store.write_index(spark, path, *present(nothing, root, mapping), name, analyzer)
    # Other definitions may keep indexes of the same files here; these are not looked at.
    own = index.docs.where(definition.matches_name(F.col("index_name")))
    existing = own.groupBy("_src").agg(F.min("_lastmodified").alias("_lastmodified"))
    accepted = paths.file_filter(
        F.col("rel"), definition.files_include, definition.files_exclude
    )
    # Written down, so that the run works off one state of the folder, whatever happens to it.
    run = f"{path}/runs/{uuid.uuid4().hex}"
    incremental_diff(
        listed, existing, plain_root(root), folder, path_regex, modified_after, use_index_date, accepted
    ).write.parquet(f"{run}/diff")
    diff = spark.read.parquet(f"{run}/diff")
    inside = F.concat(F.lit("/"), paths.relative_path(F.col("_src"), plain_root(root)))
    routed = diff.where(F.col("action") != "ignore").select(
        definition.route(inside).alias("index_name"), "_src", "action"
    )
    touched = routed.where(F.col("index_name").isNotNull())
    to_read = touched.where(F.col("action") != "delete").select("index_name", "_src")
    if not touched.isEmpty():
        begun = time.time()
        content = read_files(spark, root, to_read)
        docs, values = present(content, root, mapping, f"{run}/values")
        computed = time.time()
        store.append_batch(spark, path, run, touched, docs, values, name, analyzer)
        store.record_batch(spark, path, run, begun, computed, touched)
    return diff


def list_below(folders: DataFrame) -> DataFrame:
    """Paths of the files below folders (folder), listed by tasks; one that is gone has none."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["folder"].tolist():
                system, path = open_path(name)
                scheme = name[: len(name) - len(path)] if name.endswith(path) else ""
                found = system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=True))
                yield pd.DataFrame(
                    {"path": [scheme + f.path for f in found if f.type == fs.FileType.File]}, dtype="object"
                )

    names = folders.select("folder").distinct()
    return names.repartition("folder").mapInPandas(work, "path string").distinct()


def folder_loader(
    spark: SparkSession, root: str, mapping: Mapping = index_documents
) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """What a stream of events needs to look at files again.

    The values of a batch are written once, below the folder of ``spark.checkpoint.dir``, so that
    all tables come from one state of the files.
    """

    def load(touched: DataFrame) -> tuple[DataFrame, DataFrame]:
        staging = f"{shared_dir(spark)}/shelfmark/looked-at/{uuid.uuid4().hex}"
        return present(read_files(spark, root, touched), root, mapping, staging)

    return load
