"""Index tables on disk.

Every table is Parquet under ``<path>/<table>/version=<n>/index_name=…/field=…``; postings and
dictionary are sorted by term. Version 0 is the build; later versions are batches of changes, which
add rows and name the documents they replace or remove. Counts of a batch are differences, so adding
up the versions gives the counts of the live documents. A version counts once its manifest is there.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shelfmark.functions import paths
from shelfmark.functions.analysis import Analyzer, analyze_standard
from shelfmark.operators import build
from shelfmark.operators.build import IndexTables
from shelfmark.operators.scoring import HIT

# How each table is laid out: folders, then the order rows are ranged and sorted by.
LAYOUT = {
    "docs": (["index_name"], ["index_name", "doc_id"]),
    "fields": (["index_name", "field"], ["index_name", "field", "doc_id", "ord"]),
    "postings": (["index_name", "field"], ["index_name", "field", "term", "doc_id", "ord"]),
    "dictionary": (["index_name", "field"], ["index_name", "field", "term"]),
    "field_stats": (["index_name"], ["index_name", "field"]),
    "catalog": ([], ["definition", "field"]),
    "deletions": (["index_name"], ["index_name", "doc_id"]),
}
BUILT = [name for name in LAYOUT if name != "deletions"]
#: How long a claimed version may take to be written, and how often a batch that waits looks again.
LEASE_SECONDS = 6 * 3600.0
CLAIM_WAIT_SECONDS = 1.0
#: Rows that a task sorts, and rows of a lookup table per term, about.
ROWS_A_TASK = 2_500_000
LOOKUPS_A_TERM = 25
#: Tables made of the dictionary of a version, on demand, for near terms and patterns.
LOOKUPS = {"variants": build.variants, "grams": build.grams}
LAYOUT |= {
    "variants": (["index_name", "field"], ["index_name", "field", "variant", "term"]),
    "grams": (["index_name", "field"], ["index_name", "field", "gram", "term"]),
}


def _dealt(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """Rows ranged over tasks and sorted in each, by the order of a table.

    ``rows``, where it is known, keeps what a task sorts small enough for memory; without it, or
    for few rows, the session's number of tasks and adaptive execution decide.
    """
    order = LAYOUT[name][1]
    tasks = -(-rows // ROWS_A_TASK)
    many = tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(tasks, *order) if many else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def _write(df: DataFrame, path: str, name: str, version: int, mode: str = "overwrite") -> DataFrame:
    """Write rows already dealt over tasks, then read them back with the schema of the writer."""
    folders = LAYOUT[name][0]
    target = f"{path}/{name}/version={version}"
    # The whole version is replaced, so that a batch run again leaves no rows of the first attempt.
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", "zstd")
    (writer.partitionBy(*folders) if folders else writer).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def write_table(df: DataFrame, path: str, name: str, version: int = 0, rows: int = 0) -> DataFrame:
    """Range the rows over tasks and sort them, so that files are few, even and easy to skip.

    Ranging goes down to the document: a hot index, field or term spreads over as many tasks as its
    size asks for.
    """
    return _write(_dealt(df, name, rows), path, name, version)


def _write_fields(
    values: DataFrame, path: str, version: int, analyzer: Analyzer
) -> DataFrame:
    """Write the value rows with their term vectors.

    Long texts and short values are dealt and written apart, so that tasks get even shares of the
    text. They are sorted before they are analyzed, which keeps their order: what is shuffled and
    sorted is the text, never its term vectors, which are many times as large.
    """
    for kind, mode in ((F.col("tokenized"), "overwrite"), (~F.col("tokenized"), "append")):
        rows = build.analyze_values(_dealt(values.where(kind), "fields"), analyzer)
        written = _write(rows, path, "fields", version, mode)
    return written


def _occurrences(stats: DataFrame) -> int:
    """Occurrences of terms in the fields counted; there are no more postings than that."""
    return stats.agg(F.coalesce(F.sum("total_len"), F.lit(0)).cast("long")).first()[0]


def _at_once(spark: SparkSession, *actions: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run writes that do not need each other side by side, so that none waits for idle cores."""
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [job.result() for job in running]


def write_index(
    spark: SparkSession,
    path: str,
    docs: DataFrame,
    values: DataFrame,
    definition: Column,
    analyzer: Analyzer = analyze_standard,
) -> IndexTables:
    """Build and write every table, each from the written one before it.

    Text is read and analyzed once; later tables read the written term vectors.
    """
    written_docs, fields = _at_once(
        spark,
        lambda: write_table(docs, path, "docs"),
        lambda: _write_fields(values, path, 0, analyzer),
    )
    catalog = write_table(build.catalog(fields, definition), path, "catalog")
    repeated = build.repeated_fields(catalog)
    stats = write_table(build.field_stats(fields, repeated), path, "field_stats")
    postings = write_table(build.postings(fields, repeated), path, "postings", rows=_occurrences(stats))
    dictionary = write_table(build.dictionary(postings, repeated), path, "dictionary")
    tables = dict(
        docs=written_docs, fields=fields, postings=postings, dictionary=dictionary, field_stats=stats, catalog=catalog
    )
    _write_manifest(spark, path, 0, {name: tables[name].schema for name in BUILT})
    return must_read(spark, path)


def append_batch(
    spark: SparkSession,
    path: str,
    label: str,
    touched: DataFrame,
    docs: DataFrame,
    values: DataFrame,
    definition: Column,
    analyzer: Analyzer = analyze_standard,
    lease_seconds: float = LEASE_SECONDS,
) -> IndexTables:
    """Bring an index up to date with one batch of changes, as its next version.

    ``touched`` names the files looked at (index_name, _src); ``docs`` and ``values`` are what is
    there now. Documents of touched files are removed, present ones added. The size of the work is
    that of the batch. ``label`` tells batches apart: one that is already part of the index changes
    nothing, and one that failed half-way is written anew. Batches of one index come one after the
    other: a second one waits, and takes over from a run that died once ``lease_seconds`` are over.
    """
    version = _claim(spark, path, label, lease_seconds)
    if version is None:
        return must_read(spark, path)
    try:
        return _append(spark, path, version, label, touched, docs, values, definition, analyzer)
    except BaseException:
        _release(spark, path, version, label)
        raise


def _claim_file(spark: SparkSession, path: str, version: int):
    """File system and path of what says whose a version is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/claims/{version}")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _claimed_by(spark: SparkSession, path: str, version: int) -> str | None:
    """Label of the batch that a version belongs to, or None where it is free."""
    system, target = _claim_file(spark, path, version)
    if not system.exists(target):
        return None
    rows = spark.read.option("wholetext", "true").text(target.toString()).collect()
    return rows[0]["value"] if rows else ""


def _claim(spark: SparkSession, path: str, label: str, lease_seconds: float) -> int | None:
    """The next version, which from now on is the batch's own; None if the batch is part of the index.

    Of several writers one creates the file; where a file system lets several of them through, the label
    that stays counts. Who comes second waits for the other batch to end and takes the version after
    it: a batch must see what was there before it. A claim older than the lease is of a run that died.
    """
    while True:
        must_read(spark, path)
        known = _manifests(spark, path, None)
        if any(r["label"] == label for r in known):
            return None
        version = known[-1]["version"] + 1
        system, target = _claim_file(spark, path, version)
        try:
            out = system.create(target, False)
        except Py4JJavaError:
            if not system.exists(target):
                raise
        else:
            out.write(bytearray(label.encode()))
            out.close()
        if _claimed_by(spark, path, version) == label:
            return version
        if time.time() - system.getFileStatus(target).getModificationTime() / 1000 > lease_seconds:
            system.delete(target, False)
        else:
            time.sleep(CLAIM_WAIT_SECONDS)


def _release(spark: SparkSession, path: str, version: int, label: str) -> None:
    """Give up a version whose batch failed."""
    if _claimed_by(spark, path, version) == label:
        system, target = _claim_file(spark, path, version)
        system.delete(target, False)


def _append(
    spark: SparkSession,
    path: str,
    version: int,
    label: str,
    touched: DataFrame,
    docs: DataFrame,
    values: DataFrame,
    definition: Column,
    analyzer: Analyzer,
) -> IndexTables:
    """Write the tables of a batch as a version it has claimed."""
    before = must_read(spark, path)
    files = touched.select("index_name", "_src").distinct()
    replaced = before.docs.join(files, ["index_name", "_src"], "left_semi").select(*HIT)
    gone = write_table(replaced, path, "deletions", version)
    old = before.fields.join(gone, HIT, "left_semi")
    new_docs, new = _at_once(
        spark,
        lambda: write_table(docs, path, "docs", version),
        lambda: _write_fields(values, path, version, analyzer),
    )
    catalog = write_table(build.catalog(new, definition), path, "catalog", version)
    repeated = sorted({*before.repeated, *build.repeated_fields(catalog)})
    postings = write_table(build.postings(new, repeated), path, "postings", version)
    terms = _difference(
        build.dictionary(postings, repeated),
        build.dictionary(build.postings(old, repeated), repeated),
        ["index_name", "field", "term"],
    )
    stats = _difference(
        build.field_stats(new, repeated), build.field_stats(old, repeated), ["index_name", "field"]
    )
    dictionary, field_stats = _at_once(
        spark,
        lambda: write_table(terms, path, "dictionary", version),
        lambda: write_table(stats, path, "field_stats", version),
    )
    tables = dict(
        docs=new_docs, fields=new, postings=postings, dictionary=dictionary, field_stats=field_stats, catalog=catalog
    )
    schemas = {name: tables[name].schema for name in BUILT}
    removed = gone.count()
    if _claimed_by(spark, path, version) != label:
        raise RuntimeError(f"version {version} of {path} was taken over while {label} was written")
    _write_manifest(spark, path, version, schemas, removed, label)
    if _looked_up(spark, path):
        add_lookups(spark, path)
    return must_read(spark, path)


def _difference(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Counts added less counts removed, keys that do not change left out."""
    counts = [c for c in new.columns if c not in keys]
    minus = old.select(*keys, *[(-F.col(c)).alias(c) for c in counts])
    net = new.unionByName(minus).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    changed = F.lit(False)
    for c in counts:
        changed = changed | (F.col(c) != 0)
    return net.where(changed)


def _write_manifest(
    spark: SparkSession,
    path: str,
    version: int,
    schemas: dict[str, T.StructType],
    removed: int = 0,
    label: str = "build",
) -> None:
    text = json.dumps({name: schema.json() for name, schema in schemas.items()})
    spark.range(1).select(
        F.lit(text).alias("schemas"),
        F.lit(removed).cast("long").alias("removed"),
        F.lit(label).alias("label"),
    ).write.mode("overwrite").json(f"{path}/manifest/version={version}")


def _only_absent(error: AnalysisException) -> None:
    """A table that is not there yet is no fault; anything else that hinders reading is one."""
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error


def _manifests(spark: SparkSession, path: str, upto: int | None) -> list:
    schema = "schemas STRING, removed BIGINT, label STRING, version BIGINT"
    try:
        rows = spark.read.schema(schema).json(f"{path}/manifest").collect()
    except AnalysisException as error:
        _only_absent(error)
        return []
    return sorted(
        (r for r in rows if upto is None or r["version"] <= upto), key=lambda r: r["version"]
    )


def _read_table(
    spark: SparkSession, path: str, name: str, schema: T.StructType, versions: Sequence[int]
) -> DataFrame:
    """Rows of the given versions, with the schema of the writer and ``version``."""
    versioned = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    rows = spark.read.schema(versioned).parquet(f"{path}/{name}")
    return rows.where(F.col("version").isin(list(versions)))


def last_version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version of the index under ``path``, or None where there is none."""
    known = _manifests(spark, path, None)
    return known[-1]["version"] if known else None


def version_of(spark: SparkSession, path: str, label: str) -> int:
    """The version a batch became."""
    return next(r["version"] for r in _manifests(spark, path, None) if r["label"] == label)


def read_index(spark: SparkSession, path: str, upto: int | None = None) -> IndexTables | None:
    """The live rows of the index under ``path``, or None when there is no complete build."""
    manifests = _manifests(spark, path, upto)
    if not manifests:
        return None
    versions = [r["version"] for r in manifests]
    changed = any(r["removed"] for r in manifests)
    schemas: dict[str, T.StructType] = {}
    for manifest in manifests:
        for name, text in json.loads(manifest["schemas"]).items():
            # Columns that first came with a later batch are null in the rows before.
            known = schemas.setdefault(name, T.StructType())
            for column in T.StructType.fromJson(json.loads(text)).fields:
                if column.name not in known.names:
                    known.add(column)
    read = {name: _read_table(spark, path, name, schemas[name], versions) for name in BUILT}
    if changed:
        ids = T.StructType([schemas["docs"][c] for c in HIT])
        removed = _read_table(spark, path, "deletions", ids, versions).select(
            *[F.col(c).alias(f"_{c}") for c in HIT], F.col("version").alias("_until")
        )
        for name in ("docs", "fields", "postings"):
            df = read[name]
            read[name] = df.join(
                removed,
                (df["index_name"] == F.col("_index_name"))
                & (df["doc_id"] == F.col("_doc_id"))
                & (df["version"] < F.col("_until")),
                "left_anti",
            )
    read["catalog"] = read["catalog"].groupBy("definition", "field").agg(
        *[F.bool_or(flag).alias(flag) for flag in ("tokenized", "stored", "repeated")]
    )
    ready = set(versions) <= _looked_up(spark, path)
    for name, make in LOOKUPS.items():
        made = make(read["dictionary"].drop("version"))
        read[name] = _read_table(spark, path, name, made.schema, versions) if ready else made
    return build.with_catalog(IndexTables(**{n: df.drop("version") for n, df in read.items()}))


def _looked_up(spark: SparkSession, path: str) -> set[int]:
    """Versions whose lookup tables are written."""
    try:
        rows = spark.read.schema("made BOOLEAN, version BIGINT").json(f"{path}/lookups").select("version").collect()
    except AnalysisException as error:
        _only_absent(error)
        return set()
    return {r["version"] for r in rows}


def add_lookups(spark: SparkSession, path: str) -> None:
    """Write the tables that find near terms and patterns, for the versions that have none yet.

    Later batches then bring their own. Without these tables the same lookups read the dictionary.
    The dictionary has few files for what is made of each of its terms, so it is dealt out first.
    """
    made = _looked_up(spark, path)
    for manifest in _manifests(spark, path, None):
        version = manifest["version"]
        if version in made:
            continue
        schema = T.StructType.fromJson(json.loads(json.loads(manifest["schemas"])["dictionary"]))
        words = _read_table(spark, path, "dictionary", schema, [version]).drop("version")
        rows = words.count() * LOOKUPS_A_TERM
        dealt = words.repartition("term")
        _at_once(
            spark,
            *[lambda n=name, f=make: write_table(f(dealt), path, n, version, rows) for name, make in LOOKUPS.items()],
        )
        marker = spark.range(1).select(F.lit(True).alias("made"))
        marker.write.mode("overwrite").json(f"{path}/lookups/version={version}")


def must_read(spark: SparkSession, path: str, upto: int | None = None) -> IndexTables:
    index = read_index(spark, path, upto)
    if index is None:
        raise ValueError(f"no index at {path}")
    return index


def pending_deletions(spark: SparkSession, path: str) -> DataFrame:
    """Deletions held beside the build: (index_name, doc_id), one row per document version."""
    index = must_read(spark, path)
    versions = [r["version"] for r in _manifests(spark, path, None) if r["removed"]]
    ids = T.StructType([index.docs.schema[c] for c in HIT])
    if not versions:
        return index.docs.select(*HIT).where(F.lit(False))
    return _read_table(spark, path, "deletions", ids, versions).drop("version")


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    definition: Column,
    analyzer: Analyzer = analyze_standard,
) -> IndexTables:
    """Write the live documents as a fresh build, without pending deletions."""
    live = must_read(spark, path)
    values = live.fields.select(*build.VALUE_COLUMNS)
    return write_index(spark, target, live.docs, values, definition, analyzer)


def latest_build(spark: SparkSession, folder: str) -> str | None:
    """Path of a complete build below ``folder``, if there is one."""
    try:
        row = (
            spark.read.schema("schemas STRING")
            .json(f"{folder}/*/manifest/version=0")
            .select(F.input_file_name().alias("file"))
            .agg(F.min("file").alias("file"))
            .head()
        )
    except AnalysisException as error:
        _only_absent(error)
        return None
    return row["file"].split("/manifest/")[0] if row["file"] else None


def source_fingerprint(spark: SparkSession, files: Sequence[str]) -> str:
    """A hash of path, size and time of the source files; their content is not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(files))
        .select(F.concat_ws("%", "path", "length", F.unix_micros("modificationTime")).alias("f"))
    )
    total = listed.agg(
        F.sum(F.xxhash64("f").cast("decimal(38,0)")).alias("h"), F.count("*").alias("n")
    ).head()
    return f"{total['n']} files {total['h']}"


BATCH = (
    "batch_id BIGINT, index_name STRING, documents BIGINT, created TIMESTAMP, started TIMESTAMP,"
    " finished BOOLEAN, index_ms BIGINT, compute_ms BIGINT"
)


def record_batch(
    spark: SparkSession, path: str, label: str, begun: float, computed: float, touched: DataFrame
) -> None:
    """Record a finished batch: documents per index, time to compute them and time to index them.

    Every index of ``touched`` has a record, also one that only lost documents. ``begun`` and ``computed`` are the times (epoch seconds) work began and contents were there.
    """
    version = version_of(spark, path, label)
    docs = spark.read.schema("index_name STRING").parquet(f"{path}/docs/version={version}")
    start = F.timestamp_seconds(F.lit(begun))
    counts = docs.groupBy("index_name").agg(F.count("*").alias("documents"))
    touched.select("index_name").distinct().join(counts, "index_name", "left").select(
        F.lit(version).cast("long").alias("batch_id"),
        "index_name",
        F.coalesce("documents", F.lit(0)).alias("documents"),
        start.alias("created"),
        start.alias("started"),
        F.lit(True).alias("finished"),
        F.lit(int((time.time() - computed) * 1000)).cast("long").alias("index_ms"),
        F.lit(int((computed - begun) * 1000)).cast("long").alias("compute_ms"),
    ).write.mode("overwrite").parquet(f"{path}/batches/version={version}")


def batches(spark: SparkSession, path: str) -> DataFrame:
    """Recorded runs of the index under ``path``."""
    try:
        return spark.read.schema(BATCH).parquet(f"{path}/batches")
    except AnalysisException as error:
        _only_absent(error)
        return spark.createDataFrame([], BATCH)


def written_once(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Have ``write`` fill a folder below ``path`` unless that was done before; gives the folder.

    The marker comes last, so that what a failed attempt left is written over.
    """
    folder = f"{path}/rows"
    try:
        spark.read.text(f"{path}/done")
    except AnalysisException as error:
        _only_absent(error)
        write(folder)
        spark.range(1).select(F.lit("done")).write.mode("overwrite").text(f"{path}/done")
    return folder


def ensure_index(
    spark: SparkSession, folder: str, build_at: Callable[[str], IndexTables], lookups: bool = False
) -> IndexTables:
    """Read the build below ``folder``; if there is none, ``build_at`` makes one at a fresh path.

    Meant for folders that stand for one state of the content, where batches are never appended.
    ``lookups`` asks for the lookup tables as well, which are added when they are first asked for.
    """
    found = latest_build(spark, folder)
    if found is None:
        found = f"{folder}/{uuid.uuid4().hex}"
        built = build_at(found)
        if not lookups:
            return built
    key = (spark.sparkContext.applicationId, found, lookups)
    with _LOCK:
        if key not in _OPEN:
            if lookups:
                add_lookups(spark, found)
            _OPEN[key] = must_read(spark, found)
        return _OPEN[key]


# Builds read before by this application: their files are listed once. Only plans are kept.
_OPEN: dict[tuple[str, str, bool], IndexTables] = {}
_LOCK = threading.Lock()


# Registry of index names, empty indexes included, and what removes their data.


def register(spark: SparkSession, path: str, created: DataFrame) -> None:
    """Keep the names created (index_name, definition, status) in the registry."""
    created.where(F.col("status") == "created").select("index_name", "definition").write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("index_name").parquet(
        f"{path}/registry"
    )


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(index_name, definition) of every known index."""
    schema = "definition STRING, index_name STRING"
    try:
        return spark.read.schema(schema).parquet(f"{path}/registry")
    except AnalysisException as error:
        _only_absent(error)
        return spark.createDataFrame([], schema)


def _drop(spark: SparkSession, pattern: str) -> bool:
    """Delete the folders matching a pattern; true when there were any and all are gone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(pattern)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath() for status in system.globStatus(target) or []]
    return bool(found) and all([system.delete(folder, True) for folder in found])


def _checked(name: str) -> str:
    """The name if an index can have it; patterns that would match several indexes cannot be one."""
    if len(name) > paths.INDEX_NAME_CHARS or not re.fullmatch(paths.INDEX_NAME, name, re.ASCII):
        raise ValueError(f"invalid index name {name!r}")
    return name


def clear_index(spark: SparkSession, path: str, names: Sequence[str]) -> list[str]:
    """Empty indexes but keep them known; gives the names that had data."""
    names = [_checked(name) for name in names]
    return [
        name
        for name in names
        if any([
            _drop(spark, f"{path}/{table}/version=*/index_name={name}")
            for table, (folders, _) in LAYOUT.items()
            if folders
        ])
    ]


def delete_index(spark: SparkSession, path: str, names: str | Sequence[str]) -> str:
    """Remove one index and its data: ``deleted``, or ``delete-failed`` when it is not known."""
    wanted = [names] if isinstance(names, str) else list(names)
    if len(wanted) != 1:
        raise ValueError("only one index can be deleted at a time")
    had_data = bool(clear_index(spark, path, wanted))
    was_known = _drop(spark, f"{path}/registry/index_name={wanted[0]}")
    return "deleted" if had_data or was_known else "delete-failed"
