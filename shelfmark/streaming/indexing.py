"""Keeping a written index current from a stream of file events."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.analysis import Analyzer, analyze_standard
from shelfmark.functions.paths import lineage, relative_path
from shelfmark.operators.build import IndexTables
from shelfmark.operators.definitions import IndexDefinition, definition_name, route_destinations
from shelfmark.session import shared_dir
from shelfmark.sources import store
from shelfmark.streaming.events import DELAY_SECONDS, classify_event, keyed_state, quiet_by_the_clock

# What lies in the files looked at now: (index_name, _src) -> (docs, values); absent files give none.
Load = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
# Files that lie below folders now: (folder) -> (path).
Listing = Callable[[DataFrame], DataFrame]


def existing_roots(index: IndexTables, definitions: Sequence[IndexDefinition]) -> DataFrame:
    """(index_name, root) of the indexes that hold something: where their content lies."""
    names = index.field_stats.select("index_name").distinct()
    root = F.coalesce(
        *[F.when(d.matches_name(F.col("index_name")), d.content_path(F.col("index_name"))) for d in definitions],
        F.lit(None).cast("string"),
    )
    return names.withColumn("root", root).where(F.col("root").isNotNull())


def to_look_at(
    due: DataFrame,
    index: IndexTables,
    definitions: Sequence[IndexDefinition],
    listing: Listing,
    root: str = "/",
) -> DataFrame:
    """Files to look at again, (index_name, _src), for quiet events (path, event_class).

    A changed file stands for itself, an added folder for the files below it, a deleted one for the
    documents indexed from below it. Paths are routed by what lies below the content root, to the
    indexes of the definitions and to existing ones whose content holds them.
    """

    def of(kind: str, column: str) -> DataFrame:
        return due.where(F.col("event_class") == kind).select(F.col("path").alias(column)).distinct()

    files = of("file-changed", "_src").unionByName(
        listing(of("folder-added", "folder")).select(F.col("path").alias("_src"))
    )
    inside = F.concat(F.lit("/"), relative_path(F.col("_src"), root))
    routed = route_destinations(
        files.distinct().withColumn("_inside", inside),
        definitions,
        existing_roots(index, definitions),
        "_inside",
    )
    indexed = index.docs.select("index_name", "_src")
    below = indexed.withColumn("folder", F.explode(lineage(F.col("_src"))))
    gone = below.join(of("folder-deleted", "folder"), "folder", "left_semi")
    both = routed.select("index_name", "_src").unionByName(gone.select("index_name", "_src"))
    return both.distinct()


def stream_index(
    events: DataFrame,
    path: str,
    load: Load,
    definitions: Sequence[IndexDefinition],
    checkpoint: str,
    delay_seconds: int = DELAY_SECONDS,
    analyzer: Analyzer = analyze_standard,
    available_now: bool = False,
    listing: Listing | None = None,
    root: str = "/",
) -> StreamingQuery:
    """Wait until paths are quiet, then look at the files again and update the index.

    ``events`` are file events as they come, without a watermark; ``listing`` gives the files below
    added folders (``folder.list_below`` for real ones; without it folders added hold nothing new).
    Quiet periods are measured by the clock and end without further events. A run over what a log
    holds now (``available_now``) waits for nothing: every path in it is looked at once per batch.
    The two ways need checkpoints of their own.

    Every run is recorded: see ``store.batches``. A deleted file is looked at like a changed one
    and, being absent, is removed. A batch run again after a failure is known by its number and the
    checkpoint it belongs to.
    """
    seen = classify_event(events).where(F.col("event_class") != "ignored")
    seen = seen.select("path", "event_class", "ts")
    waits = delay_seconds > 0 and not available_now
    due = quiet_by_the_clock(seen, delay_seconds) if waits else seen

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        begun = time.time()
        # Written down, so that the plans below neither hang on the stream nor read its state again.
        quiet = f"{shared_dir(spark)}/shelfmark/streams/quiet/{uuid.uuid4().hex}"
        batch.select("path", "event_class").distinct().write.parquet(quiet)
        looked = spark.read.schema("path string, event_class string").parquet(quiet)
        touched = None
        try:
            if looked.isEmpty():
                return
            below = listing or (lambda folders: folders.select(F.col("folder").alias("path")).where("false"))
            index = store.must_read(spark, path)
            touched = to_look_at(looked, index, definitions, below, root).persist()
            if touched.count() == 0:
                return
            docs, values = load(touched)
            loaded = time.time()
            label = f"{checkpoint}#{batch_id}"
            store.append_batch(
                spark,
                path,
                label,
                touched,
                docs,
                values,
                definition_name(F.col("index_name"), definitions),
                analyzer,
            )
            store.record_batch(spark, path, label, begun, loaded, touched)
        finally:
            if touched is not None:
                touched.unpersist()

    writer = due.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    with keyed_state(events.sparkSession):
        return writer.trigger(processingTime=f"{max(1, delay_seconds // 4)} seconds").start()
