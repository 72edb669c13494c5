"""What file events mean, and waiting until a file has been quiet.

Events are (path, kind, is_dir, ts), kind being create, modify or delete.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from shelfmark.functions.paths import ancestors, file_name, file_to_path, path_to_file

EVENT = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("is_dir", T.BooleanType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
DELAY_SECONDS = 5
KINDS = ("create", "delete", "modify")
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE_CLASS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def change_stream(spark: SparkSession, log: str, watermark: str | None = "1 minute") -> DataFrame:
    """Events of a log of Parquet files, as a stream."""
    events = spark.readStream.schema(EVENT).option("recursiveFileLookup", "true").parquet(log)
    return events if watermark is None else events.withWatermark("ts", watermark)


def event_class(path: Column, kind: Column, is_dir: Column) -> Column:
    """A deleted path without a dot counts as a folder, as nothing else is left to tell."""
    return (
        F.when((kind == "delete") & ~file_name(path).contains("."), F.lit("folder-deleted"))
        .when((kind == "create") & is_dir, F.lit("folder-added"))
        .when(~is_dir, F.lit("file-changed"))
        .otherwise(F.lit("ignored"))
    )


def classify_event(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "event_class", event_class(F.col("path"), F.col("kind"), F.col("is_dir"))
    )


def _latest_per_folder(events: DataFrame, event_class_: str) -> DataFrame:
    return (
        classify_event(events)
        .where(F.col("event_class") == event_class_)
        .groupBy(F.col("path").alias("folder"))
        .agg(F.max("ts").alias("ts"), F.count("*").alias("events"))
    )


def folder_added(events: DataFrame, files: DataFrame) -> DataFrame:
    """Files below the folders added: (path, folder, ts of the last such event, events).

    Repeated events of a folder become one row first, and files climb to their few ancestors, so the
    result grows with the files, not with files times events.
    """
    return _expand(_latest_per_folder(events, "folder-added"), files)


def folder_deleted(events: DataFrame, docs: DataFrame, root: str) -> DataFrame:
    """Files of the indexed documents below the folders deleted, to be looked at again."""
    folders = _latest_per_folder(events, "folder-deleted").withColumn(
        "folder", file_to_path(F.col("folder"), root)
    )
    found = _expand(folders, docs.select(F.col("_path").alias("path")).distinct())
    return found.withColumn("path", path_to_file(F.col("path"), root))


def _expand(folders: DataFrame, files: DataFrame) -> DataFrame:
    below = files.select("path", F.explode(ancestors(F.col("path"))).alias("folder"))
    return below.join(folders, "folder").select("path", "folder", "ts", "events")


def _stamp(micros: Column, kind: Column) -> Column:
    """Time and kind in one number, so that the latest event is a plain maximum."""
    return micros * len(KINDS) + F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind) - 1


def _kind(stamp: Column) -> Column:
    return F.get(F.array(*[F.lit(k) for k in KINDS]), F.pmod(stamp, F.lit(len(KINDS))).cast("int"))


def debounce_events(events: DataFrame, delay: str = f"{DELAY_SECONDS} seconds") -> DataFrame:
    """One row per (index_name, path) and quiet period: a batch of events.

    Events of one slot as wide as the delay are never apart by more than it. So slots are merged
    first, before any shuffle; a path with very many events is down to one row per slot when its
    slots are put in order.
    """
    keys = ["index_name", "path"]
    width = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval '{delay}')")
    micros = F.unix_micros("ts")
    slots = events.groupBy(*keys, F.floor(micros / width).alias("slot")).agg(
        F.min(micros).alias("first"),
        F.max(micros).alias("last"),
        F.count("*").alias("events"),
        F.max(_stamp(micros, F.col("kind"))).alias("latest"),
    )
    in_order = Window.partitionBy(*keys).orderBy("slot")
    opened = slots.withColumn(
        "opens",
        F.coalesce(
            F.col("first") - F.lag("last").over(in_order) > width, F.lit(True)
        ).cast("int"),
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = opened.withColumn("session", F.sum("opens").over(so_far))
    return numbered.groupBy(*keys, "session").agg(
        F.timestamp_micros(F.min("first")).alias("first_event"),
        F.timestamp_micros(F.max("last")).alias("last_event"),
        F.timestamp_micros(F.max("last") + F.first(width)).alias("due"),
        F.sum("events").alias("events"),
        _kind(F.max("latest")).alias("kind"),
    ).drop("session")


def debounce_stream(events: DataFrame, delay: str = f"{DELAY_SECONDS} seconds") -> DataFrame:
    """The same over a stream that has a watermark: rows come out when their period is over."""
    return (
        events.groupBy("index_name", "path", F.session_window("ts", delay).alias("w"))
        .agg(
            F.min("ts").alias("first_event"),
            F.max("ts").alias("last_event"),
            F.count("*").alias("events"),
            F.max(_stamp(F.unix_micros("ts"), F.col("kind"))).alias("latest"),
        )
        .select(
            "index_name",
            "path",
            "first_event",
            "last_event",
            F.col("w.end").alias("due"),
            "events",
            _kind(F.col("latest")).alias("kind"),
        )
    )


PENDING = "ts long, event_class string, events long, due long"


class QuietPeriods(StatefulProcessor):
    """Keeps what is pending of a path, and a timer for the end of its quiet period.

    State is (ts and class of the latest event, number of events, time of the timer). Every batch with
    events of the path moves the timer; when it goes off, the path comes out once and is forgotten.
    """

    def __init__(self, delay_seconds: float) -> None:
        self.delay_ms = int(delay_seconds * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", PENDING)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        found = [(r["ts"], r["event_class"], r["events"]) for r in rows]
        if self.pending.exists():
            ts, event_class, events, due = self.pending.get()
            found.append((ts, event_class, events))
            self.handle.deleteTimer(due)
        latest = max(found)
        due = now + self.delay_ms
        self.pending.update((latest[0], latest[1], sum(e[2] for e in found), due))
        self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        _, event_class, events, _ = self.pending.get()
        self.pending.clear()
        yield Row(path=key[0], event_class=event_class, events=events)

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per path and batch of rows: its latest event and how many there were."""
    for batch in batches:
        ordered = batch.sort_values(["ts", "event_class"])
        yield ordered.groupby("path", sort=False, as_index=False).agg(
            ts=("ts", "last"), event_class=("event_class", "last"), events=("event_class", "size")
        )


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state by key and timer, which the default store cannot."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, STATE_STORE_CLASS)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def quiet_by_the_clock(seen: DataFrame, delay_seconds: float = DELAY_SECONDS) -> DataFrame:
    """Paths (path, event_class, events) of a stream (path, event_class, ts) once none of their events
    came for so many seconds. The class is that of the path's latest event.

    What counts is the clock: a timer per path ends its period without any later event of any path.
    What is pending outlives a restart. Start the query inside ``keyed_state``. A path with very many
    events is one row per batch of rows when it is shuffled. Events without a path are left out.
    """
    combined = (
        seen.where(F.col("path").isNotNull())
        .select("path", "event_class", F.coalesce(F.unix_micros("ts"), F.lit(-(2**62))).alias("ts"))
        .mapInPandas(_combined, "path string, ts long, event_class string, events long")
    )
    return combined.groupBy("path").transformWithState(
        QuietPeriods(delay_seconds), "path string, event_class string, events long", "Append", "ProcessingTime"
    )


def debounce(events: DataFrame, delay_seconds: int = DELAY_SECONDS) -> DataFrame:
    """Debounce with a delay; without one every event stands for itself."""
    if delay_seconds <= 0:
        return debounce_off(events)
    delay = f"{delay_seconds} seconds"
    return debounce_stream(events, delay) if events.isStreaming else debounce_events(events, delay)


def debounce_off(events: DataFrame) -> DataFrame:
    return events.select(
        "index_name",
        "path",
        F.col("ts").alias("first_event"),
        F.col("ts").alias("last_event"),
        F.col("ts").alias("due"),
        F.lit(1).cast("long").alias("events"),
        "kind",
    )
