"""Events of folders from listings: what came, changed or went between one listing and the next.

Where nothing reports the changes of a file store, its files are listed now and then (``take_listing``)
and a stream source compares each listing with the one before. Listings are Parquet tables sorted by a
hash of the path, so that a task compares one range of hashes, as large in rows as any other. A listing
is never changed, so that a batch run again gives the same events.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from shelfmark.functions.paths import ancestors
from shelfmark.sources.folder import open_path
from shelfmark.streaming.events import EVENT

FORMAT = "folder-changes"
#: Files of a listing that one task compares, about.
ROWS_A_TASK = 200_000
STATE = ["modified", "length"]


def with_folders(files: DataFrame, root: str) -> DataFrame:
    """Files (path, modified, length) and, as rows without either, the folders they lie in, below ``root``."""
    inside = F.explode(ancestors(F.col("path"))).alias("path")
    folders = files.select(inside).distinct().where(F.col("path").startswith(root.rstrip("/") + "/"))
    nothing = [F.lit(None).cast("timestamp").alias("modified"), F.lit(None).cast("long").alias("length")]
    return files.select("path", *STATE, F.lit(False).alias("is_dir")).unionByName(
        folders.select("path", *nothing, F.lit(True).alias("is_dir"))
    )


def take_listing(files: DataFrame, folder: str, taken: float) -> int:
    """Write the listing after the last one below ``folder`` and give its number, counted from 1.

    ``files`` are (path, modified, length, is_dir), each path once; ``taken`` is the time (epoch
    seconds) that deletions are reported with. It counts once its number of rows is written, last.
    """
    number = _last(folder) + 1
    rows = files.where("path is not null").select("path", *STATE, "is_dir", F.xxhash64("path").alias("h"))
    table = f"{folder}/files/listing={number}"
    rows.repartitionByRange("h").sortWithinPartitions("h").write.mode("overwrite").parquet(table)
    spark = files.sparkSession
    spark.read.parquet(table).agg(F.count("*").alias("rows"), F.lit(int(taken * 1e6)).alias("taken")).coalesce(
        1
    ).write.mode("overwrite").json(f"{folder}/done/listing={number}")
    return number


def _last(folder: str) -> int:
    """The number of the last complete listing; 0 where there is none."""
    system, path = open_path(f"{folder}/done")
    names = [f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]
    numbers = sorted((int(n.removeprefix("listing=")) for n in names if n.startswith("listing=")), reverse=True)
    return next((n for n in numbers if _done(folder, n)), 0)


def _done(folder: str, number: int) -> dict | None:
    """Rows and time of a listing, or None while it is not complete."""
    system, path = open_path(f"{folder}/done/listing={number}")
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    if not any(f.base_name == "_SUCCESS" for f in found):
        return None
    part = next(f.path for f in found if f.base_name.startswith("part-") and f.size)
    with system.open_input_stream(part) as file:
        return json.loads(file.read())


class Range(InputPartition):
    """Listing ``number`` against the one before, for hashes from ``low`` up to ``high``, this one left out."""

    def __init__(self, number: int, low: int, high: int, taken: int) -> None:
        self.number, self.low, self.high, self.taken = number, low, high, taken


class ListingReader(DataSourceStreamReader):
    """Offsets are numbers of listings."""

    def __init__(self, folder: str, start: int) -> None:
        self.folder, self.start = folder, start

    def initialOffset(self) -> dict:  # noqa: N802
        return {"listing": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"listing": max(self.start, _last(self.folder))}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        found = []
        for number in range(start["listing"] + 1, end["listing"] + 1):
            now = _done(self.folder, number)
            before = _done(self.folder, number - 1) if number > 1 else None
            rows = max(now["rows"], before["rows"] if before else 0)
            tasks = -(-rows // ROWS_A_TASK) or 1
            bounds = [-(2**63) + k * 2**64 // tasks for k in range(tasks + 1)]
            found += [Range(number, low, high, now["taken"]) for low, high in zip(bounds, bounds[1:])]
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        now, before = (self._rows(n, partition) for n in (partition.number, partition.number - 1))
        both = now.append_column("here", pa.array([True] * len(now), pa.bool_())).join(
            before.append_column("there", pa.array([True] * len(before), pa.bool_())),
            "path", join_type="full outer", right_suffix="_before",
        )
        here, there = (pc.is_valid(both[c]) for c in ("here", "there"))
        same = None
        for name in (*STATE, "is_dir"):
            a, b = both[name], both[f"{name}_before"]
            equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
            same = equal if same is None else pc.and_(same, equal)
        kind = pc.if_else(there, pc.if_else(here, "modify", "delete"), "create")
        taken = pa.scalar(partition.taken, pa.timestamp("us", "UTC"))
        events = pa.table({
            "path": both["path"],
            "kind": kind,
            "is_dir": pc.coalesce(both["is_dir"], both["is_dir_before"]),
            # a folder has no time of its own
            "ts": pc.if_else(here, pc.coalesce(both["modified"], taken), taken),
        }).filter(pc.invert(pc.and_(pc.and_(here, there), same)))
        yield from events.combine_chunks().to_batches()

    def _rows(self, number: int, part: Range) -> pa.Table:
        columns = {"path": pa.string(), "modified": pa.timestamp("us", "UTC"), "length": pa.int64(), "is_dir": pa.bool_()}
        schema = pa.schema({**columns, "h": pa.int64()})
        if number < 1:
            return schema.empty_table().select(list(columns))
        system, path = open_path(f"{self.folder}/files/listing={number}")
        h = ds.field("h")
        inside = (h >= pa.scalar(part.low, pa.int64())) & (h <= pa.scalar(part.high - 1, pa.int64()))
        table = ds.dataset(path, filesystem=system, format="parquet").to_table(filter=inside)
        return table.cast(schema.remove_metadata()).select(list(columns)) if table.num_rows else schema.empty_table().select(list(columns))

    def commit(self, end: dict) -> None:
        """Listings stay; whoever takes them removes old ones."""


class FolderChanges(DataSource):
    """The source ``folder-changes``: option ``path`` names the folder of the listings, ``start`` the
    listing after which events begin (0: the first listing is one of files that came)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return EVENT

    def streamReader(self, schema) -> ListingReader:  # noqa: N802
        return ListingReader(self.options["path"], int(self.options.get("start", 0)))


def listing_stream(spark: SparkSession, folder: str, start: int = 0) -> DataFrame:
    """Events (path, kind, is_dir, ts) between the listings below ``folder``, as a stream.

    Files are created, modified (time, length or kind differs) or deleted; what is the same gives no
    event, nor do empty listings or listings not yet complete.
    """
    spark.dataSource.register(FolderChanges)
    return spark.readStream.format(FORMAT).option("start", start).load(folder)
