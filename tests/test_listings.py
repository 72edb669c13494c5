"""A stream of what listings of folders differ by."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark.streaming import listings

DAY = dt.datetime(2024, 5, 1)


def listing(spark, files):
    rows = [(path, DAY + dt.timedelta(days=day), size) for path, (day, size) in files.items()]
    return listings.with_folders(spark.createDataFrame(rows, "path STRING, modified TIMESTAMP, length LONG"), "/c")


def run(spark, folder, name, out, start=0):
    query = (
        listings.listing_stream(spark, folder, start)
        .writeStream.format("parquet")
        .option("path", str(out))
        .option("checkpointLocation", f"{out}-{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted((r["path"], r["kind"], r["is_dir"]) for r in spark.read.parquet(str(out)).collect())


def test_events_between_listings(spark, tmp_path, monkeypatch):
    folder, out = str(tmp_path / "log"), tmp_path / "seen"
    first = {"/c/a/1.psml": (0, 5), "/c/a/2.psml": (0, 5), "/c/b/3.psml": (0, 5), "/c/b/4.psml": (0, 5)}
    assert listings.take_listing(listing(spark, first), folder, 1e9) == 1
    want = [(p, "create", False) for p in first] + [("/c/a", "create", True), ("/c/b", "create", True)]
    assert run(spark, folder, "s", out) == sorted(want)
    # 1 stays, 2 is newer, 3 has another size at the same time, 4 and its folder go, 5 and its folder come
    second = {"/c/a/1.psml": (0, 5), "/c/a/2.psml": (1, 5), "/c/a/3.psml": (0, 5), "/c/d/5.psml": (2, 1)}
    assert listings.take_listing(listing(spark, second), folder, 2e9) == 2
    changes = [
        ("/c/a/2.psml", "modify", False), ("/c/b/3.psml", "delete", False), ("/c/b/4.psml", "delete", False),
        ("/c/b", "delete", True), ("/c/a/3.psml", "create", False), ("/c/d/5.psml", "create", False),
        ("/c/d", "create", True),
    ]
    # A restart goes on where the stream stopped, and a run without news adds nothing.
    assert run(spark, folder, "s", out) == sorted(want + changes)
    assert run(spark, folder, "s", out) == sorted(want + changes)
    third = {**second, "/c/a/1.psml": (0, 6)}
    listings.take_listing(listing(spark, third), folder, 3e9)
    # Replayed from its start by another query, in many tasks, it gives the same and what came since.
    monkeypatch.setattr(listings, "ROWS_A_TASK", 2)
    again = run(spark, folder, "other", tmp_path / "again")
    assert again == sorted([*want, *changes, ("/c/a/1.psml", "modify", False)])
    assert run(spark, folder, "late", tmp_path / "late", start=2) == [("/c/a/1.psml", "modify", False)]


def test_times_and_awkward_listings(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert listings._last(folder) == 0
    none = listing(spark, {"/c/x": (0, 0)}).where("false")
    listings.take_listing(none, folder, 1e9)
    listings.take_listing(listing(spark, {"/c/a/1": (3, 1)}), folder, 2e9)
    listings.take_listing(none, folder, 3e9)
    # One cut short is not seen.
    none.withColumn("h", F.lit(1).cast("long")).write.parquet(f"{folder}/files/listing=4")
    assert listings._last(folder) == 3
    run(spark, folder, "s", tmp_path / "seen")
    rows = spark.read.parquet(str(tmp_path / "seen")).select("path", "kind", F.unix_micros("ts").alias("ts")).collect()
    day = int((DAY + dt.timedelta(days=3)).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert sorted(map(tuple, rows)) == [
        ("/c/a", "create", 2 * 10**15), ("/c/a", "delete", 3 * 10**15),
        ("/c/a/1", "create", day), ("/c/a/1", "delete", 3 * 10**15),
    ]


def test_ranges_cover_every_hash(spark, tmp_path):
    folder = str(tmp_path / "log")
    files = {f"/c/f{n}/x": (0, n) for n in range(50)}
    listings.take_listing(listing(spark, files), folder, 1e9)
    reader = listings.ListingReader(folder, 0)
    parts = reader.partitions({"listing": 0}, {"listing": 1})
    assert parts[0].low == -(2**63) and parts[-1].high == 2**63
    paths = [p for part in parts for batch in reader.read(part) for p in batch["path"].to_pylist()]
    assert len(paths) == len(set(paths)) == 100
    with pytest.raises(StopIteration):
        next(iter(reader.partitions({"listing": 1}, {"listing": 1})))
