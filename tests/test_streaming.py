"""Events, quiet periods, and an index kept by a stream."""

import datetime as dt
import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.build import field_values
from shelfmark.operators.definitions import IndexDefinition, route_index
from shelfmark.sources import folder, store
from shelfmark.streaming import events as ev
from shelfmark.streaming import indexing

BOOKS = IndexDefinition("books", "book-{name}", "/c/book-{name}")
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def event_rows(spark, rows):
    return spark.createDataFrame([(p, k, d, at(s)) for p, k, d, s in rows], ev.EVENT)


def test_classes(spark):
    rows = [
        ("/c/folder", "delete", False, 0), ("/c/f.psml", "delete", False, 0), ("/c/new", "create", True, 0),
        ("/c/f.psml", "create", False, 0), ("/c/old", "modify", True, 0), ("/c/f.x", "modify", False, 0),
    ]
    got = [r["event_class"] for r in ev.classify_event(event_rows(spark, rows)).collect()]
    assert got == ["folder-deleted", "file-changed", "folder-added", "file-changed", "ignored", "file-changed"]


def test_folders_are_expanded_below_only(spark):
    files = spark.createDataFrame([("/c/a/f.psml",), ("/c/a/b/g.psml",), ("/c/ab/h.psml",)], "path STRING")
    added = event_rows(spark, [("/c/a", "create", True, 0), ("/c/a", "create", True, 9)])
    rows = ev.folder_added(added, files).collect()
    assert sorted((r["path"], r["events"]) for r in rows) == [("/c/a/b/g.psml", 2), ("/c/a/f.psml", 2)]
    docs = spark.createDataFrame([("/a/f",), ("/a/b/g",), ("/ab/h",)], "_path STRING")
    gone = ev.folder_deleted(event_rows(spark, [("/c/a", "delete", True, 0)]), docs, "/c").collect()
    assert sorted(r["path"] for r in gone) == ["/c/a/b/g.psml", "/c/a/f.psml"]


def brute_sessions(rows, delay):
    by_path = {}
    for path, kind, _, second in sorted(rows, key=lambda r: (r[3], r[1])):
        sessions = by_path.setdefault(path, [])
        if sessions and second - sessions[-1][1] <= delay:
            sessions[-1] = (sessions[-1][0], second, sessions[-1][2] + 1, kind)
        else:
            sessions.append((second, second, 1, kind))
    return sorted((p, *s) for p, found in by_path.items() for s in found)


def as_tuples(df):
    second = lambda c: F.unix_timestamp(c) - int(T0.timestamp())
    return sorted(
        tuple(r) for r in df.select("path", second("first_event"), second("last_event"), "events", "kind").collect()
    )


def test_quiet_periods_match_brute_force(spark):
    draw = random.Random(7)
    rows = [
        (f"/c/book-1/{draw.choice('aaaaab')}.psml", draw.choice(ev.KINDS), False, draw.randrange(4000))
        for _ in range(600)
    ]
    for delay in (1, 5, 20):
        got = as_tuples(ev.debounce_events(route_index(event_rows(spark, rows), BOOKS), f"{delay} seconds"))
        assert got == brute_sessions(rows, delay)


def test_no_delay_passes_every_event_on(spark):
    rows = [("/c/book-1/a.psml", "modify", False, s) for s in (0, 0, 1)]
    assert ev.debounce(route_index(event_rows(spark, rows), BOOKS), 0).count() == 3


def test_one_file_in_two_indexes_is_two_entries(spark):
    rows = event_rows(spark, [("/c/f.psml", "modify", False, 0)])
    twice = rows.withColumn("index_name", F.explode(F.array(F.lit("x"), F.lit("y"))))
    assert ev.debounce(twice).count() == 2


def write_log(spark, log, rows):
    event_rows(spark, rows).coalesce(1).write.mode("append").parquet(log)


def test_stream_agrees_with_batch_on_closed_periods(spark, tmp_path):
    draw = random.Random(3)
    rows = [(f"/c/book-1/{draw.randrange(5)}.psml", "modify", False, draw.randrange(2000)) for _ in range(300)]
    log = str(tmp_path / "log")
    write_log(spark, log, rows)
    routed = route_index(ev.change_stream(spark, log, "10 seconds"), BOOKS)
    out = str(tmp_path / "out")
    query = (
        ev.debounce(routed, 5).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    last = max(r[3] for r in rows)
    closed = [s for s in brute_sessions(rows, 5) if s[2] + 5 <= last - 10]
    assert as_tuples(spark.read.parquet(out)) == closed


@pytest.fixture()
def shelf(spark, tmp_path):
    """An empty index, a folder of files given as a dict, and a way to run the stream."""
    files = {}
    path, log = str(tmp_path / "index"), str(tmp_path / "log")
    schema = "_src STRING, body STRING"

    def load(touched):
        there = spark.createDataFrame(list(files.items()), schema)
        present = touched.join(there, "_src").withColumn("doc_id", F.col("_src"))
        docs = present.select("index_name", "doc_id", "_src", F.current_timestamp().alias("_lastmodified"))
        return docs, field_values(present, ["body"])

    store.write_index(
        spark, path, *load(spark.createDataFrame([], "index_name STRING, _src STRING")), F.lit("books")
    )

    def run():
        stream = ev.change_stream(spark, log, None)
        query = indexing.stream_index(
            stream, path, load, [BOOKS], str(tmp_path / "state"), delay_seconds=5, available_now=True
        )
        query.awaitTermination()
        return store.read_index(spark, path)

    return files, log, run, path


def bodies(idx):
    return sorted((r["index_name"], r["doc_id"], r["value"]) for r in idx.fields.collect())


def test_index_kept_by_a_stream(spark, shelf):
    files, log, run, path = shelf
    files |= {"/c/book-1/a.psml": "one", "/c/book-2/b.psml": "two"}
    far = ("/c/elsewhere", "modify", False, 1000)
    write_log(spark, log, [("/c/book-1/a.psml", "create", False, 0), ("/c/book-2/b.psml", "create", False, 1),
                           ("/c/none.psml", "create", False, 1), far])
    write_log(spark, log, [("/c/book-9/late.psml", "create", False, 1000)])
    assert bodies(run()) == [("book-1", "/c/book-1/a.psml", "one"), ("book-2", "/c/book-2/b.psml", "two")]
    # A change and a deletion, picked up by a restarted stream.
    files["/c/book-1/a.psml"] = "changed"
    del files["/c/book-2/b.psml"]
    write_log(spark, log, [("/c/book-1/a.psml", "modify", False, 2000), ("/c/book-2/b.psml", "delete", False, 2001),
                           ("/c/book-9/late.psml", "modify", False, 3000)])
    idx = run()
    assert bodies(idx) == [("book-1", "/c/book-1/a.psml", "changed")]
    assert [r["doc_id"] for r in idx.postings.where("term = 'one'").collect()] == []
    runs = store.batches(spark, path)
    assert runs.agg(F.sum("documents")).head()[0] == 3
    assert all(r["finished"] for r in runs.collect())


def put(root, name, title):
    os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
    with open(os.path.join(root, name), "w") as out:
        out.write(f"<documents><document><field name='title'>{title}</field></document></documents>")


def titles(spark, path):
    rows = store.read_index(spark, path).fields.where("field = 'title'").collect()
    return sorted((r["index_name"], os.path.basename(r["doc_id"]), r["value"]) for r in rows)


@pytest.mark.parametrize("waiting", [False, True])
def test_folders_of_a_real_root(spark, tmp_path, waiting):
    """Files and folders come and go below a content root; nothing happens after the last event."""
    root, path, log = (str(tmp_path / n) for n in ("content", "index", "log"))
    books = IndexDefinition("books", "book-{name}", "/books/{name}")
    put(root, "books/a/old/one.psml", "one")
    put(root, "books/a/two.psml", "two")
    folder.index_folder(spark, path, root, books)
    shutil.rmtree(os.path.join(root, "books/a/old"))
    put(root, "books/a/new/deep/three.psml", "three")
    put(root, "books/a/two.psml", "changed")
    write_log(spark, log, [
        (f"{root}/books/a/old", "delete", True, 0), (f"{root}/books/a/new", "create", True, 0),
        (f"{root}/books/a/two.psml", "modify", False, 0), (f"{root}/elsewhere.psml", "modify", False, 0),
    ])
    query = indexing.stream_index(
        ev.change_stream(spark, log, None), path, folder.folder_loader(spark, root), [books],
        str(tmp_path / "state"), delay_seconds=2, available_now=not waiting, listing=folder.list_below, root=root,
    )
    wanted = [("book-a", "three.psml", "three"), ("book-a", "two.psml", "changed")]
    try:
        until = time.time() + 40
        while waiting and query.isActive and time.time() < until and titles(spark, path) != wanted:
            time.sleep(1)
        # A batch is readable before it is recorded; a query stopped in between records it when started again.
        while waiting and query.isActive and time.time() < until and store.batches(spark, path).where("batch_id > 1").isEmpty():
            time.sleep(1)
        if not waiting:
            query.awaitTermination()
    finally:
        query.stop()
    assert query.exception() is None, str(query.exception())[:2000]
    assert titles(spark, path) == wanted
    assert store.batches(spark, path).where("batch_id > 1").agg(F.sum("documents")).head()[0] == 2


def test_quiet_periods_outlive_a_restart(spark, tmp_path):
    """A path comes out once, after the delay, with its latest class; what is pending survives a restart."""
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    came = []

    def start(delay):
        seen = ev.classify_event(ev.change_stream(spark, log, None)).select("path", "event_class", "ts")
        quiet = ev.quiet_by_the_clock(seen, delay)
        with ev.keyed_state(spark):
            return (
                quiet.writeStream.foreachBatch(lambda batch, _: came.extend((time.time(), *r) for r in batch.collect()))
                .option("checkpointLocation", state).trigger(processingTime="1 second").start()
            )

    write_log(spark, log, [("/c/a", "delete", True, 5), ("/c/a", "create", True, 9), ("/c/b.psml", "create", False, 1),
                           ("/c/b.psml", "modify", False, 1), (None, "modify", False, 1)])
    query = start(12)
    try:
        until = time.time() + 40
        while time.time() < until and query.isActive and not query.lastProgress:
            time.sleep(0.3)
        query.stop()
        assert came == []
        query = start(12)
        write_log(spark, log, [("/c/b.psml", "delete", False, 0), ("/c/new.psml", "create", False, 0)])
        until = time.time() + 60
        while time.time() < until and query.isActive and len(came) < 3:
            time.sleep(0.5)
        time.sleep(3)
    finally:
        query.stop()
    assert query.exception() is None, str(query.exception())[:2000]
    assert sorted(r[1:] for r in came) == [
        ("/c/a", "folder-added", 2), ("/c/b.psml", "file-changed", 3), ("/c/new.psml", "file-changed", 1),
    ]
