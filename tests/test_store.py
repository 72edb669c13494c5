"""Written indexes: reading back, batches of changes, clearing and deleting."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shelfmark.operators import changes, completions, definitions as de, reports, search, suggest, terms
from shelfmark.operators.build import field_values
from shelfmark.operators.definitions import IndexDefinition, Suggester
from shelfmark.operators.predicates import P
from shelfmark.sources import store

DEFINITION = F.lit  # the definition column of every test: F.lit("d")
FIRST = {1: "quick brown fox", 2: "lazy dog", 3: "quick dog", 4: "the end"}


def content(spark, texts, index="i"):
    rows = [(index if k < 100 else "other", k, f"/r/{k}.psml", t, "old") for k, t in texts.items()]
    df = spark.createDataFrame(rows, "index_name STRING, doc_id BIGINT, _src STRING, fulltext STRING, kind STRING")
    docs = df.select("index_name", "doc_id", "_src", F.timestamp_seconds(F.lit(0)).alias("_lastmodified"))
    return docs, field_values(df, ["fulltext"], ["kind"])


@pytest.fixture()
def path(spark, tmp_path):
    target = str(tmp_path / "index")
    store.write_index(spark, target, *content(spark, {**FIRST, 100: "quick other"}), F.lit("d"))
    return target


def everything(idx):
    """All an index says, order aside."""
    idx = idx.select("i,other")
    counts = lambda df, *keys: sorted(tuple(r) for r in df.groupBy(*keys).sum().collect())
    live = lambda rows: [r for r in rows if any(r[len(r) // 2 + 1:])]
    return {
        "docs": sorted(tuple(r) for r in idx.docs.select("index_name", "doc_id", "_src").collect()),
        "fields": sorted(tuple(r) for r in idx.fields.select("doc_id", "field", "value", "length").collect()),
        "postings": sorted(
            tuple(r) for r in idx.postings.select("index_name", "field", "term", "doc_id", "tf", "length").collect()
        ),
        "terms": sorted(tuple(r) for r in terms.index_terms(idx, "fulltext").collect()),
        "kinds": sorted(tuple(r) for r in terms.index_terms(idx, "kind").collect()),
        "stats": sorted(tuple(r) for r in reports.field_doc_counts(idx).collect()),
        "scores": sorted(tuple(r) for r in search.find(idx, P.term("fulltext", "quick")).collect()),
    }


def rebuilt(spark, tmp_path, texts):
    target = str(tmp_path / f"rebuilt-{len(texts)}-{hash(tuple(texts.values()))}")
    return everything(store.write_index(spark, target, *content(spark, texts), F.lit("d")))


def touched(spark, ids):
    return spark.createDataFrame([("i", f"/r/{k}.psml") for k in ids], "index_name STRING, _src STRING")


def test_read_back(spark, path):
    assert everything(store.read_index(spark, path)) == everything(store.read_index(spark, path, 0))
    assert store.read_index(spark, path + "-none") is None


def test_a_batch_gives_what_a_fresh_build_gives(spark, path, tmp_path):
    # 2 changes, 3 is gone, 5 is new; 1 and 4 are left alone.
    docs, values = content(spark, {2: "quick lazy quick", 5: "end of dog"})
    idx = store.append_batch(spark, path, "one", touched(spark, [2, 3, 5]), docs, values, F.lit("d"))
    want = {1: FIRST[1], 4: FIRST[4], 2: "quick lazy quick", 5: "end of dog", 100: "quick other"}
    assert everything(idx) == rebuilt(spark, tmp_path, want)
    # Run again, as after a restart, it changes nothing.
    again = store.append_batch(spark, path, "one", touched(spark, [2, 3, 5]), docs, values, F.lit("d"))
    assert everything(again) == everything(idx)
    # A second batch removes what the first one brought.
    nothing = content(spark, {2: "x"})
    none = tuple(df.where(F.lit(False)) for df in nothing)
    last = store.append_batch(spark, path, "two", touched(spark, [2, 5]), *none, F.lit("d"))
    left = {k: v for k, v in want.items() if k not in (2, 5)}
    assert everything(last) == rebuilt(spark, tmp_path, left)
    assert everything(store.read_index(spark, path, 1)) == everything(idx)
    gone = sorted(r["doc_id"] for r in store.pending_deletions(spark, path).collect())
    assert gone == [2, 2, 3, 5]
    compacted = store.compact(spark, path, str(tmp_path / "compact"), F.lit("d"))
    assert everything(compacted) == everything(last)
    assert store.pending_deletions(spark, str(tmp_path / "compact")).count() == 0


def test_a_batch_cut_short_is_not_seen_and_written_anew(spark, path, tmp_path):
    before = everything(store.read_index(spark, path))
    docs, values = content(spark, {1: "unfinished", 9: "unfinished"})
    store.write_table(docs, path, "docs", 1)
    store._write_fields(values, path, 1, store.analyze_standard)
    assert everything(store.read_index(spark, path)) == before
    docs, values = content(spark, {9: "finished"})
    idx = store.append_batch(spark, path, "one", touched(spark, [9]), docs, values, F.lit("d"))
    want = {**FIRST, 9: "finished", 100: "quick other"}
    assert everything(idx) == rebuilt(spark, tmp_path, want)


def test_batches_at_the_same_time_come_one_after_the_other(spark, path, tmp_path):
    def batch(label, text):
        docs, values = content(spark, {2: text, 5: text})
        return store.append_batch(spark, path, label, touched(spark, [2, 5]), docs, values, F.lit("d"))

    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(batch), label, label) for label in ("red", "blue")]
        for job in jobs:
            job.result()
    labels = [r["label"] for r in store._manifests(spark, path, None)]
    assert sorted(labels) == ["blue", "build", "red"] and store.last_version(spark, path) == 2
    want = {**FIRST, 2: labels[-1], 5: labels[-1], 100: "quick other"}
    assert everything(store.read_index(spark, path)) == rebuilt(spark, tmp_path, want)


def test_a_version_claimed_by_a_run_that_died(spark, path):
    system, target = store._claim_file(spark, path, 1)
    out = system.create(target, False)
    out.write(bytearray(b"dead"))
    out.close()
    docs, values = content(spark, {9: "finished"})
    store.append_batch(spark, path, "one", touched(spark, [9]), docs, values, F.lit("d"), lease_seconds=0)
    assert store.version_of(spark, path, "one") == 1 and store._claimed_by(spark, path, 1) == "one"
    # A batch that fails gives its version up.
    with pytest.raises(AnalysisException):
        store.append_batch(spark, path, "two", touched(spark, [9]), docs, values.drop("field"), F.lit("d"))
    assert store._claimed_by(spark, path, 2) is None


def test_completions_follow_their_index(spark, path, monkeypatch):
    suggester = Suggester("s", ("fulltext", "kind"), weights={"kind": 2.0})
    asked = ["qu", "quick", "do la", "the e", "o", "ol", "dog.", "x", "brown fox quick", "'qu"]

    def compared():
        idx = store.must_read(spark, path)
        found = completions.current_completions(spark, path, suggester)
        for typed in asked:
            plain = suggest.suggest(idx, typed, ["fulltext", "kind"], weights={"kind": 2.0})
            made = completions.complete(idx, found, suggester, typed)
            columns = ["rank", "text", "weight", "highlight", "doc_id"]
            assert made.select(columns).collect() == plain.select(columns).collect(), typed
        return found

    before = compared()
    written = before.words.inputFiles()
    assert completions.current_completions(spark, path, suggester).words.inputFiles() == written
    plan = completions.matching(before, ["quick"])._jdf.queryExecution().toString()
    assert "StringStartsWith(word,quick)" in plan
    short = completions.matching(before, ["qu"])._jdf.queryExecution().toString()
    assert "EqualTo(start,qu)" in short and "RLIKE" not in short
    docs, values = content(spark, {2: "quicker", 6: "quaint old dogs", 7: "quick"})
    store.append_batch(spark, path, "more", touched(spark, [1, 2]), docs, values, F.lit("d"))
    assert compared().words.inputFiles() != written


def test_beginnings_keep_the_heaviest_texts(spark):
    rows = [("aa ab", 1.0), ("aab", 3.0), ("ac", 2.0), ("b", 5.0), ("aaa", 3.0), ("", 9.0)]
    df = spark.createDataFrame([("i", "s", t, t.split(), w, 1) for t, w in rows],
                               "index_name STRING, suggester STRING, text STRING, words ARRAY<STRING>, weight DOUBLE, doc_id LONG")
    found = completions.heaviest(completions.by_word(df), kept=2, short=2)
    got = {}
    for r in found.collect():
        got.setdefault(r["start"], set()).add(r["text"])
    assert got == {"a": {"aaa", "aab"}, "aa": {"aaa", "aab"}, "ab": {"aa ab"}, "ac": {"ac"}, "b": {"b"}}


def test_clear_keeps_the_name_and_delete_does_not(spark, path):
    names = spark.createDataFrame([("i",), ("other",), ("bad name",)], "index_name STRING")
    definitions = [IndexDefinition("a", "i", "/i"), IndexDefinition("b", "ot{name}", "/o/{name}")]
    created = de.create_index(names, definitions)
    assert {r["index_name"]: r["status"] for r in created.collect()} == {
        "i": "created", "other": "created", "bad name": "create-failed",
    }
    store.register(spark, path, created)
    assert store.clear_index(spark, path, ["i", "nowhere"]) == ["i"]
    idx = store.read_index(spark, path)
    listed = reports.list_indexes(store.registry(spark, path), idx.docs).collect()
    assert {r["index_name"]: (r["exists"], r["documents"]) for r in listed} == {"i": (False, 0), "other": (True, 1)}
    with pytest.raises(ValueError, match="one index"):
        store.delete_index(spark, path, ["i", "other"])
    assert store.delete_index(spark, path, "other") == "deleted"
    assert store.delete_index(spark, path, "other") == "delete-failed"
    assert [r["index_name"] for r in store.registry(spark, path).collect()] == ["i"]


def test_fingerprint_sees_older_times_and_other_documents(spark):
    def of(rows, params=None):
        docs = spark.createDataFrame(rows, "index_name STRING, doc_id LONG, s INT")
        docs = docs.withColumn("_lastmodified", F.timestamp_seconds("s"))
        return reports.fingerprint(docs, params).head()["fingerprint"]

    first = [("i", 1, 10), ("i", 2, 20), ("j", 3, 5)]
    seen = {of(first), of([("i", 1, 9), *first[1:]]), of([("i", 4, 10), *first[1:]]), of(first, {"a": "b"}), of([])}
    assert len(seen) == 5 and of(first[::-1]) == of(first)


def test_second_diff_is_all_ignore(spark):
    source = spark.createDataFrame(
        [("/r/a.psml", 10), ("/r/b.psml", 20), ("/r/c.psml", 5)], "_src STRING, s INT"
    ).select("_src", F.timestamp_seconds("s").alias("modified"))
    existing = spark.createDataFrame(
        [("/r/b.psml", 10), ("/r/c.psml", 5), ("/r/d.psml", 1)], "_src STRING, s INT"
    ).select("_src", F.timestamp_seconds("s").alias("_lastmodified"))
    diff = changes.incremental_diff(source, existing, "/r")
    assert {r["_src"][3]: r["action"] for r in diff.collect()} == {
        "a": "insert", "b": "update", "c": "ignore", "d": "delete",
    }
    after = changes.apply_changes(existing, diff, source.withColumnRenamed("modified", "_lastmodified"))
    second = changes.incremental_diff(source, after, "/r")
    assert {r["action"] for r in second.collect()} == {"ignore"}


def test_diff_window_leaves_the_rest_alone(spark):
    source = spark.createDataFrame([("/r/x/a.psml",), ("/r/y/b.psml",)], "_src STRING").select(
        "_src", F.timestamp_seconds(F.lit(100)).alias("modified")
    )
    existing = spark.createDataFrame([("/r/x/old.psml",), ("/r/y/old.psml",), ("/r/xs/old.psml",)], "_src STRING").select(
        "_src", F.timestamp_seconds(F.lit(0)).alias("_lastmodified")
    )
    diff = changes.incremental_diff(source, existing, "/r", folder="x")
    assert {r["_src"]: r["action"] for r in diff.collect() if r["action"] != "ignore"} == {
        "/r/x/a.psml": "insert", "/r/x/old.psml": "delete",
    }
    late = changes.incremental_diff(source, existing, "/r", modified_after="2000-01-01")
    # A file that is there but not new enough is no deletion.
    assert {r["_src"] for r in late.where("action = 'delete'").collect()} == {
        "/r/x/old.psml", "/r/y/old.psml", "/r/xs/old.psml",
    }
    assert late.where("action = 'insert'").count() == 0


def test_report_lists_at_most_a_hundred(spark):
    diff = spark.range(250).select(F.format_string("/r/%04d", "id").alias("_src"), F.lit("insert").alias("action"))
    rows = changes.diff_report(diff).collect()
    assert [r["files"] for r in rows if r["part"] == "total"] == [250]
    assert sum(r["part"] == "file" for r in rows) == 100


def test_fingerprint_follows_documents_and_parameters(spark, path):
    docs = store.read_index(spark, path).docs
    print_ = lambda d, p=None: reports.fingerprint(d, p).head()[0]
    assert print_(docs) == print_(docs.repartition(3))
    assert print_(docs) != print_(docs.where("doc_id <> 1"))
    assert print_(docs, {"page": "1"}) != print_(docs, {"page": "2"})


def test_suggester_is_rebuilt_for_other_settings(spark, path):
    idx = store.read_index(spark, path).select("i,other")
    folder = path + "-suggest"
    one = Suggester("s", ("fulltext", "kind"), weights={"kind": 3.0})
    two = Suggester("s", ("fulltext", "kind"), weights={"kind": 5.0})
    weight = lambda s: suggest.ensure_suggester(spark, folder, idx, s).where("text = 'old'").head()["weight"]
    assert (weight(one), weight(two), weight(one)) == (3.0, 5.0, 3.0)
    rows = suggest.ensure_suggester(spark, folder, idx, one)
    assert suggest.use_suggester(idx, rows, one, "o").count() == 0
    assert [r["text"] for r in suggest.use_suggester(idx, rows, one, "ol").collect()] == ["old"]
