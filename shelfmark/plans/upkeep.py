"""Keeping indexes current, file events, and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfmark.functions.paths import ancestors, file_filter, file_to_path, relative_path
from shelfmark.operators import build, changes, reports
from shelfmark.operators.definitions import (
    IndexDefinition,
    create_index,
    definition_name,
    route_index,
)
from shelfmark.plans import corpora
from shelfmark.plans.corpora import BOOKS, CONTENT_ROOT, DEFINITIONS, documents, talks
from shelfmark.plans.sql import DOCS, EVENT_CLASS, EVENTS, SNAPSHOTS, VALUES
from shelfmark.session import shared_dir
from shelfmark.sources import store
from shelfmark.streaming import events as ev
from shelfmark.streaming import indexing, listings

WINDOW = {"folder": "/documents/en", "path_regex": "/[0-9]*[02468]\\.psml", "modified_after": "2024-01-01"}


def _diff(spark, sf_dir, **window):
    source, existing = corpora.snapshots(spark, sf_dir)
    return changes.incremental_diff(source, existing, CONTENT_ROOT, **window)


def incremental_diff(spark, sf_dir):
    return _diff(spark, sf_dir).select("_src", "action")


def incremental_diff_window(spark, sf_dir):
    """All files inside a folder, matching a regex and changed since a day, whatever their age."""
    accepted = file_filter(F.col("rel"), None, None)
    return _diff(spark, sf_dir, use_index_date=False, accepted=accepted, **WINDOW).select(
        "_src", "action"
    )


def apply_changes(spark, sf_dir):
    source, existing = corpora.snapshots(spark, sf_dir)
    diff = changes.incremental_diff(source, existing, CONTENT_ROOT)
    new_rows = source.withColumn("_lastmodified", F.col("modified")).drop("modified")
    return changes.apply_changes(existing, diff, new_rows).select(
        "_src", "index_name", "doc_id", F.unix_micros("_lastmodified").alias("modified")
    )


def removed_files(spark, sf_dir):
    return changes.removed_files(*corpora.snapshots(spark, sf_dir))


def diff_report(spark, sf_dir):
    return changes.diff_report(_diff(spark, sf_dir))


def source_window(spark, sf_dir):
    source, _ = corpora.snapshots(spark, sf_dir)
    below = F.concat(F.lit("/"), relative_path(F.col("_src"), CONTENT_ROOT))
    return source.where(
        changes.source_window(
            below, F.col("modified"), "documents/fr/", r"[0-9]+\.psml", "2024-01-01"
        )
    ).select("_src")


def _micros(column):
    return F.unix_micros(column)


def index_summary(spark, sf_dir):
    source, existing = corpora.snapshots(spark, sf_dir)
    diff = changes.incremental_diff(source, existing, CONTENT_ROOT)
    deleted = existing.join(
        diff.where(F.col("action") == "delete").select("_src"), "_src", "left_semi"
    )
    summary = reports.index_summary(existing, deleted, DEFINITIONS)
    return summary.withColumn("last_modified", _micros("last_modified"))


def field_doc_counts(spark, sf_dir):
    return reports.field_doc_counts(documents(spark, sf_dir))


def field_doc_counts_repeated(spark, sf_dir):
    return reports.field_doc_counts(talks(spark, sf_dir))


def list_indexes(spark, sf_dir):
    """Indexes named by any definition; those of the books hold no documents yet."""
    docs = corpora.document_docs(spark, sf_dir)
    books = route_index(corpora.file_listing(spark, sf_dir), BOOKS).select("index_name")
    registry = docs.select("index_name").union(books).distinct()
    listed = reports.list_indexes(registry, docs)
    return listed.withColumn("last_modified", _micros("last_modified"))


def catalog(spark, sf_dir):
    return (
        documents(spark, sf_dir)
        .catalog.unionByName(talks(spark, sf_dir).catalog)
        .select("definition", "field", "tokenized", "stored", "repeated")
    )


def _batches(spark, sf_dir):
    """Orders as indexing runs."""
    return corpora.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("batch_id"),
        F.concat(F.lit("docs-"), F.lower(F.substring_index("o_orderpriority", "-", -1))).alias(
            "index_name"
        ),
        F.col("o_custkey").alias("documents"),
        F.col("o_orderdate").cast("timestamp").alias("created"),
        F.floor("o_totalprice").alias("index_ms"),
        F.floor(F.col("o_totalprice") / 4).alias("compute_ms"),
        (F.col("o_orderstatus") == "F").alias("finished"),
    )


def batch_stats(spark, sf_dir):
    return reports.batch_stats(_batches(spark, sf_dir)).withColumn("created", _micros("created"))


def recent_batches(spark, sf_dir):
    return reports.recent_batches(_batches(spark, sf_dir)).select(
        "batch_id", _micros("created").alias("created"), "finished"
    )


def version_fingerprint(spark, sf_dir):
    docs = corpora.document_docs(spark, sf_dir)
    return reports.fingerprint(docs, {"facets": "lang", "base": ""})


def classify_event(spark, sf_dir):
    return ev.classify_event(corpora.file_events(spark, sf_dir)).select(
        "event_id", "path", "event_class"
    )


def _routed(spark, sf_dir):
    return route_index(corpora.file_events(spark, sf_dir), BOOKS)


def _session_columns(df):
    return df.select(
        "index_name",
        "path",
        _micros("first_event").alias("first_event"),
        _micros("last_event").alias("last_event"),
        _micros("due").alias("due"),
        "events",
        "kind",
    )


def debounce_events(spark, sf_dir):
    return _session_columns(ev.debounce_events(_routed(spark, sf_dir), "2 hours"))


def debounce_off(spark, sf_dir):
    return _session_columns(ev.debounce(_routed(spark, sf_dir), 0))


def folder_added(spark, sf_dir):
    found = ev.folder_added(
        corpora.file_events(spark, sf_dir), corpora.file_listing(spark, sf_dir)
    )
    return found.withColumn("ts", _micros("ts"))


def folder_deleted(spark, sf_dir):
    docs = corpora.file_listing(spark, sf_dir).select(
        file_to_path(F.col("path"), "/psml").alias("_path")
    )
    found = ev.folder_deleted(corpora.file_events(spark, sf_dir), docs, "/psml")
    return found.withColumn("ts", _micros("ts"))


def _run_folder(spark, name):
    """A fresh folder for the output and the state of one run of a stream."""
    return f"{shared_dir(spark)}/shelfmark/streams/{name}/{uuid.uuid4().hex}"


def change_stream(spark, sf_dir):
    """Events taken from a log by a stream, told apart and written down."""
    run = _run_folder(spark, "changes")
    log = f"{run}/log"
    corpora.file_events(spark, sf_dir).drop("event_id").write.parquet(log)
    seen = ev.classify_event(ev.change_stream(spark, log))
    query = (
        seen.writeStream.format("parquet")
        .option("path", f"{run}/seen")
        .option("checkpointLocation", f"{run}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(seen.schema).parquet(f"{run}/seen").select(
        "path", "kind", _micros("ts").alias("ts"), "event_class"
    )


def _listed(df, modified):
    rows = df.select(F.col("_src").alias("path"), F.col(modified).alias("modified"), F.lit(None).cast("long").alias("length"))
    return listings.with_folders(rows, CONTENT_ROOT)


def folder_changes(spark, sf_dir):
    """Two listings of the content, taken from one to the other by a stream; what it gives is written down."""
    run = _run_folder(spark, "listings")
    source, existing = corpora.snapshots(spark, sf_dir)
    listings.take_listing(_listed(existing, "_lastmodified"), f"{run}/log", 1_000_000_000)
    listings.take_listing(_listed(source, "modified"), f"{run}/log", 2_000_000_000)
    query = (
        listings.listing_stream(spark, f"{run}/log")
        .writeStream.format("parquet")
        .option("path", f"{run}/seen")
        .option("checkpointLocation", f"{run}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(ev.EVENT).parquet(f"{run}/seen").select("path", "kind", "is_dir", _micros("ts").alias("ts"))


def debounce_stream(spark, sf_dir):
    """Quiet periods of a stream. A heartbeat after the last event, a row without path, ends them all."""
    run = _run_folder(spark, "debounce")
    last = corpora.file_events(spark, sf_dir).agg(F.max("ts").alias("ts"))
    beat = last.select(
        *[F.lit(None).cast(t).alias(c) for c, t in (("path", "string"), ("kind", "string"), ("is_dir", "boolean"))],
        (F.col("ts") + F.expr("interval 4 hours")).alias("ts"),
    )
    beat.write.parquet(f"{run}/beats")
    beats = ev.change_stream(spark, f"{run}/beats", watermark=None)
    events = corpora.file_event_stream(spark, sf_dir).drop("event_id").unionByName(beats)
    quiet = ev.debounce_stream(route_index(events.withWatermark("ts", "1 hour"), BOOKS), "2 hours")
    query = (
        quiet.writeStream.format("parquet")
        .option("path", f"{run}/quiet")
        .option("checkpointLocation", f"{run}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _session_columns(spark.read.schema(quiet.schema).parquet(f"{run}/quiet"))


def _kept_by_stream(spark, sf_dir):
    """Path of an index kept by a stream of all events.

    There are the files whose last event is no deletion and, in every folder, a file ``index`` that
    has no event of its own. Indexed before is a file ``old`` per folder, which is there no more.
    """
    run = _run_folder(spark, "index")
    events = corpora.file_events(spark, sf_dir)
    last = events.where(~F.col("is_dir")).groupBy("path").agg(
        F.max(F.struct("ts", "kind")).getField("kind").alias("kind")
    )
    folders = events.select(F.regexp_replace("path", r"/[^/]*\.psml$", "").alias("folder")).distinct()
    files = last.where(F.col("kind") != "delete").select("path").unionByName(
        folders.select(F.concat("folder", F.lit("/index.psml")).alias("path"))
    )

    def rows(found):
        docs = found.select(
            "index_name",
            F.col("_src").alias("doc_id"),
            "_src",
            file_to_path(F.col("_src"), "/psml").alias("_path"),
            F.timestamp_seconds(F.lit(0)).alias("_lastmodified"),
        )
        return docs, build.field_values(docs, [], ["_path"])

    def load(touched):
        return rows(touched.join(files, touched["_src"] == files["path"]).select("index_name", "_src"))

    def listing(added):
        below = files.select("path", F.explode(ancestors(F.col("path"))).alias("folder"))
        return below.join(added, "folder", "left_semi").select("path").distinct()

    old = folders.select(F.concat("folder", F.lit("/old.psml")).alias("_src"))
    definition = definition_name(F.col("index_name"), DEFINITIONS)
    store.write_index(spark, f"{run}/books", *rows(route_index(old, BOOKS, "_src")), definition)
    query = indexing.stream_index(
        corpora.file_event_stream(spark, sf_dir),
        f"{run}/books",
        load,
        [BOOKS],
        f"{run}/state",
        available_now=True,
        listing=listing,
    )
    query.awaitTermination()
    return f"{run}/books"


def stream_index(spark, sf_dir):
    index = store.read_index(spark, _kept_by_stream(spark, sf_dir))
    return index.docs.select("index_name", "_src", "_path")


def stream_monitor(spark, sf_dir):
    """Documents per index in the recorded runs of a stream."""
    runs = store.batches(spark, _kept_by_stream(spark, sf_dir))
    return (
        runs.where("finished").groupBy("index_name").agg(F.sum("documents").alias("documents"))
    )


def _parts_by_type(spark, sf_dir):
    """Path of a fresh index of the parts, one index per type, with its registry."""
    path = _run_folder(spark, "parts")
    by_type = F.concat(F.lit("type-"), F.lower("type"))
    docs = corpora.part_docs(spark, sf_dir).withColumn("index_name", by_type)
    definition = IndexDefinition("types", "type-{name}", "/types/{name}")
    store.write_index(
        spark, path, docs, build.field_values(docs, ["title"], ["brand"]), F.lit("types")
    )
    store.register(
        spark, path, create_index(docs.select("index_name").distinct(), [definition])
    )
    return path


def _known(spark, path):
    docs = store.read_index(spark, path).docs
    return reports.list_indexes(store.registry(spark, path), docs).select(
        "index_name", "exists", "documents"
    )


def clear_index(spark, sf_dir):
    """One index emptied: still known, without documents."""
    path = _parts_by_type(spark, sf_dir)
    store.clear_index(spark, path, ["type-economy"])
    return _known(spark, path)


def delete_index(spark, sf_dir):
    """One index removed: not known any more."""
    path = _parts_by_type(spark, sf_dir)
    store.delete_index(spark, path, "type-economy")
    return _known(spark, path)




QUERIES = {
    "change_stream": change_stream,
    "folder_changes": folder_changes,
    "debounce_stream": debounce_stream,
    "stream_index": stream_index,
    "stream_monitor": stream_monitor,
    "clear_index": clear_index,
    "delete_index": delete_index,
    "incremental_diff": incremental_diff,
    "incremental_diff_window": incremental_diff_window,
    "apply_changes": apply_changes,
    "removed_files": removed_files,
    "diff_report": diff_report,
    "source_window": source_window,
    "index_summary": index_summary,
    "field_doc_counts": field_doc_counts,
    "field_doc_counts_repeated": field_doc_counts_repeated,
    "list_indexes": list_indexes,
    "catalog": catalog,
    "batch_stats": batch_stats,
    "recent_batches": recent_batches,
    "version_fingerprint": version_fingerprint,
    "classify_event": classify_event,
    "debounce_events": debounce_events,
    "debounce_off": debounce_off,
    "folder_added": folder_added,
    "folder_deleted": folder_deleted,
}

_ACTION = """CASE WHEN s._src IS NULL THEN 'delete' WHEN e._src IS NULL THEN 'insert'
  WHEN s.modified > e.lm THEN 'update' ELSE 'ignore' END"""
_DIFF = f"""{SNAPSHOTS},
diff AS (SELECT coalesce(s._src, e._src) AS _src, coalesce(s.index_name, e.index_name) AS index_name,
                {_ACTION} AS action
         FROM source s FULL JOIN existing e ON s._src = e._src)"""
_BATCHES = """
batches AS (SELECT o_orderkey AS batch_id, o_custkey AS documents, epoch_us(o_orderdate) AS created,
  'docs-' || lower(split_part(o_orderpriority, '-', -1)) AS index_name,
  CAST(floor(o_totalprice) AS BIGINT) AS index_ms,
  CAST(floor(o_totalprice / 4) AS BIGINT) AS compute_ms, o_orderstatus = 'F' AS finished
  FROM orders)"""
_ROUTED = r"'book-' || regexp_extract(path, '^/psml/content/book-([\w\-]+)', 1) AS index_name"
_PLACE = (
    "starts_with(_src, '/data/documents/en/')"
    " AND regexp_full_match(split_part(_src, '/', -1), '[0-9]*[02468]\\.psml')"
)

_QUIET = f"""{EVENTS}, r AS (SELECT *, {_ROUTED} FROM ev),
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens
      FROM r WINDOW w AS (PARTITION BY index_name, path ORDER BY ts, event_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY index_name, path ORDER BY ts, event_id) AS session FROM g),
quiet AS (
  SELECT index_name, path, epoch_us(min(ts)) AS first_event, epoch_us(max(ts)) AS last_event,
         epoch_us(max(ts) + INTERVAL 2 HOUR) AS due, count(*) AS events,
         last(kind ORDER BY ts, kind) AS kind
  FROM n GROUP BY index_name, path, session)"""


_KEPT = f"""{EVENTS},
state AS (SELECT path, last(kind ORDER BY ts, kind) AS kind FROM ev WHERE NOT is_dir GROUP BY path),
folders AS (
  SELECT regexp_replace(path, '/[^/]*\\.psml$', '') AS folder,
         coalesce(bool_or({EVENT_CLASS} = 'folder-added'), false) AS added,
         coalesce(bool_or({EVENT_CLASS} = 'folder-deleted'), false) AS deleted
  FROM ev GROUP BY folder)"""


def _expanded(event_class: str) -> str:
    return f"""WITH {EVENTS},
folders AS (SELECT path AS folder, epoch_us(max(ts)) AS ts, count(*) AS events
            FROM (SELECT *, {EVENT_CLASS} AS c FROM ev) WHERE c = '{event_class}' GROUP BY path)"""


SQL = {
    "incremental_diff": f"WITH {_DIFF} SELECT _src, action FROM diff",
    "incremental_diff_window": f"""WITH {SNAPSHOTS},
w AS (SELECT coalesce(s._src, e._src) AS _src, s._src IS NULL AS gone, e._src IS NULL AS fresh,
             s.modified > 1704067200000000 AS late
      FROM source s FULL JOIN existing e ON s._src = e._src)
SELECT _src, CASE WHEN NOT ({_PLACE}) THEN 'ignore' WHEN gone THEN 'delete'
  WHEN NOT late THEN 'ignore' WHEN fresh THEN 'insert' ELSE 'update' END AS action FROM w""",
    "apply_changes": f"WITH {SNAPSHOTS} SELECT _src, index_name, doc_id, modified FROM source",
    "removed_files": f"WITH {DOCS} SELECT _src FROM docs WHERE doc_id % 10 = 1",
    "folder_changes": f"""WITH {SNAPSHOTS},
changes AS (SELECT coalesce(s._src, e._src) AS path,
                   CASE WHEN s._src IS NULL THEN 'delete' WHEN e._src IS NULL THEN 'create' ELSE 'modify' END AS kind,
                   CASE WHEN s._src IS NULL THEN 2000000000000000 ELSE s.modified END AS ts
            FROM source s FULL JOIN existing e ON s._src = e._src
            WHERE s._src IS NULL OR e._src IS NULL OR s.modified <> e.lm),
dirs AS (SELECT regexp_replace(_src, '/[^/]*$', '') AS path, min(n) AS n, bool_or(n = 1) AS one, bool_or(n = 2) AS two
         FROM (SELECT _src, 1 AS n FROM existing UNION ALL SELECT _src, 2 FROM source) GROUP BY ALL),
parent AS (SELECT '/data/documents' AS path, min(n) AS n, bool_or(one) AS one, bool_or(two) AS two FROM dirs),
every AS (SELECT * FROM dirs UNION ALL SELECT * FROM parent)
SELECT _src AS path, 'create' AS kind, false AS is_dir, lm AS ts FROM existing
UNION ALL SELECT path, kind, false, ts FROM changes
UNION ALL SELECT path, 'create', true, n * 1000000000000000 FROM every
UNION ALL SELECT path, 'delete', true, 2000000000000000 FROM every WHERE NOT two""",
    "diff_report": f"""WITH {_DIFF}
SELECT 'total' AS part, action, count(*) AS files, NULL::VARCHAR AS path FROM diff GROUP BY action
UNION ALL SELECT * FROM (SELECT 'file', action, NULL::BIGINT, _src FROM diff
  WHERE action <> 'ignore' ORDER BY _src LIMIT 100)""",
    "source_window": f"""WITH {SNAPSHOTS} SELECT _src FROM source
WHERE regexp_full_match(_src, '/data/documents/fr/[0-9]+\\.psml') AND modified > 1704067200000000""",
    "index_summary": f"""WITH {SNAPSHOTS}
SELECT index_name, count(*) FILTER (WHERE doc_id % 10 <> 1) AS documents, count(*) AS max_doc,
       bool_or(doc_id % 10 = 1) AS deletions, max(lm) AS last_modified,
       'documents' AS definition, 'default' AS mapping FROM existing GROUP BY index_name""",
    "field_doc_counts": f"""WITH {VALUES}
SELECT index_name, field, count(*) AS documents FROM present GROUP BY ALL
UNION ALL SELECT 'docs-' || lang, 'fulltext', count(*) FROM documents GROUP BY ALL""",
    "field_doc_counts_repeated": """
SELECT 'talks' AS index_name, unnest(['text', 'role']) AS field, count(DISTINCT conv_id) AS documents
FROM conversations""",
    "list_indexes": f"""WITH {DOCS}, {EVENTS},
names AS (SELECT index_name FROM docs UNION SELECT {_ROUTED} FROM listing),
counts AS (SELECT index_name, count(*) AS n, max(lm) AS last_modified FROM docs GROUP BY ALL)
SELECT index_name, n IS NOT NULL AS "exists", coalesce(n, 0) AS documents, last_modified
FROM names LEFT JOIN counts USING (index_name)""",
    "catalog": """
SELECT 'documents' AS definition, unnest(['fulltext', 'lang', 'source', 'n_chars', 'quality', 'toxic'])
  AS field, unnest([true, false, false, false, false, false]) AS tokenized, true AS stored,
  false AS repeated
UNION ALL SELECT 'talks', unnest(['text', 'role']), unnest([true, false]), true,
  (SELECT max(turn) > 0 FROM conversations)""",
    "batch_stats": f"""WITH {_BATCHES} SELECT batch_id, index_name, documents, created, index_ms,
compute_ms, index_ms + compute_ms AS total_ms, finished FROM batches""",
    "recent_batches": f"""WITH {_BATCHES} SELECT batch_id, created, finished FROM batches
ORDER BY created DESC, batch_id DESC LIMIT 200""",
    "version_fingerprint": f"""WITH {DOCS}, per AS (
SELECT index_name || '%' || count(*) || '%'
       || sum(CAST('0x' || substr(md5(doc_id || '%' || (lm // 1000)), 1, 12) AS BIGINT)) AS state
FROM docs GROUP BY index_name)
SELECT md5('base=%facets=lang%' || sum(CAST('0x' || substr(md5(state), 1, 12) AS BIGINT))) AS fingerprint
FROM per""",
    "classify_event": f"WITH {EVENTS} SELECT event_id, path, {EVENT_CLASS} AS event_class FROM ev",
    "debounce_events": f"""WITH {_QUIET} SELECT * FROM quiet""",
    "debounce_stream": f"WITH {_QUIET} SELECT * FROM quiet",
    "change_stream": f"WITH {EVENTS} SELECT path, kind, epoch_us(ts) AS ts,"
    f" {EVENT_CLASS} AS event_class FROM ev",
    # Documents brought in by the stream; an index that only lost some is there with none.
    "stream_monitor": f"""WITH {_KEPT}, looked AS (
  SELECT path, kind <> 'delete' AS brought FROM state
  UNION ALL SELECT folder || '/index.psml', true FROM folders WHERE added
  UNION ALL SELECT folder || '/old.psml', false FROM folders WHERE deleted)
SELECT index_name, count(*) FILTER (WHERE brought) AS documents
FROM (SELECT brought, {_ROUTED} FROM looked) GROUP BY index_name""",
    "clear_index": """
SELECT 'type-' || lower(p_type) AS index_name, p_type <> 'ECONOMY' AS "exists",
       count(*) FILTER (WHERE p_type <> 'ECONOMY') AS documents FROM part GROUP BY p_type""",
    "delete_index": """
SELECT 'type-' || lower(p_type) AS index_name, true AS "exists", count(*) AS documents
FROM part WHERE p_type <> 'ECONOMY' GROUP BY p_type""",
    "stream_index": f"""WITH {_KEPT}, kept AS (
  SELECT path FROM state WHERE kind <> 'delete'
  UNION ALL SELECT folder || '/index.psml' FROM folders WHERE added
  UNION ALL SELECT folder || '/old.psml' FROM folders WHERE NOT deleted)
SELECT {_ROUTED}, path AS _src, regexp_replace(substr(path, 6), '\\.psml$', '') AS _path FROM kept""",
    "debounce_off": f"""WITH {EVENTS} SELECT {_ROUTED}, path, epoch_us(ts) AS first_event,
epoch_us(ts) AS last_event, epoch_us(ts) AS due, 1::BIGINT AS events, kind FROM ev""",
    "folder_added": f"""{_expanded('folder-added')}
SELECT path, folder, f.ts, f.events FROM listing JOIN folders f ON starts_with(path, folder || '/')""",
    "folder_deleted": f"""{_expanded('folder-deleted')}
SELECT path, substr(folder, 6) AS folder, f.ts, f.events
FROM listing JOIN folders f ON starts_with(path, folder || '/')""",
}
