"""Which content belongs to which index, how it is parsed, and the tables built from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import paths, text
from shelfmark.operators import build, definitions as de, reports
from shelfmark.operators.definitions import IndexDefinition
from shelfmark.plans import corpora
from shelfmark.plans.corpora import BOOKS, DEFINITIONS, DOCUMENTS, PAGES, documents
from shelfmark.plans.sql import DOCS, EVENTS, PAGE_DOCS, VALUES, tokens
from shelfmark.sources import files, store

SOME_BOOKS = IndexDefinition(
    "some-books",
    "book-{name}",
    "/psml/content/book-{name}",
    path_excludes=("/psml/content/book-2/", "/psml/content/book-3*"),
)
FILTERED = ("psml/content/book-\\d/(.*)\\.psml", "(.*)/f1/(.*)")
ROOT = "/data/content"


def _pages(spark, sf_dir):
    """Pages as a listing of files below a root."""
    return corpora.page_docs(spark, sf_dir).select(
        F.concat(F.lit(ROOT), "_path", F.lit(".psml")).alias("path"),
        F.col("_lastmodified").alias("modificationTime"),
        "doc_id",
    )


def content_roots(spark, sf_dir):
    return de.content_roots(corpora.file_listing(spark, sf_dir), SOME_BOOKS)


def content_roots_pages(spark, sf_dir):
    pages = corpora.page_docs(spark, sf_dir).withColumnRenamed("_path", "path")
    return de.content_roots(pages, PAGES)


def _index_documents(spark, sf_dir):
    """Every document as index XML: (doc_id, content)."""

    def field(name, value, tokenized):
        return F.struct(
            value.cast("string").alias("_VALUE"),
            F.lit(name).alias("_name"),
            F.lit(tokenized).alias("_tokenize"),
        )

    fields = F.array(
        field("fulltext", F.col("text"), True),
        field("lang", F.col("lang"), False),
        field("source", F.col("source"), False),
    )
    xml = F.to_xml(F.struct(fields.alias("field")), {"rowTag": "document"})
    prolog = F.lit('<?xml version="1.0"?><!DOCTYPE document SYSTEM "index-documents.dtd">')
    return corpora.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(prolog, xml).alias("content")
    )


def parse_index_documents(spark, sf_dir):
    return files.parse_documents(_index_documents(spark, sf_dir)).select(
        "doc_id", "field", "ord", "value", "tokenized", "stored"
    )


def scan_content(spark, sf_dir):
    """Documents written as XML files once, found again by a file filter and parsed."""
    rows = corpora.table(spark, sf_dir, "documents").select(
        F.array(
            F.struct(F.col("doc_id").cast("string").alias("_VALUE"), F.lit("id").alias("_name")),
            F.struct(F.col("text").alias("_VALUE"), F.lit("fulltext").alias("_name")),
        ).alias("field")
    )

    def export(folder):
        # Files of a bounded number of documents: one file is one row when it is read back.
        writer = rows.write.mode("overwrite").format("xml").option("maxRecordsPerFile", 5000)
        writer.option("rowTag", "document").option("rootTag", "documents").save(folder)

    target = store.written_once(
        spark, corpora.DOCUMENT_CORPUS.folder(spark, sf_dir) + "-xml", export
    )
    definition = IndexDefinition("exported", "exported", "/", files_include=r"part-.*\.xml")
    found = files.parse_documents(files.scan_content(spark, target, definition))
    by_document = ["path", "doc_no"]
    ids = found.where(F.col("field") == "id").select(*by_document, F.col("value").alias("id"))
    texts = found.where(F.col("field") == "fulltext").select(*by_document, "value")
    return ids.join(texts, by_document).select(
        F.col("id").cast("long").alias("doc_id"), F.length("value").alias("chars")
    )


def content_reader(spark, sf_dir):
    return files.content_reader(spark, "parquet", f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name"
    )


def enrich_metadata(spark, sf_dir):
    return files.enrich_metadata(_pages(spark, sf_dir), ROOT).select(
        "doc_id", "_src", "_path", "_filename", "_visibility", "_lastmodified", "_creator"
    )


def relative_path(spark, sf_dir):
    path = F.col("path")
    return _pages(spark, sf_dir).select(
        "doc_id",
        paths.relative_path(path, f"{ROOT}/en").alias("below_en"),
        paths.relative_path(path, "/data").alias("below_data"),
    )


def file_to_path(spark, sf_dir):
    upper = F.when(F.col("doc_id") % 2 == 0, F.col("path")).otherwise(
        F.regexp_replace("path", "psml$", "PSML")
    )
    return _pages(spark, sf_dir).select("doc_id", paths.file_to_path(upper, ROOT).alias("_path"))


def path_to_file(spark, sf_dir):
    return corpora.page_docs(spark, sf_dir).select(
        "doc_id", paths.path_to_file(F.col("_path"), ROOT).alias("_src")
    )


def file_filter(spark, sf_dir):
    return files.file_filter(corpora.file_listing(spark, sf_dir), "/", *FILTERED)


def file_filter_default(spark, sf_dir):
    """No regex given: content files only. Half of the pages count as plain XML here."""
    listing = _pages(spark, sf_dir).withColumn(
        "path",
        F.when(F.col("path").contains(".html"), F.regexp_replace("path", "psml$", "xml")).otherwise(
            F.col("path")
        ),
    )
    return files.file_filter(listing, ROOT, None, None).select("doc_id", "path")


def path_excludes(spark, sf_dir):
    listing = corpora.file_listing(spark, sf_dir)
    return listing.where(~paths.is_excluded(F.col("path"), SOME_BOOKS.path_excludes))


def route_index(spark, sf_dir):
    pages = corpora.page_docs(spark, sf_dir).select("doc_id", F.col("_path").alias("path"))
    return de.route_index(pages, PAGES)


def route_excluded(spark, sf_dir):
    return de.route_index(corpora.file_listing(spark, sf_dir), SOME_BOOKS)


def _index_names(spark, sf_dir):
    docs = corpora.document_docs(spark, sf_dir).select("index_name")
    pages = corpora.page_docs(spark, sf_dir).select("index_name")
    brands = corpora.part_docs(spark, sf_dir).select(F.col("brand").alias("index_name"))
    return docs.union(pages).union(brands).where("index_name IS NOT NULL").distinct()


def content_path(spark, sf_dir):
    return de.content_path(_index_names(spark, sf_dir), PAGES)


def match_definition(spark, sf_dir):
    return de.match_definition(_index_names(spark, sf_dir), DEFINITIONS)


def index_definition_join(spark, sf_dir):
    return reports.index_definition_join(_index_names(spark, sf_dir), (DOCUMENTS, BOOKS))


def create_index(spark, sf_dir):
    return de.create_index(_index_names(spark, sf_dir), DEFINITIONS)


def valid_index_name(spark, sf_dir):
    return _index_names(spark, sf_dir).select(
        "index_name", paths.valid_index_name(F.col("index_name")).alias("valid")
    )


def _roots(spark, sf_dir):
    """Content roots of existing indexes: the books, and one index per folder inside them."""
    listing = corpora.file_listing(spark, sf_dir)
    books = de.content_roots(listing, BOOKS).select(
        BOOKS.route(F.col("root")).alias("index_name"), "root"
    )
    folders = (
        listing.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("root"))
        .distinct()
        .select(F.concat(F.lit("folder-"), paths.file_name(F.col("root"))).alias("index_name"), "root")
    )
    return books.unionByName(folders)


def in_index(spark, sf_dir):
    return de.in_index(corpora.file_listing(spark, sf_dir), _roots(spark, sf_dir))


def route_destinations(spark, sf_dir):
    events = corpora.file_events(spark, sf_dir).select("event_id", "path")
    return de.route_destinations(events, [SOME_BOOKS], _roots(spark, sf_dir))


def build_postings(spark, sf_dir):
    """Postings straight from the tables, positions as text."""
    values = build.analyze_values(corpora.spread(corpora.document_values(spark, sf_dir)))
    return build.postings(values, []).select(
        "index_name",
        "field",
        "term",
        "doc_id",
        "tf",
        "length",
        F.array_join("positions", ",").alias("positions"),
    )


def write_index(spark, sf_dir):
    """Rows of each written table per index."""
    idx = documents(spark, sf_dir)
    tables = {
        "docs": idx.docs,
        "fields": idx.fields,
        "postings": idx.postings,
        "dictionary": idx.dictionary,
        "field_stats": idx.field_stats,
    }
    counted = [
        df.groupBy("index_name").agg(F.count("*").alias("n")).select(
            F.lit(name).alias("written"), "index_name", "n"
        )
        for name, df in tables.items()
    ]
    together = counted[0]
    for part in counted[1:]:
        together = together.unionByName(part)
    return together


def custom_mapping(spark, sf_dir):
    """A mapping of one's own: title and language of raw pages."""

    def mapping(content):
        page = content.select(
            "index_name",
            "doc_id",
            F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
            F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"),
        )
        return build.field_values(page, ["title"], ["lang"])

    pages = corpora.table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("index_name"), F.col("page_id").alias("doc_id"), "html"
    )
    return files.custom_mapping(pages, mapping).select(
        "doc_id", "field", "value", "tokenized"
    )


def _dated(spark, sf_dir):
    """Event times in every compact form a date field may have."""
    forms = {
        "signup": "yyyyMMdd",
        "click": "yyyyMMddHHmmss",
        "view": "yyyyMM",
        "purchase": "yyyy",
        "error": "yyyyMMddHHmmssSSS",
    }
    value = F.lit(None).cast("string")
    for kind, form in forms.items():
        value = F.when(F.col("event_type") == kind, F.date_format("ts", form)).otherwise(value)
    return corpora.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") == 8, F.lit("number")).otherwise(F.lit("creation-date")).alias("field"),
        value.alias("value"),
    )


def lucene_date_iso(spark, sf_dir):
    field, value = F.col("field"), F.col("value")
    return _dated(spark, sf_dir).select(
        "event_id",
        text.date_iso(field, value).alias("shown"),
        text.date_kind(field, value).alias("date_kind"),
    )


def truncate_text(spark, sf_dir):
    return corpora.table(spark, sf_dir, "documents").select(
        "doc_id", text.truncate_text(F.col("text")).alias("cut")
    ).select("doc_id", "cut.text", "cut.truncated")


def _requests(spark, sf_dir):
    """Pairs as they come in requests, made from the parts, some of them malformed."""
    return corpora.part_docs(spark, sf_dir).select(
        "doc_id",
        F.concat_ws(
            ",",
            F.concat(F.lit("type:"), "type"),
            F.concat(F.lit("size:"), F.col("size").cast("string")),
            F.col("title"),
            F.concat(F.lit("a:b:"), "brand"),
            F.lit("empty:"),
        ).alias("asked"),
    )


def parse_weights(spark, sf_dir):
    asked = _requests(spark, sf_dir).select("doc_id", text.parse_weights(F.col("asked")).alias("w"))
    return asked.select(
        "doc_id", F.size("w").alias("entries"), F.col("w")["size"].cast("double").alias("size")
    )


def parse_facet_pairs(spark, sf_dir):
    return _requests(spark, sf_dir).select(
        "doc_id", F.explode(text.parse_facet_pairs(F.col("asked"))).alias("p")
    ).select("doc_id", "p.field", "p.value")


def highlight(spark, sf_dir):
    return corpora.part_docs(spark, sf_dir).select(
        "doc_id", text.highlight(F.col("title"), ["re", "wid"]).alias("highlight")
    )


def strip_xml_prolog(spark, sf_dir):
    return corpora.table(spark, sf_dir, "pages").select(
        "page_id", F.length(text.strip_xml_prolog(F.col("html"))).alias("chars")
    )


def document_preview(spark, sf_dir):
    """The preview of every document, with the date it was changed as one more field."""
    docs = corpora.document_docs(spark, sf_dir)
    dated = docs.withColumn("date-modified", F.date_format("_lastmodified", "yyyyMMddHHmmss"))
    fields = corpora.document_values(spark, sf_dir).unionByName(
        build.field_values(dated, [], ["date-modified"])
    )
    return reports.document_preview(fields, docs).select(
        "path", "field", "date_kind", "tokenized", "text", "truncated"
    )


def document_preview_one(spark, sf_dir):
    idx = corpora.parts(spark, sf_dir)
    return reports.document_preview(idx.fields, idx.docs, "/parts/0").select(
        "path", "field", "date_kind", "tokenized", "text", "truncated"
    )


def visible_fields(spark, sf_dir):
    """Fields of the documents with the system ones hidden again."""
    docs = corpora.document_docs(spark, sf_dir)
    every = build.field_values(docs, [], ["lang", "source", "n_chars", "_src", "_path", "_creator"])
    return (
        reports.visible_fields(every)
        .groupBy("index_name", "field")
        .agg(F.count("*").alias("n"))
    )


QUERIES = {
    "content_roots": content_roots,
    "content_roots_pages": content_roots_pages,
    "parse_index_documents": parse_index_documents,
    "scan_content": scan_content,
    "content_reader": content_reader,
    "enrich_metadata": enrich_metadata,
    "relative_path": relative_path,
    "file_to_path": file_to_path,
    "path_to_file": path_to_file,
    "file_filter": file_filter,
    "file_filter_default": file_filter_default,
    "path_excludes": path_excludes,
    "route_index": route_index,
    "route_excluded": route_excluded,
    "content_path": content_path,
    "match_definition": match_definition,
    "index_definition_join": index_definition_join,
    "create_index": create_index,
    "valid_index_name": valid_index_name,
    "in_index": in_index,
    "route_destinations": route_destinations,
    "build_postings": build_postings,
    "write_index": write_index,
    "custom_mapping": custom_mapping,
    "lucene_date_iso": lucene_date_iso,
    "truncate_text": truncate_text,
    "parse_weights": parse_weights,
    "parse_facet_pairs": parse_facet_pairs,
    "highlight": highlight,
    "strip_xml_prolog": strip_xml_prolog,
    "document_preview": document_preview,
    "document_preview_one": document_preview_one,
    "visible_fields": visible_fields,
}

_NAMES = f"""{PAGE_DOCS},
names AS (SELECT DISTINCT 'docs-' || lang AS index_name FROM documents
          UNION SELECT DISTINCT index_name FROM page_docs WHERE index_name IS NOT NULL
          UNION SELECT DISTINCT p_brand FROM part)"""
_DEFINITION = """CASE WHEN regexp_full_match(index_name, 'docs-(.*)') THEN 'documents'
  WHEN index_name = 'parts' THEN 'parts' WHEN index_name = 'talks' THEN 'talks'
  WHEN regexp_full_match(index_name, 'book-(.*)') THEN 'books'
  WHEN regexp_full_match(index_name, 'pages-(.*)') THEN 'pages' END"""
_VALID = r"length(index_name) <= 255 AND regexp_full_match(index_name, '[\w\-@$.]+')"
_EXCLUDED = (
    "(starts_with(path, '/psml/content/book-2/')"
    " OR regexp_full_match(path, '/psml/content/book-3(.*?)(/.+)?'))"
)
_BOOK = r"regexp_extract(path, '^/psml/content/book-([\w\-]+)', 1)"
_FOLDER = r"regexp_extract(path, '^(.*)/[^/]*$', 1)"
_CHANGED = "1704067200000 + page_id * 60000"
_DOC_TEXT = "CASE WHEN length(v) > 100 THEN substr(v, 1, 100) ELSE v END"
_PREVIEW_ROWS = f"""{VALUES},
fv AS (SELECT index_name, doc_id, field, value AS v, false AS tokenized FROM present
       UNION ALL SELECT 'docs-' || lang, doc_id, 'fulltext', text, true FROM documents)"""

SQL = {
    "content_roots": f"""WITH {EVENTS} SELECT DISTINCT '/psml/content/book-' || {_BOOK} AS root
FROM listing WHERE {_BOOK} <> '2' AND NOT starts_with({_BOOK}, '3')""",
    "content_roots_pages": rf"""WITH {PAGE_DOCS}
SELECT DISTINCT regexp_extract(_path, '^(/[\w\-]+)/.', 1) AS root FROM page_docs
WHERE regexp_matches(_path, '^/[\w\-]+/.')""",
    "parse_index_documents": """
SELECT doc_id, field, 0 AS ord, value, field = 'fulltext' AS tokenized, true AS stored FROM (
  SELECT doc_id, 'fulltext' AS field, text AS value FROM documents
  UNION ALL SELECT doc_id, 'lang', lang FROM documents
  UNION ALL SELECT doc_id, 'source', source FROM documents)""",
    "scan_content": "SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents",
    "content_reader": "SELECT p_partkey, p_name FROM part",
    "enrich_metadata": f"""WITH {PAGE_DOCS}
SELECT doc_id, '{ROOT}' || _path || '.psml' AS _src, _path,
       split_part(_path, '/', -1) || '.psml' AS _filename, 'private' AS _visibility,
       CAST(1704067200000 + doc_id * 60000 AS VARCHAR) AS _lastmodified, 'shelfmark' AS _creator
FROM page_docs""",
    "relative_path": f"""WITH {PAGE_DOCS}
SELECT doc_id, CASE WHEN starts_with(_path, '/en/') THEN substr(_path, 5) || '.psml' END AS below_en,
       'content' || _path || '.psml' AS below_data FROM page_docs""",
    "file_to_path": f"WITH {PAGE_DOCS} SELECT doc_id, _path FROM page_docs",
    "path_to_file": f"WITH {PAGE_DOCS} SELECT doc_id, '{ROOT}' || _path || '.psml' AS _src"
    " FROM page_docs",
    "file_filter": rf"""WITH {EVENTS} SELECT path FROM listing
WHERE regexp_full_match(substr(path, 2), '{FILTERED[0]}')
  AND NOT regexp_full_match(substr(path, 2), '{FILTERED[1]}')""",
    "file_filter_default": f"""WITH {PAGE_DOCS}
SELECT doc_id, '{ROOT}' || _path || '.psml' AS path FROM page_docs
WHERE NOT contains(_path, '.html')""",
    "path_excludes": f"WITH {EVENTS} SELECT path FROM listing WHERE NOT {_EXCLUDED}",
    "route_index": f"WITH {PAGE_DOCS} SELECT doc_id, _path AS path, index_name FROM page_docs",
    "route_excluded": f"""WITH {EVENTS}
SELECT path, CASE WHEN NOT {_EXCLUDED} THEN 'book-' || {_BOOK} END AS index_name FROM listing""",
    "content_path": f"""WITH {_NAMES} SELECT index_name,
CASE WHEN starts_with(index_name, 'pages-') THEN '/' || substr(index_name, 7) END AS content_path
FROM names""",
    "match_definition": f"WITH {_NAMES} SELECT index_name, {_DEFINITION} AS definition FROM names",
    "index_definition_join": f"""WITH {_NAMES} SELECT index_name,
CASE WHEN starts_with(index_name, 'docs-') THEN 'documents' END AS definition,
CASE WHEN starts_with(index_name, 'docs-') THEN 'default' END AS mapping FROM names""",
    "create_index": f"""WITH {_NAMES}, d AS (
SELECT index_name, CASE WHEN {_VALID} THEN {_DEFINITION} END AS definition FROM names)
SELECT index_name, definition,
       CASE WHEN definition IS NULL THEN 'create-failed' ELSE 'created' END AS status FROM d""",
    "valid_index_name": f"WITH {_NAMES} SELECT index_name, {_VALID} AS valid FROM names",
    "in_index": f"""WITH {EVENTS}
SELECT path, 'book-' || {_BOOK} AS index_name FROM listing
UNION ALL SELECT path, 'folder-' || split_part({_FOLDER}, '/', -1) FROM listing""",
    "route_destinations": f"""WITH {EVENTS},
roots AS (SELECT DISTINCT 'folder-' || split_part({_FOLDER}, '/', -1) AS index_name,
                 {_FOLDER} AS root FROM listing
          UNION SELECT DISTINCT 'book-' || {_BOOK}, '/psml/content/book-' || {_BOOK} FROM listing)
SELECT event_id, path, index_name
FROM ev JOIN roots ON path = root OR starts_with(path, root || '/')
UNION SELECT event_id, path, 'book-' || {_BOOK} FROM ev WHERE NOT {_EXCLUDED}""",
    "build_postings": f"""WITH {tokens()}, {VALUES}
SELECT index_name, 'fulltext' AS field, term, doc_id, CAST(count(*) AS INTEGER) AS tf,
       CAST(any_value(len) AS INTEGER) AS length,
       string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM post JOIN lens USING (index_name, doc_id) GROUP BY index_name, term, doc_id
UNION ALL SELECT index_name, field, value, doc_id, 1, 1, '0' FROM present""",
    "write_index": f"""WITH {tokens()}, {VALUES},
fv AS (SELECT index_name, doc_id, field, value FROM present
       UNION ALL SELECT 'docs-' || lang, doc_id, 'fulltext', text FROM documents),
pv AS (SELECT DISTINCT index_name, doc_id, 'fulltext' AS field, term FROM post
       UNION ALL SELECT index_name, doc_id, field, value FROM present)
SELECT 'docs' AS written, 'docs-' || lang AS index_name, count(*) AS n FROM documents GROUP BY ALL
UNION ALL SELECT 'fields', index_name, count(*) FROM fv GROUP BY ALL
UNION ALL SELECT 'postings', index_name, count(*) FROM pv GROUP BY ALL
UNION ALL SELECT 'dictionary', index_name, count(DISTINCT (field, term)) FROM pv GROUP BY ALL
UNION ALL SELECT 'field_stats', index_name, count(DISTINCT field) FROM fv GROUP BY ALL""",
    "custom_mapping": """
SELECT page_id AS doc_id, 'title' AS field,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS value, true AS tokenized FROM pages
UNION ALL SELECT page_id, 'lang', regexp_extract(html, '<html lang="([a-z]+)"', 1), false
FROM pages""",
    "lucene_date_iso": """
SELECT event_id,
  CASE WHEN user_id = 8 THEN CASE event_type
      WHEN 'signup' THEN strftime(ts, '%Y%m%d') WHEN 'click' THEN strftime(ts, '%Y%m%d%H%M%S')
      WHEN 'view' THEN strftime(ts, '%Y%m') WHEN 'purchase' THEN strftime(ts, '%Y')
      WHEN 'error' THEN strftime(ts, '%Y%m%d%H%M%S%g') END
    ELSE CASE event_type
      WHEN 'signup' THEN strftime(ts, '%Y-%m-%d') WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 'view' THEN strftime(ts, '%Y-%m') WHEN 'purchase' THEN strftime(ts, '%Y')
      WHEN 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END END AS shown,
  CASE WHEN user_id = 8 THEN NULL WHEN event_type = 'signup' THEN 'date'
       WHEN event_type IN ('click', 'error') THEN 'datetime' END AS date_kind
FROM events""",
    "truncate_text": "SELECT doc_id, substr(text, 1, 100) AS text, length(text) > 100 AS truncated"
    " FROM documents",
    "parse_weights": "SELECT p_partkey AS doc_id, 1 AS entries, CAST(p_size AS DOUBLE) AS size"
    " FROM part",
    "parse_facet_pairs": """
SELECT p_partkey AS doc_id, 'type' AS field, p_type AS value FROM part
UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part""",
    "highlight": r"""SELECT p_partkey AS doc_id,
regexp_replace(p_name, '(^|[^\p{L}\p{N}])(wid|re)', '\1<b>\2</b>', 'gi') AS highlight FROM part""",
    "strip_xml_prolog": r"""SELECT page_id,
CAST(length(regexp_replace(html, '<(?:!DOCTYPE|\?xml)[^>]+>', '', 'g')) AS INTEGER) AS chars
FROM pages""",
    "document_preview": f"""WITH {_PREVIEW_ROWS}, {DOCS}
SELECT _path AS path, field, NULL::VARCHAR AS date_kind, tokenized,
       {_DOC_TEXT} AS text, length(v) > 100 AS truncated
FROM fv JOIN docs USING (index_name, doc_id)
UNION ALL SELECT _path, 'date-modified', 'datetime', false,
  strftime(make_timestamp(lm), '%Y-%m-%dT%H:%M:%SZ'), false FROM docs""",
    "document_preview_one": """
SELECT '/parts/0' AS path, field, NULL::VARCHAR AS date_kind, field IN ('title', 'type') AS tokenized,
       v AS text, length(v) > 100 AS truncated
FROM (SELECT unnest(['title', 'type', 'brand', 'size', 'price']) AS field,
             unnest([p_name, p_type, p_brand, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR)]) AS v
      FROM part WHERE p_partkey = 0)""",
    "visible_fields": """
SELECT 'docs-' || lang AS index_name, unnest(['lang', 'source', 'n_chars']) AS field,
       count(*) AS n FROM documents GROUP BY lang""",
}
