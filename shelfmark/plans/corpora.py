"""How the test tables are seen as indexed content, and their indexes on disk."""

from __future__ import annotations

import hashlib
import inspect
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import analysis
from shelfmark.functions.paths import file_name, url_path
from shelfmark.operators import build
from shelfmark.operators.build import IndexTables, field_values
from shelfmark.operators.definitions import IndexDefinition, Suggester, definition_name
from shelfmark.session import shared_dir
from shelfmark.sources import store

DOCUMENTS = IndexDefinition("documents", "docs-{name}", "/documents/{name}")
PARTS = IndexDefinition(
    "parts",
    "parts",
    "/parts",
    autosuggests=(
        Suggester("names", ("title", "type"), False, ("brand", "type"), {"title": 2.0, "type": 1.0}),
        Suggester("words", ("title",), True),
    ),
)
PAGES = IndexDefinition("pages", "pages-{name}", "/{name}")
TALKS = IndexDefinition("talks", "talks", "/talks")
BOOKS = IndexDefinition("books", "book-{name}", "/psml/content/book-{name}")
DEFINITIONS = (DOCUMENTS, PARTS, TALKS, BOOKS, PAGES)
CONTENT_ROOT = "/data"
LANGUAGES = ("de", "en", "es", "fr")
DOCUMENT_INDEXES = tuple(f"docs-{lang}" for lang in LANGUAGES)



def _code_version() -> str:
    """Changes with the code that makes the tables, so that no build of other code is read."""
    made_by = (analysis, build, store, sys.modules[__name__])
    return hashlib.md5("".join(inspect.getsource(m) for m in made_by).encode()).hexdigest()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows dealt over all tasks before their text is analyzed, which costs far more than moving it.

    Files are split by their bytes and row groups only, so a compressed file may be a single task.
    """
    return rows.repartition(key)


def _system_columns(df: DataFrame, path: str, time) -> DataFrame:
    return df.select(
        "*",
        F.concat(F.lit(CONTENT_ROOT), F.col(path), F.lit(".psml")).alias("_src"),
        F.col(path).alias("_path"),
        F.concat(file_name(F.col(path)), F.lit(".psml")).alias("_filename"),
        time.alias("_lastmodified"),
        F.lit("shelfmark").alias("_creator"),
    )


def _day_of(number: str, start: str = "2024-01-01"):
    """A modification time that is a rule of the id: so many minutes after a day."""
    return F.timestamp_seconds(F.unix_timestamp(F.lit(start), "yyyy-MM-dd") + F.col(number) * 60)


def document_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("docs-"), "lang").alias("index_name"),
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.concat_ws("/", F.lit("/documents"), "lang", F.col("doc_id").cast("string")).alias("p"),
    )
    return _system_columns(rows, "p", _day_of("doc_id")).drop("p")


def document_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("docs-"), "lang").alias("index_name"),
        "doc_id",
        F.col("text").alias("fulltext"),
        "lang",
        "source",
        "n_chars",
    )
    own = field_values(documents, ["fulltext"], ["lang", "source", "n_chars"])
    # Only ids and languages meet the labels; the text stays out of the join.
    labels = table(spark, sf_dir, "labels").join(
        documents.select("index_name", "doc_id"), "doc_id"
    )
    return own.unionByName(field_values(labels, [], ["quality", "toxic"]))


def part_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        F.lit("parts").alias("index_name"),
        F.col("p_partkey").alias("doc_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.concat(F.lit("/parts/"), F.col("p_partkey").cast("string")).alias("p"),
    )
    return _system_columns(rows, "p", _day_of("doc_id")).drop("p")


def part_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_values(part_docs(spark, sf_dir), ["title", "type"], ["brand", "size", "price"])


def page_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), "url", url_path(F.col("url")).alias("p")
    )
    plain = rows.withColumn("p", F.regexp_replace("p", "/$", ""))
    routed = plain.withColumn("index_name", PAGES.route(F.col("p")))
    return _system_columns(routed, "p", _day_of("doc_id")).drop("p")


def talk_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("doc_id"))
        .agg(F.count("*").alias("turns"))
        .select(
            F.lit("talks").alias("index_name"),
            "*",
            F.concat(F.lit("/talks/"), F.col("doc_id").cast("string")).alias("p"),
        )
    )
    return _system_columns(rows, "p", _day_of("doc_id")).drop("p")


def talk_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("talks").alias("index_name"), F.col("conv_id").alias("doc_id"), "turn", "role", "text"
    )
    return field_values(turns, ["text"], ["role"], ord_column=F.col("turn"))


@dataclass(frozen=True)
class Corpus:
    """Content of one definition: where it comes from and how it becomes values."""

    definition: IndexDefinition
    files: tuple[str, ...]
    docs: object = field(repr=False)
    values: object = field(repr=False)

    def folder(self, spark: SparkSession, sf_dir: str) -> str:
        """Where builds of this content lie: another folder when a source file changes."""
        state = store.source_fingerprint(
            spark, [f"{sf_dir}/{name}.parquet" for name in self.files]
        )
        key = hashlib.md5(f"{_code_version()}%{sf_dir}%{state}".encode()).hexdigest()
        return f"{shared_dir(spark)}/shelfmark/{self.definition.name}/{key}"

    def index(self, spark: SparkSession, sf_dir: str, lookups: bool = False) -> IndexTables:
        """The written index, built on first use; its lookup tables where near terms or patterns ask for them."""

        def write(path: str) -> IndexTables:
            definition = definition_name(F.col("index_name"), DEFINITIONS)
            return store.write_index(spark, path, self.docs(spark, sf_dir), self.values(spark, sf_dir), definition)

        return store.ensure_index(spark, self.folder(spark, sf_dir), write, lookups)


DOCUMENT_CORPUS = Corpus(DOCUMENTS, ("documents", "labels"), document_docs, document_values)
PART_CORPUS = Corpus(PARTS, ("part",), part_docs, part_values)
TALK_CORPUS = Corpus(TALKS, ("conversations",), talk_docs, talk_values)


def documents(spark: SparkSession, sf_dir: str, names=DOCUMENT_INDEXES, lookups: bool = False) -> IndexTables:
    return DOCUMENT_CORPUS.index(spark, sf_dir, lookups).select(names)


def parts(spark: SparkSession, sf_dir: str, lookups: bool = False) -> IndexTables:
    return PART_CORPUS.index(spark, sf_dir, lookups).select("parts")


def talks(spark: SparkSession, sf_dir: str) -> IndexTables:
    return TALK_CORPUS.index(spark, sf_dir).select("talks")


def as_file_events(events: DataFrame) -> DataFrame:
    """Rows of the events table as file events (event_id, path, kind, is_dir, ts)."""
    folder = F.concat(
        F.lit("/psml/content/book-"),
        (F.col("user_id") % 10).cast("string"),
        F.lit("/f"),
        (F.col("user_id") % 3).cast("string"),
    )
    is_dir = F.col("event_id") % 4 == 0
    return events.select(
        "event_id",
        F.when(is_dir, folder)
        .otherwise(F.concat(folder, F.lit("/"), F.col("user_id").cast("string"), F.lit(".psml")))
        .alias("path"),
        F.when(F.col("event_type") == "signup", F.lit("create"))
        .when(F.col("event_type") == "error", F.lit("delete"))
        .otherwise(F.lit("modify"))
        .alias("kind"),
        is_dir.alias("is_dir"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_file_events(table(spark, sf_dir, "events"))


def file_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream, without a watermark."""
    rows = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return as_file_events(rows)


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct file paths of the events; they also stand for the indexed documents."""
    return (
        file_events(spark, sf_dir).where(~F.col("is_dir")).select("path").distinct()
    )


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the documents: what lies in the content folder, and what was indexed.

    Every document has a part: of ten, one is new, one was removed, one was changed since.
    """
    docs = document_docs(spark, sf_dir)
    digit = F.col("doc_id") % 10
    existing = docs.where(digit != 0)
    changed = F.expr("interval 1 day")
    source = docs.where(digit != 1).withColumn(
        "modified",
        F.when(digit == 2, F.col("_lastmodified") + changed).otherwise(F.col("_lastmodified")),
    )
    return source, existing
