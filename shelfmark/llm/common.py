"""What the operators share: their view of a table, and tables written for later steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import shared_dir

#: The letters that count as upper case, and their lower-case forms.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space of ASCII: space, and tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, so that other columns cannot clash; a null text is an empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def mapped(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` over rows with a doc_id, which pandas sees as text.

    A long column with nulls would come to pandas as floating-point numbers and lose digits.
    """
    return (
        rows.withColumn("doc_id", F.col("doc_id").cast("string"))
        .mapInPandas(work, f"doc_id string, {schema}")
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def remainder(id_col: str, by: int) -> Column:
    """crc32 of an id's decimal text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(by)


def held_out(id_col: str, by: int, rest: int) -> Column:
    """Rows that no model may learn from; a row without id is one of them."""
    return F.coalesce(remainder(id_col, by) == rest, F.lit(True))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Later steps neither run the plan again nor depend on the executors that ran it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Whole rows of ``docs`` whose doc_id is (``left_anti``: is not) in ``ids``, null included."""
    picked = ids.select(F.col("doc_id").alias("_picked"))
    return docs.join(picked, docs["doc_id"].eqNullSafe(picked["_picked"]), how)
