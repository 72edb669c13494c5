"""Completing from tables made for it: the words of suggestions in order, and the best of short beginnings.

``suggest`` looks at every value of a field. A suggester that is asked often has two tables instead:
its texts once per word, sorted by word, where a typed beginning is one short range; and for beginnings
of a few letters, which have long ranges, the heaviest texts. Both are made anew when, and only when,
their index has a newer version.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import highlight
from shelfmark.operators.build import IndexTables
from shelfmark.operators.definitions import Suggester
from shelfmark.operators.suggest import (
    RESULTS,
    begins_words,
    build_suggester,
    suggestion_dedupe,
    suggestion_documents,
    top_suggestions,
    typed_words,
)
from shelfmark.sources import store

#: Letters of a beginning that has its heaviest texts kept, at most, and how many of them are kept.
SHORT = 4
KEPT = 100
#: What a typed word begins with, as far as it is part of one word of a text.
_WORD_START = re.compile(r"[^\W_]+")
TEXT = ["text", "weight", "index_name", "doc_id"]


@dataclass(frozen=True)
class Completions:
    """``words``: (word, text, weight, index_name, doc_id) by word; ``heaviest``: the same by (start)."""

    words: DataFrame
    heaviest: DataFrame


def by_word(rows: DataFrame) -> DataFrame:
    """The rows of a suggester once per different word."""
    return rows.select(F.explode(F.array_distinct("words")).alias("word"), *TEXT).where("word != ''")


def heaviest(words: DataFrame, kept: int = KEPT, short: int = SHORT) -> DataFrame:
    """For every beginning of up to ``short`` letters the ``kept`` heaviest texts of each index.

    Spark keeps no more than that of a beginning in any task before it shuffles, so a beginning that
    most words have is as small as any other.
    """
    starts = F.expr(f"transform(sequence(1, least(length(word), {int(short)})), n -> substring(word, 1, n))")
    rows = words.select(F.explode(starts).alias("start"), *TEXT)
    # A text that has several words of one beginning comes once; its rank does not depend on the others.
    best = Window.partitionBy("start", "index_name").orderBy(F.desc("weight"), "text")
    ranked = rows.withColumn("n", F.dense_rank().over(best)).where(F.col("n") <= kept)
    return ranked.drop("n").distinct()


def ensure_completions(spark: SparkSession, folder: str, idx: IndexTables, suggester: Suggester) -> Completions:
    """The tables of a suggester below ``folder``, which belongs to one state of its index; made if not there."""
    settings = hashlib.md5(repr(suggester).encode()).hexdigest()
    path = f"{folder}/{suggester.name}-{settings}"
    rows = build_suggester(idx, suggester)

    def sorted_by(name: str, df: DataFrame, key: str) -> DataFrame:
        written = store.written_once(
            spark,
            f"{path}/{name}",
            lambda target: df.repartitionByRange(key, "text")
            .sortWithinPartitions(key, "text")
            .write.mode("overwrite")
            .parquet(target),
        )
        return spark.read.schema(df.schema).parquet(written)

    words = sorted_by("words", by_word(rows), "word")
    return Completions(words, sorted_by("heaviest", heaviest(words), "start"))


def current_completions(spark: SparkSession, path: str, suggester: Suggester) -> Completions:
    """The tables of a suggester for the newest version of the index under ``path``.

    They are kept beside the index, by version. A version that has them is not read for them again.
    """
    version = store.last_version(spark, path)
    if version is None:
        raise ValueError(f"no index at {path}")
    idx = store.must_read(spark, path, version)
    return ensure_completions(spark, f"{path}/completions/version={version}", idx, suggester)


def matching(found: Completions, typed: list[str], results: int = RESULTS) -> DataFrame:
    """(text, weight, index_name, doc_id) of texts in which every typed word begins some word.

    For one short word and no more results than are kept, only the heaviest of them.
    """
    starts = [m.group() if (m := _WORD_START.match(w)) else "" for w in typed]
    if not typed:
        return found.words.select(*TEXT).where("false")
    if starts == typed and len(typed) == 1 and len(typed[0]) <= SHORT and results <= KEPT:
        return found.heaviest.where(F.col("start") == typed[0]).select(*TEXT)
    # The longest beginning has the shortest range; the text itself tells the rest.
    longest = max(starts, key=len)
    rows = found.words.where(F.col("word").startswith(longest)) if longest else found.words
    return rows.where(begins_words(F.col("text"), typed)).select(*TEXT).distinct()


def complete(
    idx: IndexTables, found: Completions, suggester: Suggester, term: str, results: int = RESULTS
) -> DataFrame:
    """Best completions of what was typed, as ``suggest`` gives them, from the tables of a suggester."""
    typed = typed_words(term) if len(term.strip()) >= suggester.min_chars else []
    rows = matching(found, typed, results)
    best = rows.groupBy("text").agg(F.max("weight").alias("weight")) if suggester.use_terms else suggestion_dedupe(rows)
    top = top_suggestions(best, results).withColumn("highlight", highlight(F.col("text"), typed))
    if not suggester.result_fields or suggester.use_terms:
        return top
    return suggestion_documents(top, idx, list(suggester.result_fields))
