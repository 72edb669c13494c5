"""Quality classifier: supervised subword embeddings.

Every word, every run of two to four bytes and every pair of neighbouring words (as: the same word
again, or another) is hashed to a bucket with a learned vector; a document is the mean of its vectors, and a softmax over two classes follows. Training is stochastic
gradient descent in numpy over a bounded sample of labelled documents. As the mean and the output
layer are linear, scoring folds both into one number per bucket: the score is the logistic function
of the mean of those numbers, over every word and gram of the whole text.

Only the sampled rows' bucket counts come to the driver, and only the folded buckets go out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, held_out, narrow

#: Labelled rows that are learned from, at most; the smallest hashes of doc_id are taken.
SAMPLE = 5_000
BUCKETS = 1 << 17
DIMENSIONS = 8
EPOCHS = 4
RATE = 1.5
#: No output weight grows beyond this, so that a step stays small.
LARGEST = 8.0
CUT = 0.3
GRAMS = (2, 3, 4)
#: Bytes of text that are hashed at once; longer texts are taken in overlapping parts.
AT_ONCE = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(kind)) * _MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MULTIPLIER) >> np.uint64(64 - 17)).astype(np.int32)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[1], np.full(n, _BASE)]).astype(np.uint64), dtype=np.uint64)


_POWERS = _powers(AT_ONCE + 64)


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in parts that end at white space where there is some."""
    start = 0
    while len(data) - start > AT_ONCE:
        cut = data.rfind(b" ", start + 1, start + AT_ONCE) + 1 or start + AT_ONCE
        yield data[start:cut]
        start = cut
    yield data[start:]


def buckets(data: bytes) -> np.ndarray:
    """The buckets of all words and grams of a text's bytes, repeats included."""
    found = []
    for part in _parts(data):
        text = np.frombuffer(part, np.uint8)
        if not text.size:
            continue
        values = text.astype(np.uint64) + np.uint64(1)
        space = _IS_SPACE[text]
        edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _POWERS[: text.size], dtype=np.uint64)])
        # a word's polynomial, moved to one common power so that its place does not matter
        words = (sums[ends] - sums[starts]) * _POWERS[text.size - starts]
        words *= _power_of(AT_ONCE + 64 - text.size)
        found.append(_bucket(words, 1))
        # pairs of neighbours, told apart only by whether a word comes again
        again = np.diff(words, prepend=np.uint64(0)) == 0
        found.append(_bucket(again.astype(np.uint64), 0))
        gram = values[: max(0, text.size - GRAMS[0] + 1)] * np.uint64(0)
        for width in range(1, GRAMS[-1] + 1):
            n = text.size - width + 1
            if n <= 0:
                break
            gram = values[:n] if width == 1 else gram[:n] * np.uint64(_BASE) + values[width - 1 :]
            if width in GRAMS:
                found.append(_bucket(gram, width))
    return np.concatenate(found) if found else np.empty(0, np.int32)


def _power_of(n: int) -> np.uint64:
    return _POWERS[n]


def shares(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and what part of all each one makes up."""
    found, counts = np.unique(buckets(data), return_counts=True)
    return found.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float16)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 7,
) -> np.ndarray:
    """The folded weights: one number per bucket, and the bias at the end.

    ``rows`` holds the buckets, their shares of the text, and the label of each document.
    """
    random = np.random.default_rng(seed)
    vectors = (random.random((BUCKETS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS
    output = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps = max(1, epochs * len(rows))
    done = 0
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            ids, share, label = rows[k]
            share = share.astype(np.float32)
            pace = np.float32(rate * (1 - done / steps))
            done += 1
            mean = share @ vectors[ids]
            logits = mean @ output + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1.0
            back = output @ chance
            output -= pace * np.outer(mean, chance)
            np.clip(output, -LARGEST, LARGEST, out=output)
            bias -= np.float32(0.1) * pace * chance
            vectors[ids] -= np.outer(share, (pace * np.float32(np.sqrt(ids.size))) * back)
    weights = vectors @ (output[:, 1] - output[:, 0])
    return np.append(weights, bias[1] - bias[0]).astype(float)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, learn=None
) -> DataFrame:
    """Ids and labels to learn from: one row per document, at most ``sample``.

    Rows without id or label are left out, as are documents labelled both ways.
    """
    usable = ~held_out("doc_id", 5, 0) if learn is None else learn
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other"))
        .drop("other")
    )
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return (
        known.join(there, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from a bounded sample of the labelled rows that may be learned from."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [shares(t.encode()) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "ids": [i.tobytes() for i, _ in pairs],
                    "shares": [s.tobytes() for _, s in pairs],
                }
            )

    chosen = labelled_sample(docs, labels, sample)
    rows = (
        narrow(docs)
        .join(F.broadcast(chosen), "doc_id")
        .mapInPandas(count, "doc_id long, label int, ids binary, shares binary")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    return train(
        [
            (np.frombuffer(i, np.int32), np.frombuffer(s, np.float16), y)
            for i, s, y in zip(rows["ids"], rows["shares"], rows["label"], strict=True)
        ]
    )


def scorer(spark: SparkSession, weights: np.ndarray) -> Callable[[Column], Column]:
    """A column function: the score of a text; a null or empty one scores by the bias alone."""
    sent = spark.sparkContext.broadcast(weights)

    def score(texts: pd.Series) -> pd.Series:
        table, bias = sent.value[:-1].astype(np.float32), sent.value[-1]
        logits = np.full(len(texts), bias)
        for k, text in enumerate(texts.tolist()):
            if text:
                logits[k] += float(table[buckets(text.encode())].mean(dtype=np.float64))
        return pd.Series(1 / (1 + np.exp(-logits)))

    return F.pandas_udf(score, "double")


def score_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per row of ``docs``: doc_id, score from 0 to 1, predicted (1 where score >= cut).

    Null and empty texts score like a document without words. With nothing to learn from, every
    score is 0.5. Repeated rows score alike; an empty table gives no rows.
    """
    score = scorer(docs.sparkSession, fit(docs, labels))
    return (
        narrow(docs)
        .select("doc_id", score("text").alias("score"))
        .select("doc_id", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows that the classifier does not reject, with their columns, nothing shuffled."""
    return docs.where(scorer(docs.sparkSession, fit(docs, labels))("text") >= cut)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
