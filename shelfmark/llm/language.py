"""Language identification by a convolutional network over bytes.

Every window of ``WINDOW`` bytes goes through filters of several widths over learned byte vectors,
keeps each filter's largest response, and ends in a softmax over the languages. The whole text is
cut into such windows; their log-probabilities are averaged. Training is stochastic gradient descent
in numpy on windows of a bounded sample of documents, a bounded number of each language.

To apply the network, byte vectors and filters are multiplied out into one table per filter tap, so
that a response is a sum of table rows; windows of many documents are taken together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, held_out, mapped, narrow

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
DIMENSIONS = 8
#: Documents learned from: so many of each language, so many languages, and windows of a document.
SAMPLE = 600
LANGUAGES = 200
SAMPLE_WINDOWS = 4
EPOCHS = 8
RATE = 0.2
BATCH = 32
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes in rows of ``size``, the last one filled up with spaces."""
    rows = max(1, -(-len(data) // size))
    return np.frombuffer(data.ljust(rows * size), np.uint8).reshape(rows, size)


@dataclass
class Network:
    languages: list[str]
    vectors: np.ndarray
    taps: list[np.ndarray]  # of each width: (width, DIMENSIONS, FILTERS)
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    @staticmethod
    def fresh(languages: list[str], seed: int = 5) -> Network:
        random = np.random.default_rng(seed)
        draw = lambda *shape: random.normal(0, 1, shape).astype(np.float32)
        return Network(
            languages,
            draw(256, DIMENSIONS),
            [draw(w, DIMENSIONS, FILTERS) / np.float32(np.sqrt(w * DIMENSIONS)) for w in WIDTHS],
            np.zeros(len(WIDTHS) * FILTERS, np.float32),
            draw(len(WIDTHS) * FILTERS, len(languages)) * np.float32(0.1),
            np.zeros(len(languages), np.float32),
        )

    def learn(self, rows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> None:
        random = np.random.default_rng(11)
        steps = max(1, epochs * -(-len(rows) // BATCH))
        done = 0
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for start in range(0, len(rows), BATCH):
                some = order[start : start + BATCH]
                self._step(rows[some], labels[some], np.float32(rate * (1 - done / steps)))
                done += 1

    def _step(self, rows: np.ndarray, labels: np.ndarray, pace: np.float32) -> None:
        n, each = len(rows), np.arange(len(rows))
        letters = self.vectors[rows]
        peaks, places = [], []
        for width, taps in zip(WIDTHS, self.taps, strict=True):
            span = rows.shape[1] - width + 1
            response = sum(letters[:, k : k + span] @ taps[k] for k in range(width))
            place = response.argmax(1)
            places.append(place)
            peaks.append(np.take_along_axis(response, place[:, None], 1)[:, 0])
        raw = np.concatenate(peaks, 1) + self.bias
        pooled = np.maximum(raw, 0)
        logits = pooled @ self.output + self.output_bias
        back = np.exp(logits - logits.max(1, keepdims=True))
        back /= back.sum(1, keepdims=True)
        back[each, labels] -= 1
        back /= n
        inner = (back @ self.output.T) * (raw > 0)
        self.output -= pace * (pooled.T @ back)
        self.output_bias -= pace * back.sum(0)
        self.bias -= pace * inner.sum(0)
        change = np.zeros_like(self.vectors)
        for j, (width, taps, place) in enumerate(zip(WIDTHS, self.taps, places, strict=True)):
            part = inner[:, j * FILTERS : (j + 1) * FILTERS]
            for k in range(width):
                seen = rows[each[:, None], place + k]
                before = self.vectors[seen]
                np.add.at(change, seen, part[:, :, None] * taps[k].T[None])
                taps[k] -= pace * np.einsum("bfd,bf->df", before, part)
        self.vectors -= pace * change

    def tables(self) -> list[list[np.ndarray]]:
        return [[np.ascontiguousarray(self.vectors @ t) for t in taps] for taps in self.taps]

    def log_chances(self, rows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        found = np.empty((len(rows), len(self.languages)), np.float32)
        for start in range(0, len(rows), 32):
            some = rows[start : start + 32]
            flat = some.ravel().astype(np.intp)
            peaks = []
            for width, taps in zip(WIDTHS, tables, strict=True):
                response = np.take(taps[0], flat, axis=0)
                for k in range(1, width):
                    response[:-k] += np.take(taps[k], flat[k:], axis=0)
                inside = response.reshape(len(some), rows.shape[1], FILTERS)[:, : rows.shape[1] - width + 1]
                peaks.append(inside.max(1))
            logits = np.maximum(np.concatenate(peaks, 1) + self.bias, 0) @ self.output + self.output_bias
            logits -= logits.max(1, keepdims=True)
            found[start : start + 32] = logits - np.log(np.exp(logits).sum(1, keepdims=True))
        return found


def learning_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id and lang of the documents to learn from: per language the smallest hashes of doc_id.

    Rows without id or language are left out, as are ids with several languages.
    """
    known = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang")
        .where(F.col("lang").isNotNull() & ~held_out("doc_id", 4, 2))
    )
    ranked = known.withColumn(
        "place",
        F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")),
    )
    chosen = ranked.where(F.col("place") <= sample).groupBy("doc_id")
    chosen = chosen.agg(F.min("lang").alias("lang"), F.max("lang").alias("other"))
    return (
        chosen.where("lang = other")
        .select("doc_id", "lang")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample * LANGUAGES)
    )


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network learned from the sample; None where there is nothing to learn from."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for doc, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"], strict=True):
                if _LETTER.search(text):
                    rows = windows(text.encode())
                    places = np.unique(np.linspace(0, len(rows) - 1, SAMPLE_WINDOWS).astype(int))
                    found += [(doc, int(p), lang, rows[p].tobytes()) for p in places]
            yield pd.DataFrame(found, columns=["doc_id", "place", "lang", "window"])

    rows = (
        narrow(docs)
        .join(F.broadcast(learning_sample(docs, sample)), "doc_id")
        .mapInPandas(cut, "doc_id long, place int, lang string, window binary")
        .toPandas()
        .sort_values(["doc_id", "place", "window"], kind="stable")
    )
    if rows.empty:
        return None
    languages = sorted(rows["lang"].unique())
    network = Network.fresh(languages)
    number = {lang: k for k, lang in enumerate(languages)}
    data = np.frombuffer(b"".join(rows["window"]), np.uint8).reshape(-1, WINDOW)
    network.learn(data, rows["lang"].map(number).to_numpy())
    return network


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score.

    A null text, or one without a letter, is ``und`` with score 0, as is every text where there was
    nothing to learn from. Texts of any length are read whole. Repeated rows get equal answers; an
    empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        network = sent.value
        tables = network.tables() if network else []
        for batch in batches:
            texts = batch["text"].tolist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            spoken = [k for k, t in enumerate(texts) if network and _LETTER.search(t)]
            start = 0
            while start < len(spoken):
                some, cut = [], []
                while start + len(some) < len(spoken) and sum(map(len, cut)) < 4096:
                    some.append(spoken[start + len(some)])
                    cut.append(windows(texts[some[-1]].encode()))
                start += len(some)
                chances = network.log_chances(np.concatenate(cut), tables)
                begins = np.cumsum([0] + [len(c) for c in cut[:-1]])
                counts = np.array([len(c) for c in cut])[:, None]
                mean = np.add.reduceat(chances.astype(float), begins, axis=0) / counts
                best = mean.argmax(1)
                share = np.exp(mean - mean.max(1, keepdims=True))
                scores[some] = (share / share.sum(1, keepdims=True))[np.arange(len(some)), best]
                for k, b in zip(some, best.tolist(), strict=True):
                    langs[k] = network.languages[b]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": langs, "score": scores})

    return mapped(narrow(docs), work, "lang_pred string, score double")


def op6_language(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, fit(docs)).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op6_language": op6_language}
SQL: dict[str, str] = {}
