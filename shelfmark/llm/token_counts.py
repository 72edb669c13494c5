"""Token counts that follow edits.

A document is kept as segments of whole pre-tokens with their lengths and token counts, the leaves
of a segment tree of sums. An edit finds its place down the tree, re-encodes only the segments it
touches, two characters of context before them, and as many behind as it takes until a segment's
end falls where one was; from there on nothing can differ. Sums are then updated up the tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.bpe import CHUNK, TOKENIZER, Bpe, load
from shelfmark.llm.common import documents, mapped, narrow

#: Characters behind its end that decide where a segment ends.
AHEAD = 2
#: Characters of the documents whose new chunks are encoded together; bounds memory only.
AT_ONCE = 1_000_000
COUNTS = ("n_tokens_before", "n_tokens", "n_edits", "n_segments", "n_chars_reencoded")
EDITS = "array<struct<start:long,stop:long,text:string>>"


def _packed(values: np.ndarray) -> bytes:
    kind = "u1" if not values.size or values.max() < 256 else "<u4"
    return kind[-1].encode() + values.astype(kind).tobytes()


def _opened(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "u1" if raw[:1] == b"1" else "<u4", offset=1).astype(np.int64)


class CountTree:
    """Segments of one document and the sums of their characters and tokens."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.text, self.n = text, max(1, len(chars))
        self.size = 1 << (self.n - 1).bit_length()
        self.chars, self.tokens = self._sums(chars), self._sums(tokens)
        self.begins = np.concatenate([[0], np.cumsum(chars)])
        self.changed: dict[int, str] = {}
        self.reencoded = 0

    def _sums(self, leaves: np.ndarray) -> np.ndarray:
        tree = np.zeros(2 * self.size, np.int64)
        tree[self.size : self.size + len(leaves)] = leaves
        width = self.size
        while width > 1:
            tree[width // 2 : width] = tree[width : 2 * width].reshape(-1, 2).sum(1)
            width //= 2
        return tree

    def find(self, place: int) -> tuple[int, int]:
        """The segment that holds a character, and where the segment begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if place >= begin + self.chars[node]:
                begin += int(self.chars[node])
                node += 1
        return node - self.size, begin

    def segment(self, k: int) -> str:
        if k in self.changed:
            return self.changed[k]
        return self.text[self.begins[k] : self.begins[k + 1]] if k + 1 < len(self.begins) else ""

    def _set(self, k: int, text: str, tokens: int) -> None:
        self.changed[k] = text
        node = k + self.size
        more_chars, more_tokens = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def edit(self, start: int, stop: int, new: str, bpe: Bpe) -> None:
        total = int(self.chars[1])
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        first, begin = self.find(max(0, min(start - AHEAD - 1, total - 1)))
        last, at = self.find(max(0, min(stop, total - 1)))
        old = [self.segment(k) for k in range(first, last + 1)]
        step = 4
        while True:
            text = "".join(old)
            end = begin + len(text)
            region = text[: start - begin] + new + text[stop - begin :]
            segments = CHUNK.findall(region)
            ends = list(accumulate(map(len, segments)))
            if end == total:
                taken, stays = len(segments), len(old)
                break
            shift = len(new) - (stop - start)
            were = {place + shift: n for n, place in enumerate(accumulate(map(len, old)), 1)}
            # the first end that lies behind the edit, where a segment ended before, and that is certain
            behind = start - begin + len(new)
            taken = next((n for n, e in enumerate(ends, 1) if behind <= e <= len(region) - AHEAD and e in were), 0)
            if taken:
                stays = were[ends[taken - 1]]
                break
            more = range(last + 1, min(last + 1 + step, self.n))
            old += [self.segment(k) for k in more]
            last, step = more[-1], 2 * step
        segments = segments[:taken]
        if not all(s in bpe.known for s in segments):
            bpe.learn(set(segments))
        self.reencoded += sum(map(len, segments))
        self._set(first, "".join(segments), sum(len(bpe.known[s]) for s in segments) // 4)
        for k in range(first + 1, first + stays):
            self._set(k, "", 0)

    def whole(self) -> str:
        parts, at = [], 0
        for k in sorted(self.changed):
            parts += [self.text[at : self.begins[k]], self.changed[k]]
            at = self.begins[k + 1] if k + 1 < len(self.begins) else len(self.text)
        return "".join([*parts, self.text[at:]])


def _with_edits(docs: DataFrame, edits: DataFrame | None) -> DataFrame:
    """doc_id, text and the edits of each row, from a table of edits or a column of ``docs``."""
    rows = narrow(docs)
    if edits is not None:
        gathered = edits.groupBy(F.col("doc_id").alias("of_id")).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "text"))),
                lambda e: F.struct(
                    e["start"].cast("long").alias("start"), e["stop"].cast("long").alias("stop"), e["text"].alias("text")
                ),
            ).alias("edits")
        )
        return rows.join(gathered, F.col("doc_id").eqNullSafe(F.col("of_id")), "left").drop("of_id")
    if "edits" in docs.columns:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("edits").cast(EDITS).alias("edits"))
    return rows.withColumn("edits", F.array().cast(EDITS))


def _groups(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of up to ``AT_ONCE`` characters, a longer text by itself."""
    start, size = 0, 0
    for end, text in enumerate(texts):
        if end > start and size + len(text) > AT_ONCE:
            yield slice(start, end)
            start, size = end, 0
        size += len(text)
    if texts:
        yield slice(start, len(texts))


def _building(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            for part in _groups(batch["text"].tolist()):
                rows, chars, tokens = batch.iloc[part], [], []
                cut = [CHUNK.findall(t) for t in rows["text"].tolist()]
                bpe.learn({c for chunks in cut for c in chunks})
                known = bpe.known
                for chunks in cut:
                    chars.append(_packed(np.array([len(c) for c in chunks], np.int64)))
                    tokens.append(_packed(np.array([len(known[c]) for c in chunks], np.int64) // 4))
                yield rows.assign(chars=chars, tokens=tokens)

    return build


def _editing(path: str, with_text: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = ["doc_id", *["text"] * with_text, *COUNTS]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            out: list[tuple] = []
            for doc, text, edits, chars, tokens in zip(
                batch["doc_id"], batch["text"], batch["edits"], batch["chars"], batch["tokens"], strict=True
            ):
                tree = CountTree(text, _opened(chars), _opened(tokens))
                before, done = int(tree.tokens[1]), 0
                for edit in [] if edits is None else edits:
                    place, stop = edit["start"], edit["stop"]
                    if not (pd.isna(place) or pd.isna(stop)):
                        tree.edit(int(place), int(stop), edit["text"] or "", bpe)
                        done += 1
                counts = (before, int(tree.tokens[1]), done, len(tree.begins) - 1, tree.reencoded)
                out.append((doc, *[tree.whole()] * with_text, *counts))
            yield pd.DataFrame(out, columns=names)

    return work


def build_trees(docs: DataFrame, path: str, edits: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, its segments' lengths and token counts, and edits.

    ``edits`` (doc_id, seq, start, stop, text) is gathered per document in the order of ``seq``; an
    ``edits`` column of ``docs`` is taken where there is no such table. A null text is empty.
    """
    return mapped(
        _with_edits(docs, edits), _building(path), f"text string, edits {EDITS}, chars binary, tokens binary"
    )


def apply_edits(trees: DataFrame, path: str) -> DataFrame:
    """One row per tree: doc_id, text after its edits, and counts.

    ``n_tokens_before`` and ``n_tokens`` count the tokens of the text before and after, special
    tokens' strings being ordinary text; ``n_segments`` the segments before, ``n_chars_reencoded`` what
    was encoded anew. Edits apply one after the other, each to the text the last one left; places
    beyond the text are moved to its ends, an edit without a place is left out, and one without a
    text deletes. Repeated rows are edited alike; an empty table gives no rows.
    """
    schema = "text string, " + ", ".join(f"{n} long" for n in COUNTS)
    return mapped(trees, _editing(path, with_text=True), schema)


def recount(docs: DataFrame, path: str, edits: DataFrame | None = None) -> DataFrame:
    """The counts of ``apply_edits`` over ``build_trees``, without texts.

    Trees are made and edited in the same task, so that they need not leave it.
    """
    build, edit = _building(path), _editing(path, with_text=False)
    schema = ", ".join(f"{n} long" for n in COUNTS)
    return mapped(_with_edits(docs, edits), lambda batches: edit(build(batches)), schema)


def some_edits() -> Column:
    """Three edits that follow from a document's id and length: a replacement, a deletion, an insertion."""
    size = F.char_length(F.coalesce("text", F.lit("")))

    def place(n: int):
        return F.pmod(F.xxhash64("doc_id", F.lit(n)), size + 1).cast("long")

    def edit(n: int, length: int, text: str):
        return F.struct(place(n).alias("start"), (place(n) + length).alias("stop"), F.lit(text).alias("text"))

    return F.array(edit(1, 12, "edited words, 42"), edit(2, 7, ""), edit(3, 0, "\n  a new line's end "))


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = documents(spark, sf_dir).select("doc_id", "text", some_edits().alias("edits"))
    return recount(docs, path)


QUERIES = {"op2_token_counts": op2_token_counts}
SQL: dict[str, str] = {}
