"""Alignment of two tokenizers over the same bytes.

Each text is encoded by both. The cumulative byte ends of its tokens become two dictionaries, end
to index; the ends that both hold, in order, cut both id lists into groups. In a group, tokens that
end together are linked.

How often two ids are linked is counted over the whole corpus. Documents are worked off in blocks of
a few million characters. A block keeps its distinct pairs with their numbers, a document its links
as places in its block's pairs. So what is shuffled for the counts is one row per block and pair: a
pair that is in every document is one row per block, and a document's links are never exploded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from struct import pack
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm.bpe import SPACE, byte_letters
from shelfmark.llm.common import documents, narrow, written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of a block, unless one document has more; bounds memory and the rows of the count.
BLOCK_CHARS = 4_000_000
#: Chunks that a worker remembers, and characters encoded at once; both bound memory only.
REMEMBERED, AT_ONCE = 500_000, 500_000
#: The sign that stands for a space in pieces.
PIECE_SPACE = "▁"
#: From a single space before a word to the next such space.
CHUNK = re.compile(f" [^{SPACE}]+(?:(?!(?<! ) [^{SPACE}])[\\s\\S])*|(?:(?!(?<! ) [^{SPACE}])[\\s\\S])+")


class ByteLevel:
    """Ids and bytes of a byte-level vocabulary, with special tokens taken as plain text."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.tokens = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for token, i in self.tokenizer.get_vocab().items():
            known = all(c in byte_of for c in token)
            self.tokens[i] = bytes(byte_of[c] for c in token) if known else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class Pieces:
    """Ids and bytes of a sentencepiece model, which puts a space before a text by itself."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.tokens.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.tokens.append(piece.replace(PIECE_SPACE, " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Chunk(NamedTuple):
    """A stretch of text, aligned: whether both sides give it back, numbers, groups and links."""

    same: bool
    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


#: The columns of no chunks.
NOTHING: tuple[list, ...] = ([],) * 6


class Aligner:
    """Both tokenizers, and the chunks of text met so far.

    Both sides begin a token at a single space before a word, so both begin a group there: a chunk
    runs from one to the next, and each distinct chunk is encoded and aligned once. Where a piece of
    the vocabulary goes over from a word to a space, this does not follow, and a text is one chunk.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.lengths = [[len(t) for t in side.tokens] for side in (self.a, self.b)]
        self.numerals = [[str(i) for i in range(len(side.tokens))] for side in (self.a, self.b)]
        self.in_chunks = not any(b" " in token.lstrip(b" ") for token in self.b.tokens)
        self.known: dict[str, Chunk] = {}

    def ends(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        """The last index in ``a`` and in ``b`` of every group, in order."""
        of_a, of_b = self.lengths
        ends_a = {end: i for i, end in enumerate(accumulate([of_a[x] for x in a]))}
        ends_b = {end: i for i, end in enumerate(accumulate([of_b[x] for x in b]))}
        return [(ends_a[end], ends_b[end]) for end in sorted(ends_a.keys() & ends_b.keys())]

    def align(self, chunk: str, a: list[int], b: list[int]) -> Chunk:
        """The ids of one chunk, sliced into groups; the last two of a group end together."""
        whole, of_a, of_b = chunk.encode(), self.a.tokens, self.b.tokens
        if b"".join([of_a[x] for x in a]) != whole or b"".join([of_b[x] for x in b]) != whole:
            return Chunk(False, 0, 0, 0, "", b"")
        of_a, of_b = self.numerals
        of_a, of_b = [of_a[x] for x in a], [of_b[x] for x in b]
        groups, links, i, j = [], [], 0, 0
        ends = self.ends(a, b)
        for last_a, last_b in ends:
            groups.append(f"{','.join(of_a[i : last_a + 1])}|{','.join(of_b[j : last_b + 1])}")
            links.append(a[last_a] << 32 | b[last_b])
            i, j = last_a + 1, last_b + 1
        return Chunk(True, len(a), len(b), len(ends), ";".join(groups), pack(f"<{len(links)}q", *links))

    def _learn(self, chunks: list[str]) -> None:
        """Aligns chunks not known yet, a bounded number of characters at a time."""
        start = 0
        while start < len(chunks):
            end, size = start + 1, len(chunks[start])
            while end < len(chunks) and size + len(chunks[end]) <= AT_ONCE:
                size += len(chunks[end])
                end += 1
            some = chunks[start:end]
            bare = [c[1:] for c in some]  # both put the space before it
            for chunk, a, b in zip(some, self.a.encode(bare), self.b.encode(bare), strict=True):
                self.known[chunk] = self.align(chunk, a, b)
            start = end

    def texts(self, texts: list[str]) -> Iterator[list[Chunk]]:
        """The chunks of each text; none where a text has no tokens."""
        split = [CHUNK.findall(" " + t) if self.in_chunks else [" " + t] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        self._learn([c for c in dict.fromkeys(c for chunks in split for c in chunks) if c not in known])
        for text, chunks in zip(texts, split, strict=True):
            found = [known[c] for c in chunks] if text else []
            yield found if all([c[0] for c in found]) else []


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows of a batch that have BLOCK_CHARS characters together, or one row with more."""
    for batch in batches:
        number = (batch["text"].str.len().cumsum() - 1) // BLOCK_CHARS
        for _, block in batch.groupby(number, sort=False):
            yield block


def _aligned(docs: DataFrame, path_a: str, path_b: str, whole: bool) -> DataFrame:
    """One row per document; the first one of a block holds the block's pairs and their numbers."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = load(path_a, path_b)
        part = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            rows, links = [], []
            for chunks in aligner.texts(block["text"].tolist()):
                _, n_a, n_b, n, groups, linked = zip(*chunks) if chunks else NOTHING
                links.append(np.frombuffer(b"".join(linked), np.int64))
                joined = ";".join(groups)
                digest = hashlib.sha256(joined.encode()).hexdigest() if joined else ""
                numbers = sum(n_a), sum(n_b), sum(n), len(links[-1])
                rows.append((*numbers, digest, *([joined] if whole else [])))
            pairs, places, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            of_rows = np.split(places.astype(np.int32), np.cumsum([len(x) for x in links])[:-1])
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", block["doc_id"].to_numpy())
            out["block"] = part << 32 | number
            out["links"] = [x.tobytes() for x in of_rows]
            out["pairs"] = [pairs] + [None] * (len(out) - 1)
            out["numbers"] = [counts] + [None] * (len(out) - 1)
            yield out

    schema = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string" + ", groups string" * whole
    names = [column.split(" ")[0] for column in schema.split(", ")]
    schema = f"doc_id string, {schema}, block long, links binary, pairs array<long>, numbers array<long>"
    return docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(work, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how many links hold an id pair, and whether no pair of its B id has more.

    One B id has no more pairs than vocabulary A has ids.
    """
    counted = (
        aligned.where(F.col("pairs").isNotNull())
        .select(F.inline(F.arrays_zip("pairs", "numbers")))
        .groupBy(F.col("pairs").alias("pair"))
        .agg(F.sum("numbers").alias("count"))
    )
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(2**32 - 1))
    return counted.withColumn("best", F.col("count") == F.max("count").over(of_b))


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    With ``whole`` the groups themselves follow, as ``a1,a2|b1;a3|b2,b3``. Texts that are null or
    empty, or that a tokenizer does not give back byte by byte, have zeros and an empty digest.
    Repeated rows count each; a null id is kept; an empty table gives no rows. No column but id and
    text is looked at. Every executor has the files ``path_a`` (byte level) and ``path_b`` (pieces).
    """
    aligned = written(_aligned(narrow(docs, id_col, text_col), path_a, path_b, whole), "aligned")
    known = aligned.where(F.col("pairs").isNotNull()).select(
        F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair")
    )
    found = known.join(pair_counts(aligned), "pair").select("of_block", "place", "count", "best")
    kept = [c for c in aligned.columns if c not in ("pairs", "numbers")]

    def look_up(rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        size = len(counts)
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = counts["place"].to_numpy(np.int64)
        count[place], best[place] = counts["count"].to_numpy(), counts["best"].to_numpy()
        places = [np.frombuffer(x, np.int32) for x in rows["links"]]
        rows["n_best"] = [int(best[p].sum()) for p in places]
        rows["count_sum"] = [int(count[p].sum()) for p in places]
        return rows[out]

    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * whole
    schema = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    schema += ", groups string" * whole
    met = aligned.select(kept).groupBy("block").cogroup(found.groupBy("of_block")).applyInPandas(look_up, schema)
    return met.withColumn("doc_id", F.col("doc_id").cast("long"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in (BYTE_LEVEL, PIECES)]
    return align(documents(spark, sf_dir), *paths, whole=False)


QUERIES = {"op11_alignment": op11_alignment}
SQL: dict[str, str] = {}
