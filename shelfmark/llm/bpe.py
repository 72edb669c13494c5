"""Byte-level BPE by contiguous rank arrays.

A text falls into chunks whose ends the tokenizer's pre-tokens never cross, so each distinct chunk is encoded once per worker and remembered. The words
of new chunks are encoded together, words of one length as the rows of a matrix: a row holds the
parts of its word and, beside it, the merge ranks of adjacent parts. Each step finds the smallest
rank of every row, merges there, deletes one boundary and refreshes the two ranks next to it. As a
step takes one part from every row that goes on, the rows stay contiguous and of one length.

Long words, where repeated scans would take quadratic time, and a few words by themselves, where
matrices do not pay, use a heap of the same ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from shelfmark.llm.common import documents, mapped, narrow

TOKENIZER = "byte_bpe_50k.json"
#: White space as the pre-tokenizer's pattern understands it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin letters: all that are letters below U+0250.
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
MARKS = "!-&(-/:-@\\[-`{-~"
#: A chunk is a word of Latin letters that no other letter follows, a run of marks before white
#: space, any other run up to white space, or white space; the first two are one pre-token each.
CHUNK = re.compile(
    f" ?[{LATIN}]++(?![^\\x00-ɏ])| ?[{MARKS}]++(?![^{SPACE}])"
    f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
PLAIN = re.compile(f" ?[{LATIN}]+| ?[{MARKS}]+")
LONG_WORD = 200
FEW_WORDS = 16
NO_RANK = np.int32(2**31 - 1)
#: Remembered chunks of a worker, and characters of text taken at once; both bound memory only.
REMEMBERED = 600_000
AT_ONCE = 3_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Bytes that are visible characters of Latin-1 stand for themselves; the others, in order, for the
    code points from 256 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class PairRanks:
    """Rank of a pair of ids, or NO_RANK, for whole arrays: a hash table with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 16))))
        size = 1 << self.bits
        self.keys = np.full(size + 64, 2**64 - 1, np.uint64)
        self.ranks = np.full(size + 64, NO_RANK, np.int32)
        self.depth = 1
        for rank, (key, slot) in enumerate(zip(keys, self._slots(keys), strict=True)):
            at = int(slot)
            while self.keys[at] != 2**64 - 1 and self.keys[at] != key:
                at += 1
            if self.keys[at] != key:
                self.keys[at], self.ranks[at] = key, rank
                self.depth = max(self.depth, at - int(slot) + 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots = self._slots(keys)
        ranks = np.where(self.keys[slots] == keys, self.ranks[slots], NO_RANK)
        for step in range(1, self.depth):
            np.copyto(ranks, self.ranks[slots + step], where=self.keys[slots + step] == keys)
        return ranks


class Bpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        letters = byte_letters()
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.byte_ids = np.array([vocabulary[c] for c in letters], np.int32)
        left = np.array([vocabulary[a] for a, _ in merges], np.int32)
        right = np.array([vocabulary[b] for _, b in merges], np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int32)
        self.rank = PairRanks(left, right)
        self.rank_of = {}
        for rank, pair in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
            self.rank_of.setdefault(pair, rank)
        byte_of = {c: b for b, c in enumerate(letters)}
        self.tokens = [b""] * (max([*vocabulary.values(), *self.specials.values()]) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(byte_of[c] for c in token)
        for token, i in self.specials.items():
            self.tokens[i] = token.encode()
        self.numerals = [str(i) for i in range(len(self.tokens))]
        self.split_specials = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.pretokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[str, bytes] = {}

    def _same_length(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words that all have the same number of bytes."""
        found: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        parts = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), -1)
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        which = np.arange(len(words))
        while True:
            width = parts.shape[1]
            if width == 1:
                best = np.full(len(parts), NO_RANK)
            else:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(parts)), at]
            live = best != NO_RANK
            if not live.all():
                for row, word in zip(parts[~live], which[~live].tolist(), strict=True):
                    found[word] = row
                if not live.any():
                    return found
                parts, ranks, which = parts[live], ranks[live], which[live]
                at, best = at[live], best[live]
            rows = np.arange(len(parts))
            parts[rows, at] = self.merged[best]
            stay = np.ones(parts.shape, bool)
            stay[rows, at + 1] = False
            parts = parts[stay].reshape(len(rows), width - 1)
            stay = np.ones(ranks.shape, bool)
            stay[rows, at] = False
            ranks = ranks[stay].reshape(len(rows), width - 2)
            for place in (at - 1, at):
                inside = (place >= 0) & (place < width - 2)
                r, p = rows[inside], place[inside]
                ranks[r, p] = self.rank(parts[r, p], parts[r, p + 1])

    def _long(self, word: bytes) -> np.ndarray:
        """The same merges for one long word: smallest rank first, the leftmost of equals."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank_of, heap = self.rank_of, []
        for i in range(len(ids) - 1):
            if (rank := rank_of.get((ids[i], ids[i + 1]))) is not None:
                heap.append((rank, i))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or rank_of.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (r := rank_of.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([i for i in ids if i >= 0], np.int32)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each pre-token, given as its bytes."""
        if len(words) < FEW_WORDS:
            return [self._long(word) for word in words]
        found: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
        for length, members in lengths.items():
            if length > LONG_WORD:
                for i in members:
                    found[i] = self._long(words[i])
            elif length:
                step = max(1, 400_000 // length)
                for start in range(0, len(members), step):
                    some = members[start : start + step]
                    for i, ids in zip(some, self._same_length([words[i] for i in some]), strict=True):
                        found[i] = ids
        return found

    def pretokens(self, chunk: str) -> list[bytes]:
        return [chunk[a:b].encode() for _, (a, b) in self.pretokenizer.pre_tokenize_str(chunk)]

    def learn(self, chunks: set[str]) -> None:
        """Encodes the chunks that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [chunk for chunk in chunks if chunk not in self.known]
        plain = PLAIN.fullmatch
        simple = [chunk for chunk in new if plain(chunk)]
        for chunk, ids in zip(simple, self.encode_words([c.encode() for c in simple]), strict=True):
            self.known[chunk] = ids.tobytes()
        mixed = [chunk for chunk in new if not plain(chunk)]
        words = [self.pretokens(chunk) for chunk in mixed]
        ids = iter(self.encode_words([w for ws in words for w in ws]))
        for chunk, ws in zip(mixed, words, strict=True):
            self.known[chunk] = b"".join([next(ids).tobytes() for _ in ws])

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; special tokens in a text count as such."""
        start = 0
        while start < len(texts):
            end, size = start + 1, len(texts[start])
            while end < len(texts) and size + len(texts[end]) <= AT_ONCE:
                size += len(texts[end])
                end += 1
            pieces = [
                [p if p in self.specials else CHUNK.findall(p) for p in self.split_specials.split(t)]
                if self.specials and any(s in t for s in self.specials)
                else [CHUNK.findall(t)]
                for t in texts[start:end]
            ]
            self.learn({c for text in pieces for p in text if isinstance(p, list) for c in p})
            known = self.known
            for text in pieces:
                yield np.frombuffer(
                    b"".join(
                        np.int32(self.specials[p]).tobytes()
                        if isinstance(p, str)
                        else b"".join([known[c] for c in p])
                        for p in text
                    ),
                    np.int32,
                )
            start = end

    def decode(self, ids: list[int]) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_decode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, digests of ids and of the decoded text.

    With ``whole`` the ids and the decoded text themselves follow. Null and empty texts have no ids
    and decode to an empty text. Repeated rows give equal rows; an empty table gives none.
    ``path`` names the vocabulary file, which every executor has at the same place.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for ids in bpe.encode_all(batch["text"].tolist()):
                numbers = ids.tolist()
                decoded = bpe.decode(numbers)
                numerals = ",".join([bpe.numerals[i] for i in numbers])
                out["n_tokens"].append(len(numbers))
                out["ids_sha256"].append(hashlib.sha256(numerals.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if whole:
                    out["ids"].append(ids)
                    out["decoded"].append(decoded)
            yield pd.DataFrame({"doc_id": batch["doc_id"], **out})

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if whole else ""
    names = [column.split(" ")[0] for column in schema.split(", ")]
    return mapped(narrow(docs, id_col, text_col), encode, schema)


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), whole=False)


QUERIES = {"op5_bpe": op5_bpe}
SQL: dict[str, str] = {}
