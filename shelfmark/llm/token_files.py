"""Token ids in files compressed by Re-Pair grammars.

Documents are dealt by ranges of doc_id and sorted, so that files in their order hold ids in
ascending order. A block of about a million ids has a grammar of its own: in each round the most
frequent pairs of neighbouring symbols get nonterminals and are replaced, never across the end of a
document, until no pair can be replaced ``LEAST_COUNT`` times or 16-bit symbols are used up. A block stores its rules with their
expansion lengths, and for each document where its symbols begin and how many ids they stand for, so
that one document, or a slice of one, is decoded without the rest.

A file row is one block; rows are written and read by Spark, on any store it reaches.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.bpe import LATIN, MARKS, SPACE
from shelfmark.llm.common import documents, narrow, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 20
RULES_A_ROUND = 4096
#: A rule takes 6 bytes and more, an occurrence saves 2: fewer than 4 do not pay.
LEAST_COUNT = 4
#: After a round of fewer rules pairs are told apart exactly.
FEW_RULES = 256
MAGIC = b"RPB1"
ONE_PRETOKEN = re.compile(f"[{LATIN}]+|[{MARKS}]+")
OTHER = re.compile("[^\\x00-ɏ]")
WORD_END = "</w>"
#: What a code unit of UTF-16 is: white space, a letter of LATIN, or anything else.
_UNITS = "".join(map(chr, range(1 << 16)))
KINDS = np.full(1 << 16, 2, np.uint8)
KINDS[[ord(c) for c in re.findall(f"[{SPACE}]", _UNITS)]] = 0
KINDS[[ord(c) for c in re.findall(f"[{LATIN}]", _UNITS)]] = 1
#: Remembered chunks of a worker, and characters taken at once; both bound memory only.
REMEMBERED = 1_000_000
AT_ONCE = 6_000_000
_HASH_BITS = 18


def _runs(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of values, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if ends.size else 0
    return values[np.repeat(begins - (ends - sizes), sizes) + np.arange(total)]


def chunks(texts: list[str], split: bool) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts, as UTF-16, and where those of each text begin and end.

    Chunks end at white space. With ``split``, letters of LATIN at their beginning are a chunk of
    their own.
    """
    units = [t.encode("utf-16-le") for t in texts]
    codes = np.frombuffer(b"\n\0".join([*units, b""]), np.uint16)
    ends = np.cumsum([len(u) // 2 + 1 for u in units])
    kinds = KINDS.take(codes)
    solid = kinds > 0
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    if split:
        words = np.flatnonzero(begins)
        cuts = np.flatnonzero((kinds[1:] == 2) & (kinds[:-1] == 1)) + 1
        of = np.searchsorted(words, cuts, side="right") - 1
        begins[cuts[(np.diff(of, prepend=-1) > 0) & (kinds[words[of]] == 1)]] = True
    bounds = np.searchsorted(np.flatnonzero(begins), np.concatenate([[0], ends]))
    solid_codes = codes[solid]
    offsets = np.append(np.flatnonzero(begins[solid]), solid_codes.size) * 2
    found = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(solid_codes)]
    )
    return found, bounds


class Encoder:
    """The tokenizer, asked once for each distinct chunk of text.

    No pre-token of this vocabulary crosses white space, so a text's ids are those of its chunks. In
    plain texts, without letters or marks from U+0250 on, lower case and composition do not depend
    on neighbours: words at the beginning of a chunk are chunks of their own.
    Chunks of one pre-token are encoded as one text, whose ids are cut after each end of a word.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # Chunks met of late, and those met before them.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def learn(self, new: list[bytes]) -> None:
        words, mixed = {}, {}
        for raw in new:
            chunk = raw.decode("utf-16-le")
            if ONE_PRETOKEN.fullmatch(chunk) and chunk == chunk.lower():
                words[raw] = chunk
            else:
                mixed[raw] = chunk
        raws, single = list(words), list(words.values())
        for start in range(0, len(single), 2_000):
            some = single[start : start + 2_000]
            found = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found[0].ids, np.int32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                raise ValueError(f"{len(some)} words gave {len(cuts)} ends of words: {some[:20]}")
            packed, at = ids.tobytes(), 0
            for raw, cut in zip(raws[start : start + 2_000], (4 * cuts).tolist(), strict=True):
                self.known[raw] = packed[at:cut]
                at = cut
        found = self.tokenizer.encode_batch_fast(list(mixed.values()), add_special_tokens=False)
        for raw, encoded in zip(mixed, found, strict=True):
            self.known[raw] = np.array(encoded.ids, np.int32).tobytes()

    def recall(self, wanted: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks. What was not wanted for long is forgotten first."""
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        ids = [known.get(c) for c in wanted]
        missing = [k for k, i in enumerate(ids) if i is None]
        new = [c for c in (wanted[k] for k in missing) if c not in older]
        self.learn(new)
        for k in missing:
            c = wanted[k]
            ids[k] = known[c] = known[c] if c in known else older[c]
        return ids

    def encode_some(self, texts: list[str], split: bool) -> list[np.ndarray]:
        pieces, bounds = chunks(texts, split)
        numbered = pieces.dictionary_encode()
        of = numbered.indices.to_numpy()
        ids = self.recall(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        lengths = sizes[of]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        every = _runs(np.frombuffer(b"".join(ids), np.int32), (np.cumsum(sizes) - sizes)[of], lengths)
        cuts = ends[bounds].tolist()
        return [every[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and size < AT_ONCE:
                size += len(texts[end])
                end += 1
            some = texts[start:end]
            whole = ["<|" in t or OTHER.search(t) is not None for t in some]
            plain = iter(self.encode_some([t.lower() for t, w in zip(some, whole, strict=True) if not w], True))
            other = iter(self.encode_some([t for t, w in zip(some, whole, strict=True) if w], False))
            for w in whole:
                yield next(other if w else plain)
            start = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left.astype(np.uint32) * np.uint32(0x9E3779B1) + right.astype(np.uint32) * np.uint32(0x85EBCA77)
    return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - _HASH_BITS)


def _replace(symbols: np.ndarray, first: np.ndarray, names: int, spare: int, exact: bool):
    """One round: the rules made, and symbols and document starts after it.

    Pairs are counted by hash, and one speaks for its hash; ``exact`` rounds then tell all pairs apart.
    """
    left, right = symbols[:-1], symbols[1:]
    inner = ~first[1:]
    kinds = _hash(left, right).astype(np.intp)
    counts = np.bincount(kinds[inner], minlength=1 << _HASH_BITS)
    wanted = min(spare, RULES_A_ROUND)
    pairs = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
    if exact:
        at = np.flatnonzero((counts >= LEAST_COUNT).take(kinds) & inner)
        _, kinds, counts = np.unique(pairs[at], return_inverse=True, return_counts=True)
    cut = max(LEAST_COUNT, int(np.partition(counts, -wanted)[-wanted]) if len(counts) > wanted else 0)
    if exact:
        frequent = (counts >= cut)[kinds]
        at, kinds = at[frequent], kinds[frequent]
    else:
        at = np.flatnonzero((counts >= cut).take(kinds) & inner)
        kinds = kinds[at]
    speaks = np.full(len(counts), -1, np.int64)
    speaks[kinds] = at
    same = pairs[at] == pairs[speaks[kinds]]
    at, kinds = at[same], kinds[same]
    # of overlapping occurrences every second one is replaced, from the left
    run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(at.size), 0))
    free = (np.arange(at.size) - run) % 2 == 0
    at, kinds = at[free], kinds[free]
    used = np.bincount(kinds, minlength=len(counts))
    chosen = np.flatnonzero(used >= LEAST_COUNT)
    chosen = chosen[np.argsort(-used[chosen], kind="stable")][:wanted]
    name = np.full(len(counts), -1, np.int64)
    name[chosen] = names + np.arange(chosen.size)
    named = name[kinds]
    at, named = at[named >= 0], named[named >= 0]
    rules = np.stack([left[speaks[chosen]], right[speaks[chosen]]], axis=1).astype(np.uint16)
    out = symbols.copy()
    out[at] = named
    stay = np.ones(symbols.size, bool)
    stay[at + 1] = False
    return rules, out[stay], first[stay]


def pack(doc_ids: np.ndarray, known: np.ndarray, ids: np.ndarray, lengths: np.ndarray, names: int) -> bytes:
    """A block of documents of ``lengths`` ids each, every one at least one id; ids are below ``names``.

    ``known`` tells which documents have an id of their own. Symbols have 16 bits: a vocabulary of
    more ids is refused.
    """
    if names > 1 << 16:
        raise ValueError(f"a vocabulary of {names} ids does not fit symbols of 16 bits")
    symbols = ids.astype(np.int32)
    first = np.zeros(ids.size, bool)
    first[np.cumsum(lengths) - lengths] = True
    rules, rounds = [], []
    total = names
    exact = False
    while symbols.size > 1 and total < 1 << 16:
        made, symbols, first = _replace(symbols, first, total, (1 << 16) - total, exact)
        if len(made):
            rules.append(made)
            rounds.append(len(made))
            total += len(made)
        elif exact:
            break
        exact = len(made) < FEW_RULES
    every = np.concatenate(rules) if rules else np.empty((0, 2), np.uint16)
    spans = np.ones(total, np.int64)
    at = names
    for made in rules:
        spans[at : at + len(made)] = spans[made[:, 0]] + spans[made[:, 1]]
        at += len(made)
    head = struct.pack("<4s5q", MAGIC, names, len(doc_ids), len(rounds), len(every), symbols.size)
    parts = (
        doc_ids.astype("<i8"), known.astype("u1"), np.flatnonzero(first).astype("<i8"), lengths.astype("<i8"),
        np.array(rounds, "<i8"), every.astype("<u2"), spans[names:].astype("<i8"), symbols.astype("<u2"),
    )
    return head + zlib.compress(b"".join(p.tobytes() for p in parts), 1)


class Block:
    """A packed block, opened."""

    def __init__(self, packed: bytes) -> None:
        size = struct.calcsize("<4s5q")
        magic, self.names, docs, rounds, rules, symbols = struct.unpack("<4s5q", packed[:size])
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        body, at = zlib.decompress(packed[size:]), 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(body, kind, n, at)
            at += found.nbytes
            return found

        self.doc_ids, self.known, self.starts = take("<i8", docs), take("u1", docs), take("<i8", docs)
        self.lengths, self.rounds = take("<i8", docs), take("<i8", rounds)
        self.rules, self.spans = take("<u2", 2 * rules).reshape(-1, 2), take("<i8", rules)
        self.symbols = take("<u2", symbols)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for: rounds undone from the last to the first."""
        ids = symbols.astype(np.int32)
        last = self.names + len(self.rules)
        for made in self.rounds[::-1].tolist():
            begin = last - made
            ruled = ids >= begin
            where = np.cumsum(ruled + 1) - ruled - 1
            out = np.empty(ids.size + int(ruled.sum()), np.int32)
            out[where] = ids
            pairs = self.rules[ids[ruled] - self.names]
            out[where[ruled]], out[where[ruled] + 1] = pairs[:, 0], pairs[:, 1]
            ids, last = out, begin
        return ids

    def every(self) -> np.ndarray:
        """The ids of all documents: rules are expanded once, from the first round to the last."""
        spans = np.concatenate([np.ones(self.names, np.int64), self.spans])
        ends = np.cumsum(spans)
        begins = ends - spans
        ids, at = np.arange(ends[-1], dtype=np.int32), self.names
        for made in self.rounds.tolist():
            parts = self.rules[at - self.names : at - self.names + made].ravel()
            ids[begins[at] : ends[at + made - 1]] = _runs(ids, begins[parts], spans[parts])
            at += made
        return _runs(ids, begins[self.symbols], spans[self.symbols])

    def document(self, k: int) -> np.ndarray:
        end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.symbols)
        return self.expand(self.symbols[self.starts[k] : end])

    def part(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of a document; only symbols that reach into them are expanded."""
        end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.symbols)
        symbols = self.symbols[self.starts[k] : end].astype(np.int64)
        spans = np.ones(symbols.size, np.int64)
        spans[symbols >= self.names] = self.spans[symbols[symbols >= self.names] - self.names]
        ends = np.cumsum(spans)
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - before : max(start, stop) - before]


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Blocks of the documents in ascending doc_id order: part, seq, n_ids, block.

    Parts and, in each, blocks are in order. Null ids come first, rows of one id in the order of
    their texts' hashes. A null or empty text is its end id alone. An empty table gives no blocks.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        names = encode.tokenizer.get_vocab_size()
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[object, np.ndarray]] = []

        def block() -> pd.DataFrame:
            known = np.array([d is not None for d, _ in held], bool)
            numbers = np.array([int(d) if k else 0 for (d, _), k in zip(held, known, strict=True)], np.int64)
            ids = np.concatenate([i for _, i in held])
            packed = pack(numbers, known, ids, np.array([i.size for _, i in held]), names)
            return pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [ids.size], "block": [packed]})

        for batch in batches:
            for doc, ids in zip(batch["doc_id"], encode.encode_all(batch["text"].tolist()), strict=True):
                held.append((doc, np.append(ids, np.int32(end_id))))
                size += ids.size + 1
                if size >= BLOCK_IDS:
                    yield block()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield block()

    return (
        narrow(docs, id_col, text_col)
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        .mapInPandas(work, "part int, seq int, n_ids long, block binary")
    )


def read_documents(blocks: DataFrame, ids: bool = True) -> DataFrame:
    """What the blocks hold, one row per document: doc_id, start, n_tokens, ids_crc32, and the ids."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, packed in zip(batch["part"], batch["seq"], batch["block"], strict=True):
                block = Block(packed)
                every = block.every()
                ends = np.cumsum(block.lengths)
                begins = ends - block.lengths
                raw = memoryview(every.astype("<u4").tobytes())
                out = pd.DataFrame({
                    "part": part, "seq": seq,
                    "doc_id": pd.array(block.doc_ids, "Int64"),
                    "inside": begins,
                    "n_tokens": block.lengths,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)],
                })
                out.loc[block.known == 0, "doc_id"] = pd.NA
                if ids:
                    out["ids"] = [every[a:b] for a, b in zip(begins, ends, strict=True)]
                yield out

    schema = "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    found = blocks.select("part", "seq", "block").mapInPandas(work, schema + ", ids array<int>" * ids)
    sizes = blocks.select(F.col("part").alias("of_part"), F.col("seq").alias("of_seq"), "n_ids")
    # parts are few; blocks of one part are summed by themselves
    parts = sizes.groupBy("of_part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("of_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("of_part").orderBy("of_seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "of_part", "of_seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_start")
    ).join(parts, "of_part")
    return found.join(
        starts, (F.col("part") == F.col("of_part")) & (F.col("seq") == F.col("of_seq"))
    ).select(
        "doc_id",
        (F.col("part_start") + F.col("block_start") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *["ids"] * ids,
    )


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    blocks = written(pack_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER)), "token-files")
    return read_documents(blocks, ids=False)


QUERIES = {"op8_token_files": op8_token_files}
SQL: dict[str, str] = {}
