"""Benchmark passages in documents, up to a share of edits.

Texts are read in windows sized after the items. Each window is embedded by CGK random walks: a walk
copies the byte it stands on and, by a random bit that depends on step and byte, stays or moves on.
Two windows a few edits apart give walks that mostly agree, so that edit distance shows as Hamming
distance, for which sampling positions is a locality-sensitive hash. Several walks, and several
samples of each, are tried; a document's windows come at a stride of a quarter window and an item's at
every byte, so that a passage holds many windows of which one has to agree. Windows are short, for one
of them to lie where a passage at the threshold happens to hold few edits.

Hashes of item windows are known to all tasks as a Bloom filter of a fixed size. Windows that pass
are gathered to regions, joined with the items by hash, and verified: the least edit distance of the
whole item to any part of the region, by bit-parallel dynamic programming over many pairs at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, mapped, narrow, only, written

#: Edits per code point of an item, at most: similarity 0.8 or more.
MOST_EDITS = 0.2
WALKS = 3
SAMPLES = 3
#: Steps sampled for each byte of a window at up to MOST_EDITS; fewer for more edits.
SAMPLED = 0.75
#: Window bytes are a third of the shortest item, within these bounds; items of fewer bytes than
#: LEAST_ITEM are looked for word by word.
WINDOW = (12, 20)
LEAST_ITEM = 24
#: Bits of the Bloom filter, as a power of two, and of the blocks it is built in.
BLOOM_BITS = 27
BLOOM_BLOCK = 1 << 17
AT_ONCE = 2 << 20
#: Windows whose walks are done together; bounds memory only.
WINDOWS_AT_ONCE = 1 << 13
#: Pairs verified together; bounds memory only.
PAIRS_AT_ONCE = 2048
#: Up to so many pairs, a step's cost is that of its calls.
FEW_PAIRS = 512
#: Letters by which beginnings of an item may differ and be verified together.
STEP = 64
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


@dataclass
class Walks:
    """The random choices that all windows share, fixed by the window's size and the share of edits."""

    window: int
    most_edits: float = MOST_EDITS

    def __post_init__(self) -> None:
        random = np.random.default_rng(20 + self.window)
        self.steps = steps = 2 * self.window
        moves = random.integers(0, 2, (WALKS, steps, 256)).astype(bool)
        moves[:, :, 0] = False  # nothing lies behind the end of a window
        values = random.integers(0, 2**64, (WALKS, steps, 256), np.uint64)
        sampled = max(6, round(SAMPLED * self.window * min(1, MOST_EDITS / max(self.most_edits, 1e-9))))
        picked = np.zeros((WALKS, SAMPLES, steps, 1), bool)
        for k in np.ndindex(WALKS, SAMPLES):
            picked[k][np.sort(random.choice(steps, sampled, replace=False))] = True
        # For a letter and the step at which a walk comes to it: how many steps it stays, and what these
        # add to each hash. From the last step to the first, as a walk that stays goes on as the next step does.
        self.stays = np.zeros((WALKS, 256, steps + 1, 1 + SAMPLES), np.uint64)
        for step in range(steps - 1, -1, -1):
            here = self.stays[:, :, step]
            here[:] = np.where(moves[:, step, :, None], np.uint64(0), self.stays[:, :, step + 1])
            here[..., 0] += np.uint64(1)
            here[..., 1:] += np.where(picked[:, :, step], values[:, None, step], np.uint64(0)).transpose(0, 2, 1)
        self.stays = self.stays.reshape(WALKS, -1, 1 + SAMPLES)

    @property
    def stride(self) -> int:
        return self.window // 4

    def sums(self, data: np.ndarray, stride: int) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of windows: the number of the first, and for each walk and window the steps done and its hashes.

        A hash is the sum of random numbers that stand for the letters at the sampled steps. Walks are
        done letter by letter: all steps that one stays on a letter are read at once.
        """
        count = (data.size - self.window) // stride + 1
        begin = np.zeros((WALKS, 1, 1 + SAMPLES), np.uint64)
        begin[:, 0, 1:] = np.arange(1, WALKS * SAMPLES + 1).reshape(WALKS, SAMPLES)
        for first in range(0, count, WINDOWS_AT_ONCE):
            n = min(WINDOWS_AT_ONCE, count - first)
            some = data[first * stride :][: (n - 1) * stride + self.window].astype(np.intp) * (self.steps + 1)
            letters = [np.ascontiguousarray(some[at::stride][:n]) for at in range(self.window)]
            letters.append(np.zeros(n, np.intp))
            row, stay = np.empty(n, np.intp), np.empty((n, 1 + SAMPLES), np.uint64)
            found = np.repeat(begin, n, axis=1)
            for walk in range(WALKS):
                step = found[walk, :, 0].view(np.intp)
                for letter in letters:
                    np.add(letter, step, out=row)
                    np.take(self.stays[walk], row, axis=0, out=stay, mode="clip")
                    found[walk] += stay
            yield first, found

    def hashes(self, data: np.ndarray, stride: int) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of windows: the number of the first, and one row of hashes per sample."""
        for first, found in self.sums(data, stride):
            yield first, found[:, :, 1:].transpose(0, 2, 1).reshape(WALKS * SAMPLES, -1)


def bloom_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - BLOOM_BITS)
    return hashes >> shift, ((hashes ^ (hashes >> np.uint64(29))) * _MIX2) >> shift


def outline(bloom: np.ndarray) -> np.ndarray:
    """One bit for every 16 of the filter: small enough for a core's cache, it stops most windows."""
    return np.packbits(bloom.view(np.uint16) != 0, bitorder="little")


def _bits(packed: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places.view(np.int64)
    return (packed.take(places >> 3, mode="clip") >> (places & 7).astype(np.uint8)) & 1 == 1


def least_distances(items: list[str], texts: list[str]) -> np.ndarray:
    """The least edit distance of each item to any part of the text beside it.

    Bit-parallel dynamic programming over many pairs at once: a column of the table is a few 64-bit
    words per pair, and each step takes in one letter of every text. Pairs of like sizes go together,
    and few pairs whatever their sizes.
    """
    lengths = np.array([len(i) for i in items], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.maximum(1, -(-lengths // 64))
    best = lengths.copy()
    order = np.lexsort((sizes, words))
    start = 0
    while start < len(order):
        end, longest = start + 1, sizes[order[start]]
        while end < len(order) and end - start < PAIRS_AT_ONCE:
            longest = max(longest, sizes[order[end]])
            alike = words[order[end]] == words[order[start]] or end - start < FEW_PAIRS
            if not alike or (end + 1 - start) * longest > AT_ONCE:
                break
            end += 1
        some = order[start:end]
        best[some] = _column_by_column([items[i] for i in some], [texts[i] for i in some], int(words[some].max()))
        start = end
    return best


def distances_within(items: list[str], texts: list[str], most: np.ndarray) -> np.ndarray:
    """``least_distances`` where they are at most ``most``; elsewhere any larger number.

    The beginning of an item is at no greater distance than the item, so that pairs whose beginnings
    are too far apart are settled. Behind a beginning the rest of the item, less the edits, has to
    have room.
    """
    lengths = np.array([len(i) for i in items], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    begun = np.maximum(64, -(-2 * most // 64) * 64)
    ends = np.maximum(0, sizes - lengths + begun + most)
    open_, some = np.ones(len(items), bool), np.flatnonzero(begun < lengths)
    near = least_distances([items[i][: begun[i]] for i in some], [texts[i][: ends[i]] for i in some])
    open_[some] = near <= most[some]
    best, left = most + 1, np.flatnonzero(open_)
    best[left] = least_distances([items[i] for i in left], [texts[i] for i in left])
    return best


def _column_by_column(items: list[str], texts: list[str], words: int) -> np.ndarray:
    """``least_distances`` of pairs whose items have at most as many words of 64 letters."""
    n = len(items)
    numbers = {item: i for i, item in enumerate(dict.fromkeys(items))}
    known = sorted({ord(c) for item in numbers for c in item})
    letters = {chr(c): i for i, c in enumerate(known)}
    # Where each letter stands in each item; the last letter is any that no item has.
    masks = np.zeros((words, len(numbers), len(letters) + 1), np.uint64)
    for item, i in numbers.items():
        for at, c in enumerate(item):
            masks[at // 64, i, letters[c]] |= np.uint64(1 << at % 64)
    masks = masks.reshape(words, -1)
    sizes = np.array([len(text) for text in texts], np.int64)
    longest = int(sizes.max())
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    places = np.full(max(known, default=-1) + 2, len(letters), np.int32)
    places[known] = np.arange(len(letters))
    read = np.zeros((n, longest), np.int32)
    read[np.arange(longest) < sizes[:, None]] = places.take(codes, mode="clip")
    offsets = np.array([numbers[item] for item in items], np.int32) * np.int32(len(letters) + 1)
    read = np.ascontiguousarray((read + offsets[:, None]).T)
    score = np.array([len(item) for item in items], np.int64)
    best, one, high = score.copy(), np.uint64(1), np.uint64(63)
    top = np.array([1 << (len(item) - 1) % 64 if item else 0 for item in items], np.uint64)
    last = (score - 1) // 64
    tops = [np.where(last == w, top, np.uint64(0)) if (last == w).any() else None for w in range(words)]
    up, down = np.full((words, n), 2**64 - 1, np.uint64), np.zeros((words, n), np.uint64)
    for step in range(longest):
        carry = plus = minus = np.zeros(n, np.uint64)
        for w in range(words):
            equal = masks[w].take(read[step])
            part = equal & up[w]
            total = part + up[w]
            over = total < part
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            diagonal = (total ^ up[w]) | equal | down[w]
            right_up = down[w] | ~(diagonal | up[w])
            right_down = up[w] & diagonal
            if tops[w] is not None:
                score += ((right_up & tops[w]) != 0).astype(np.int64)
                score -= (right_down & tops[w]) != 0
            shifted_up, shifted_down = (right_up << one) | plus, (right_down << one) | minus
            plus, minus = right_up >> high, right_down >> high
            up[w] = shifted_down | ~(diagonal | shifted_up)
            down[w] = shifted_up & diagonal
        np.minimum(best, score, out=best, where=step < sizes)
    return best


def least_distance(item: str, text: str) -> np.ndarray:
    return least_distances([item], [text])


def _regions(
    docs: list[bytes], walks: Walks, bloom: np.ndarray, rough: np.ndarray, reach: int
) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    """Of a few documents: number, text around windows that the filter lets pass, where in it these
    begin (in code points), and their hashes."""
    data = np.frombuffer(b"\0".join(docs), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    places, passed = [], []
    shift = np.uint64(64 - BLOOM_BITS + 4)
    for first, found in walks.sums(data, walks.stride):
        for sums in found:
            flat = sums.ravel()
            at = np.flatnonzero(_bits(rough, flat >> shift))
            at = at[at % sums.shape[1] > 0]  # the first column counts steps
            one, two = bloom_places(flat[at])
            at = at[_bits(bloom, one) & _bits(bloom, two)]
            places.append((first + at // sums.shape[1]) * walks.stride)
            passed.append(flat[at])
    if not places:
        return
    at, hashes = np.concatenate(places), np.concatenate(passed)
    order = np.argsort(at, kind="stable")
    at, hashes = at[order], hashes[order]
    of = np.searchsorted(starts, at, side="right") - 1
    cuts = np.flatnonzero((np.diff(of) > 0) | (np.diff(at) > reach)) + 1
    for some in np.split(np.arange(len(at)), cuts):
        if some.size:
            doc = int(of[some[0]])
            a = max(0, int(at[some[0]] - starts[doc]) - reach)
            b = int(at[some[-1]] - starts[doc]) + walks.window + reach
            letters = np.cumsum(data[starts[doc] + a : starts[doc] + min(b, len(docs[doc]))] & 0xC0 != 0x80)
            begun = letters[at[some] - starts[doc] - a] - 1
            yield doc, docs[doc][a:b].decode("utf-8", "ignore"), begun, hashes[some]


def find_verbatim(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Items too short for windows: (doc_id, item_id, distance, length) where their words stand in a document.

    Runs of as many words as an item has are joined with the items by equality. So short, an item has
    a dozen words at most, so there are few lengths of runs; without short items no document is read.
    """

    def read_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.assign(item=batch["text"].map(normal))[["item_id", "item"]]
            sizes = rows["item"].str.encode("utf-8").str.len()
            yield rows[(sizes > 0) & (sizes < LEAST_ITEM)].assign(n_words=rows["item"].str.count(" ") + 1)

    def normalise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id"]].assign(words=[normal(t).split() for t in batch["text"]])

    short = (
        items.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .where(F.col("text").isNotNull())
        .distinct()
        .mapInPandas(read_items, "item_id string, item string, n_words int")
        .distinct()
    )
    short = written(short, "short-items")
    sizes = sorted(r["n_words"] for r in short.select("n_words").distinct().collect())
    words = mapped(narrow(docs, id_col, text_col), normalise, "words array<string>")
    if not sizes:
        words = words.where("false")
    runs = [
        F.expr(
            f"transform(sequence(1, size(words) - {n - 1}), i -> array_join(slice(words, i, {n}), ' '))"
            if n > 1 else "words"
        )
        for n in sizes or [1]
    ]
    runs = [F.when(F.size("words") >= n, run) for n, run in zip(sizes or [1], runs, strict=True)]
    # Repeats of a run in a document are one row before anything is shuffled.
    found = words.select("doc_id", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*runs))))).alias("run"))
    return found.join(short, F.col("run") == F.col("item")).select(
        "doc_id", "item_id", F.lit(0).cast("long").alias("distance"), F.length("item").cast("long").alias("length")
    )


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_edits: float = MOST_EDITS,
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, similarity.

    An item is found where some part of the document, lower-cased and with white space as single
    spaces, is at most ``most_edits`` edits per code point of the item away. Items of fewer than
    ``LEAST_ITEM`` bytes are found where all their words stand in the document unchanged. Null and
    empty items are found nowhere, and null and empty texts hold none. Items repeated with their id
    count once, equal items with different ids each; repeated documents give one row. With an empty
    table there are no rows.
    """
    lengths = items.select(F.col("text").alias("text")).where(F.octet_length("text") >= LEAST_ITEM)
    sizes = lengths.agg(F.min(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    shortest, reach = sizes[0] or LEAST_ITEM, (sizes[1] or LEAST_ITEM) * 3 // 2
    walks = Walks(min(max(shortest // 3, WINDOW[0]), WINDOW[1]), most_edits)

    def read_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item_id, text in zip(batch["item_id"], batch["text"], strict=True):
                item = normal(text)
                data = np.frombuffer(item.encode(), np.uint8)
                if data.size < LEAST_ITEM:
                    continue
                hashes = np.concatenate([h for _, h in walks.hashes(data, 1)], axis=1)
                begun = np.tile((np.cumsum(data & 0xC0 != 0x80) - 1)[: hashes.shape[1]], len(hashes))
                yield pd.DataFrame(
                    {"item_id": [item_id], "item": [item], "hashes": [hashes.ravel().view(np.int64)], "places": [begun]}
                )

    known = written(
        items.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .where("text is not null")
        .distinct()
        .mapInPandas(read_items, "item_id string, item string, hashes array<long>, places array<int>"),
        "items",
    )

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for hashes in batch["hashes"]:
                both = np.unique(np.concatenate(bloom_places(np.asarray(hashes, np.int64).view(np.uint64))))
                yield pd.DataFrame({"block": (both // BLOOM_BLOCK).astype(np.int32), "bit": (both % BLOOM_BLOCK).astype(np.int32)})

    def filled(block: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(BLOOM_BLOCK, np.uint8)
        bits[block["bit"]] = 1
        packed = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
        return pd.DataFrame({"block": block["block"].head(1), "packed": [packed]})

    blocks = (
        known.mapInPandas(places, "block int, bit int")
        .distinct()
        .groupBy("block")
        .applyInPandas(filled, "block int, packed binary")
        .collect()
    )
    bloom = np.zeros((1 << BLOOM_BITS) // BLOOM_BLOCK * (BLOOM_BLOCK // 8), np.uint8).reshape(-1, BLOOM_BLOCK // 8)
    for row in blocks:
        bloom[row.block] = np.frombuffer(zlib.decompress(row.packed), np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(bloom.tobytes(), 1))
    del bloom, blocks

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bloom = np.frombuffer(zlib.decompress(sent.value), np.uint8)
        rough = outline(bloom)
        for batch in batches:
            ids, texts, start = batch["doc_id"], batch["text"].tolist(), 0
            found: list[tuple] = []
            while start < len(texts):
                some, size = [], 0
                while start + len(some) < len(texts) and (not some or size < AT_ONCE):
                    some.append(normal(texts[start + len(some)]).encode())
                    size += len(some[-1])
                for doc, region, begun, hashes in _regions(some, walks, bloom, rough, reach):
                    found.append((ids.iloc[start + doc], region, begun, hashes.view(np.int64)))
                start += len(some)
            yield pd.DataFrame(found, columns=["doc_id", "region", "places", "hashes"])

    around = mapped(narrow(docs, id_col, text_col), search, "region string, places array<int>, hashes array<long>")
    regions = written(around.withColumn("at", F.monotonically_increasing_id()), "regions")

    def windows(rows: DataFrame, key: str, place: str) -> DataFrame:
        both = rows.select(key, F.inline(F.arrays_zip("hashes", "places")))
        return both.select(key, F.col("hashes").alias("h"), F.col("places").alias(place))

    # Where the item would begin for the windows to lie on each other, in steps of a few letters.
    step = F.floor((F.col("there") - F.col("here")) / STEP).alias("step")
    pairs = windows(regions, "at", "there").join(windows(known, "item_id", "here"), "h").select("at", "item_id", step)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch["item"].str.len().to_numpy(np.int64)
            most = np.floor(most_edits * length).astype(np.int64)
            far = distances_within(batch["item"].tolist(), batch["part"].tolist(), most)
            yield batch[["doc_id", "item_id"]].assign(distance=far, length=length)[far <= most]

    # Edits move a letter by as many places at most, so a passage lies within this part.
    named = known.select(F.col("item_id").alias("of_item"), "item")
    edits = F.floor(most_edits * F.length("item"))
    begin = F.greatest(F.lit(0), F.col("step") * STEP - edits)
    end = F.col("step") * STEP + STEP + F.length("item") + edits
    candidates = (
        pairs.distinct()
        .join(regions.drop("hashes", "places"), "at")
        .join(named, F.col("item_id").eqNullSafe(F.col("of_item")))
        .select("doc_id", "item_id", F.substring("region", begin.cast("int") + 1, (end - begin).cast("int")).alias("part"), "item")
    )
    return (
        mapped(candidates, verify, "item_id string, distance long, length long")
        .unionByName(find_verbatim(docs, items, id_col, text_col))
        .groupBy("doc_id", "item_id")
        .agg(
            F.min("distance").alias("distance"),
            F.max(1 - F.col("distance") / F.col("length")).alias("similarity"),
        )
        .withColumn("item_id", F.col("item_id").cast(items.schema["item_id"].dataType))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    return only(docs, find_passages(docs, items).select("doc_id").distinct(), "left_anti")


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op7_decontaminate": op7_decontaminate}
SQL: dict[str, str] = {}
