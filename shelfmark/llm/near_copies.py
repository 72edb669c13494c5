"""Near copies by their shingles: word runs that two texts share, as Jaccard similarity.

A text is the set of its shingles' hashes, and has ``FINGERPRINTS`` independent SimHash fingerprints
of them. Vantage-point trees (``simhash.near_links``) find the fingerprints that lie within two bits of
each other; sets whose fingerprints are linked are candidates. So are sets with one of ``BANDS`` keys of
``BAND`` min-hashes in common, since sets of similarity 0.8 differ in about ten of 64 bits, a radius at
which no tree leaves anything out: by keys two such sets miss each other with a probability of 0.003.
Both only choose candidates: links are made where the similarity of the whole sets, computed exactly,
reaches the bound.

Sets are known by a digest, so that texts with equal shingles take part once. They are made anew for
candidates only, never written for all. Keys that hold the same sets count once. A key's sets are
linked breadth first, each found set is left out of what is compared next, so that a large group of
near copies takes few comparisons and gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import mapped, narrow, only, written
from shelfmark.llm.components import components
from shelfmark.llm.simhash import near_links

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
BANDS = 25
BAND = 7
FINGERPRINTS = 4
SEED = 42
#: Shingles that are min-hashed together.
AT_ONCE = 4096

_random = np.random.default_rng(SEED)
_ODD = _random.integers(0, 2**63, BANDS * BAND, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _random.integers(0, 2**63, BANDS * BAND, np.uint64)
_SALTS = _random.integers(0, 2**63, FINGERPRINTS, np.uint64)


def shingles(text: str, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word runs; a shorter text is one run, one without words none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    a, b = starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    return np.unique(np.array([digest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)], np.uint64))


def digest_of(hashes: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(hashes.tobytes())


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band, from the upper halves of multiplied hashes; none without hashes."""
    if not hashes.size:
        return np.zeros(0, np.int64)
    least = np.full(BANDS * BAND, 2**64 - 1, np.uint64)
    for k in range(0, hashes.size, AT_ONCE):
        some = hashes[None, k : k + AT_ONCE] * _ODD[:, None]
        some += _PLUS[:, None]
        np.minimum(least, some.min(1), out=least)
    rows = np.ascontiguousarray(least.reshape(BANDS, BAND))
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), n) for n, r in enumerate(rows)], np.uint64).view(np.int64)


def fingerprints_of(hashes: np.ndarray) -> np.ndarray:
    """SimHash fingerprints of a set: a bit is set where over half of the salted hashes have it."""
    made = []
    for salt in _SALTS:
        mixed = hashes ^ salt
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(33)
        counts = np.zeros(64, np.int64)
        for k in range(0, mixed.size, 100_000):
            some = mixed[k : k + 100_000].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
        made.append(np.packbits(counts * 2 > hashes.size, bitorder="little").view(np.int64)[0])
    return np.array(made, np.int64)


def tree_keys(classes: DataFrame) -> DataFrame:
    """Keys that sets share where trees link their fingerprints: digest, least, key.

    ``classes`` has digest, least and fps, the fingerprints of a set in the order of their salts.
    """
    held = classes.select("digest", "least", F.posexplode("fps").alias("salt", "fp"))
    total = classes.count()

    def node(column: str) -> Column:
        return F.concat_ws(":", F.col("salt").cast("string"), F.col(column).cast("string"))

    links = None
    for salt in range(FINGERPRINTS):
        found = near_links(held.where(F.col("salt") == salt).select("fp").distinct(), total)
        found = found.withColumn("salt", F.lit(salt)).select(node("u").alias("u"), node("v").alias("v"))
        links = found if links is None else links.unionByName(found)
    roots = components(links).select(F.col("u").alias("node"), F.col("v").alias("root"))
    named = held.withColumn("node", node("fp")).join(roots, "node", "left")
    return named.select("digest", "least", F.xxhash64(F.coalesce("root", "node")).alias("key"))


def similar_links(sets: list[np.ndarray], least_similarity: float = LEAST_SIMILARITY) -> list[tuple[int, int]]:
    """Links that span the components of sets with at least that Jaccard similarity, breadth first."""
    sizes = np.array([s.size for s in sets], np.int64)
    names, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(names.size, bool)
    left = np.ones(len(sets), bool)
    of, rest = np.repeat(np.arange(len(sets)), sizes), codes
    links: list[tuple[int, int]] = []
    queue: list[int] = []
    while left.any():
        if not queue:
            queue.append(int(left.argmax()))
            left[queue[0]] = False
        if 2 * int(sizes[left].sum()) < rest.size:
            stay = left[of]
            of, rest = of[stay], rest[stay]
        point = queue.pop()
        own = codes[starts[point] : starts[point + 1]]
        marked[own] = True
        shared = np.bincount(of[marked[rest]], minlength=len(sets))
        marked[own] = False
        close = left & (shared >= least_similarity * (sizes + sizes[point] - shared) - 1e-9)
        found = np.flatnonzero(close).tolist()
        left[found] = False
        links += [(point, f) for f in found]
        queue += found
    return links


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    least_similarity: float = LEAST_SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest of its shingles, component_id.

    The component of a document is the smallest id that links lead to, its own included. Null and
    empty texts, and those of white space, have no shingles and are copies of each other. Null ids
    take part, but a component of null ids only has a null id. An empty table gives no rows.
    """

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                hashes = shingles(text, shingle_words)
                rows.append((doc_id, digest_of(hashes), band_keys(hashes), fingerprints_of(hashes)))
            yield pd.DataFrame(rows, columns=["doc_id", "digest", "keys", "fps"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text, shingle_words) for text in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "digest": [digest_of(s) for s in sets],
                "hashes": [s.tobytes() for s in sets],
            })

    def search(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values("digest", ignore_index=True)
        found = similar_links([np.frombuffer(h, np.uint64) for h in bucket["hashes"]], least_similarity)
        at = np.array(found, np.int64).reshape(-1, 2)
        names = bucket["digest"].to_numpy()
        return pd.DataFrame({"u": names[at[:, 0]], "v": names[at[:, 1]]})

    marked = written(mapped(narrow(docs, id_col, text_col), mark, "digest string, keys array<long>, fps array<long>"), "shingled")
    classes = marked.groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.first("keys").alias("keys"), F.first("fps").alias("fps")
    )
    classes = written(classes, "classes")
    keyed = classes.select("digest", "least", F.explode("keys").alias("key"))
    keyed = written(keyed.unionByName(tree_keys(classes)), "keyed")
    held = keyed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("digest")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("two"),
    )
    chosen = held.where("n > 1").groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key")
    members = written(keyed.join(chosen, "key"), "candidates")
    wanted = members.select(F.col("least").alias("doc_id")).distinct()
    sets = mapped(only(narrow(docs, id_col, text_col), wanted), gather, "digest string, hashes binary")
    sets = written(sets.dropDuplicates(["digest"]).drop("doc_id"), "sets")
    links = members.select("key", "digest").join(sets, "digest").groupBy("key").applyInPandas(search, "u string, v string")
    roots = components(links)
    rooted = classes.join(roots.select(F.col("u").alias("digest"), F.col("v").alias("root")), "digest", "left")
    rooted = rooted.select("digest", "least", F.coalesce("root", "digest").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.join(named, "root").select("digest", "component_id")
    return marked.join(by_class, "digest").select("doc_id", "digest", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that are linked to a smaller id, with all their columns."""
    return only(docs, near_groups(docs).where("doc_id <> component_id"), "left_anti")
