"""SimHash near-duplicates, found through vantage-point trees.

Each whole text becomes a 64-bit fingerprint. Distinct fingerprints are dealt to shards by a tree:
a node has a vantage point and a radius, fingerprints within the radius go inside, the others
outside. By the triangle inequality a pair that the radius separates has its inner member within
``MOST_BITS`` of the radius, so exactly these boundary fingerprints go outside as well, and every
close pair meets in some shard. The upper tree is fitted on a bounded sample of fingerprints; it
only shapes the shards, no result depends on it. Each shard splits on by the same rule until a few
hundred fingerprints are compared with each other.

A shard returns a spanning forest of its links, never all pairs, and components of those links are
found by joins. Copies share a fingerprint and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, mapped, narrow, written
from shelfmark.llm.components import components

SHINGLE_WORDS = 3
MOST_BITS = 2
SEED = 42
#: Fingerprints the upper tree is fitted on; its leaves hold about ``SHARD`` fingerprints, or what
#: ``LEAST_SAMPLE`` sampled ones stand for.
SAMPLE = 20_000
SHARD = 20_000
LEAST_SAMPLE = 24
#: Below this many, all pairs are compared.
LEAF = 256


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """A bit is set where over half of the shingles' hashes have it; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(words) - span + 1
    for k in range(0, n, 100_000):
        a, b = starts[k : min(k + 100_000, n)].tolist(), ends[k + span - 1 : k + span + 99_999].tolist()
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b, strict=False)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its 64-bit fingerprint as a signed long, one row per row of ``docs``."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch["text"].tolist()], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": found.view(np.int64)})

    return mapped(narrow(docs, id_col, text_col), work, "fp long")


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave the fewest pairs to compare; None if none helps."""
    best, chosen = 0.8 * float(len(points)) ** 2, None
    tried = points[np.linspace(0, len(points) - 1, 5).astype(np.int64)]
    for vantage in tried:
        at = np.bincount(np.bitwise_count(points ^ vantage), minlength=65).astype(float)
        inside = np.cumsum(at)
        near = np.convolve(at, np.ones(MOST_BITS))[:65]
        cost = inside**2 + (len(points) - inside + near) ** 2
        radius = int(cost.argmin())
        if cost[radius] < best:
            best, chosen = float(cost[radius]), (vantage, radius)
    return chosen


def _sides(points: np.ndarray, vantage: np.uint64, radius: int) -> tuple[np.ndarray, np.ndarray]:
    away = np.bitwise_count(points ^ vantage).astype(np.int16)
    return away <= radius, away > radius - MOST_BITS


@dataclass
class Node:
    """An inner node of the upper tree, or a shard."""

    shard: int = -1
    vantage: int = 0
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None

    def deal(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        if self.shard >= 0:
            yield self.shard, points
        elif points.size:
            inside, outside = _sides(points, np.uint64(self.vantage), self.radius)
            yield from self.inside.deal(points[inside])
            yield from self.outside.deal(points[outside])


def plant(sample: np.ndarray, total: int, shard: int = SHARD, least: int = LEAST_SAMPLE) -> Node:
    """The upper tree for ``total`` fingerprints of which ``sample`` is a part."""
    stands_for = total / max(1, len(sample))
    count = 0

    def grow(points: np.ndarray) -> Node:
        nonlocal count
        split = None
        if len(points) > least and len(points) * stands_for > shard:
            split = _split(points)
        if split is None:
            count += 1
            return Node(shard=count - 1)
        inside, outside = _sides(points, *split)
        return Node(-1, int(split[0]), split[1], grow(points[inside]), grow(points[outside]))

    return grow(sample)


def _forest(points: np.ndarray) -> list[tuple[int, int]]:
    """Links that span each component of the points, breadth first."""
    links, left = [], points
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            point = queue.pop()
            close = np.bitwise_count(left ^ point) <= MOST_BITS
            if close.any():
                found, left = left[close], left[~close]
                links += [(int(point), int(f)) for f in found]
                queue += list(found)
    return links


def _probed(points: np.ndarray) -> list[tuple[int, int]]:
    """Links of points too close to split and too many to compare, by looking up their neighbours."""
    points, links = np.sort(points), []
    bits = [np.uint64(1) << np.uint64(b) for b in range(64)]
    for count in range(1, MOST_BITS + 1):
        for chosen in combinations(bits, count):
            other = points ^ np.bitwise_or.reduce(np.array(chosen, np.uint64))
            at = np.searchsorted(points, other)
            there = (other < points) & (points[np.minimum(at, len(points) - 1)] == other)
            links += zip(points[there].tolist(), other[there].tolist(), strict=True)
    return links


def close_links(points: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is within MOST_BITS among distinct points."""
    if len(points) <= LEAF:
        near = (np.bitwise_count(points[:, None] ^ points[None, :]) <= MOST_BITS).sum(1) > 1
        return _forest(points[near]) if near.any() else []
    split = _split(points)
    if split is None:
        return _forest(points) if len(points) < 100_000 else _probed(points)
    inside, outside = _sides(points, *split)
    return close_links(points[inside]) + close_links(points[outside])


def near_links(distinct: DataFrame, total: int) -> DataFrame:
    """Links u, v that connect fingerprints within MOST_BITS; ``distinct`` has one column, fp."""
    sampled = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(np.int64)
    tree = plant(sampled.view(np.uint64), total)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, points in tree.deal(batch["fp"].to_numpy(np.int64).view(np.uint64)):
                yield pd.DataFrame({"shard": np.int32(shard), "fp": points.view(np.int64)})

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        points = np.unique(shard["fp"].to_numpy(np.int64)).view(np.uint64)
        found = np.array(close_links(points), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    return (
        distinct.mapInPandas(deal, "shard int, fp long")
        .groupBy("shard")
        .applyInPandas(search, "u long, v long")
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id.

    The component of a document is the smallest id that links lead to, its own included. Null and
    empty texts, and those of white space, have fingerprint zero and link like any other. Null ids
    take part, but a component of null ids only has a null id. Repeated rows get equal rows; an
    empty table gives none.
    """
    marked = written(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(near_links(classes.select("fp"), classes.count()))
    rooted = classes.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(by_class, "fp").select("doc_id", "fp", "component_id")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


QUERIES = {"op10_simhash": op10_simhash}
SQL: dict[str, str] = {}
