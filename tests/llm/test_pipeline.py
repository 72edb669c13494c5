"""The pipeline against its operators, and the registered queries against their SQL."""

import random
import re

import corpus_pipeline
import numpy as np
import pytest
from compare import compare, connect

from shelfmark.llm import bpe, decontaminate, near_copies, quality, registry
from shelfmark.llm.common import documents

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, name):
    assert compare(spark, connect(SMALL), SMALL, registry.QUERIES[name], registry.SQL[name]) == []


def word_runs(text):
    """Sets of five words in a row; a shorter text is one run."""
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_run(spark):
    docs = {r.doc_id: r for r in documents(spark, SMALL).collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    score = {r.doc_id: r.score for r in quality.score_quality(documents(spark, SMALL), labels).collect()}
    kept = {i for i in docs if score[i] >= quality.CUT}
    last = {}
    for i in sorted(kept):
        last[docs[i].text] = i
    kept = set(last.values())
    runs = {i: word_runs(docs[i].text) for i in kept}
    root = {i: i for i in kept}

    def least(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in kept:
        for j in kept:
            if i < j and len(runs[i] & runs[j]) >= 0.8 * len(runs[i] | runs[j]):
                a, b = sorted((least(i), least(j)))
                root[b] = a
    kept = {i for i in kept if least(i) == i}
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {i for i in kept if any(t in decontaminate.normal(docs[i].text or "") for t in items)}
    got = {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == kept - held
    assert len(corpus_pipeline.STAGES) == 5 and bpe.QUERIES


def test_stages_keep_columns(spark):
    docs = documents(spark, SMALL)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == documents(spark, SMALL).columns


def test_stages_take_empty_tables(spark):
    docs = documents(spark, SMALL).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_near_copies_come_from_trees_of_fingerprints(spark):
    """Fingerprints by counting bits, and sets that share a key where a chain of at most two bits leads."""
    rng = random.Random(7)
    rows = []
    for n in range(60):
        start = [rng.getrandbits(63) for _ in range(near_copies.FINGERPRINTS)]
        rows.append((f"a{n}", n, start))
        rows.append((f"b{n}", 100 + n, [rng.getrandbits(63) for _ in start[1:]] + [start[-1] ^ 0b101]))
        rows.append((f"c{n}", 200 + n, [rng.getrandbits(63) for _ in start[1:]] + [start[-1] ^ 0b101_0101]))
        rows.append((f"d{n}", 300 + n, [f ^ 0b111 << 40 for f in start]))
    classes = spark.createDataFrame(rows, "digest string, least long, fps array<long>")
    together = {}
    for r in near_copies.tree_keys(classes).collect():
        together.setdefault(r.key, set()).add(r.digest)
    assert {frozenset(g) for g in together.values() if len(g) > 1} == {
        frozenset({f"a{n}", f"b{n}", f"c{n}"}) for n in range(60)
    }
    hashes = near_copies.shingles("one two three four five six seven")
    got = near_copies.fingerprints_of(hashes).view(np.uint64)
    for salt, fp in zip(near_copies._SALTS.tolist(), got.tolist(), strict=True):
        mixed = [h ^ salt for h in hashes.tolist()]
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            mixed = [(h ^ h >> 33) * factor % 2**64 for h in mixed]
        mixed = [h ^ h >> 33 for h in mixed]
        assert fp == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in mixed) > len(mixed))
