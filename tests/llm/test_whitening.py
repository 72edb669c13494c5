"""Rank-one updates, spectra and whitened vectors against numpy's eigendecomposition."""

import numpy as np
import pytest

from shelfmark.llm import whitening
from shelfmark.llm.whitening import Spectrum

SMALL = "/root/testdata/sf0.01"
ROWS = "vec_id long, embedding array<float>, n int, component string, whitened int, values int, label int"


def matrix(s: Spectrum) -> np.ndarray:
    return (s.vectors * s.values) @ s.vectors.T


@pytest.mark.parametrize("kind", ["spread", "equal", "clusters", "zeros"])
def test_rank_one_updates(kind):
    rng = np.random.default_rng(5)
    d = {
        "spread": np.sort(rng.random(20) * 100), "equal": np.full(20, 3.0),
        "clusters": np.sort(np.repeat(rng.random(5), 4) + rng.random(20) * 1e-15), "zeros": np.zeros(20),
    }[kind]
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    s = Spectrum(1, np.zeros(20, np.int64), d, q)
    want = matrix(s)
    for step in range(200):
        v = rng.normal(size=20) * 10.0 ** rng.integers(-6, 4)
        if step % 3 == 0:
            v[rng.random(20) < 0.7] = 0
        if step % 7 == 0:
            v = s.vectors[:, step % 20].copy()  # an eigenvector: all else is deflated
        weight = float(rng.random() * 3)
        want = want + weight * np.outer(v, v)
        s.rank_one(weight, v)
        assert (np.diff(s.values) >= 0).all()
    scale = np.abs(want).max()
    assert np.abs(matrix(s) - want).max() < 1e-12 * scale
    assert np.abs(s.vectors.T @ s.vectors - np.eye(20)).max() < 1e-12
    assert np.abs(s.values - np.linalg.eigvalsh(want)).max() < 1e-12 * scale


def test_spectra_of_parts_are_that_of_all():
    rng = np.random.default_rng(6)
    x = rng.integers(-60, 60, size=(300, 12))
    x[:, 3] = 7  # no variance
    x[100:200] = x[5]
    parts = [Spectrum.empty(12) for _ in range(4)]
    for part, rows in zip(parts, np.split(x, [1, 120, 200])):
        for v, c in zip(*np.unique(rows, axis=0, return_counts=True)):
            part.add(v, int(c))
    whole = Spectrum.empty(12)
    for part in [Spectrum.empty(12), *parts]:
        whole.merge(part)
    centred = x - x.mean(0)
    assert (whole.n, whole.sums.tolist()) == (300, x.sum(0).tolist())
    assert np.abs(matrix(whole) - centred.T @ centred).max() < 1e-9 * np.abs(whole.values).max()


def plain(vectors, components=32):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    deviation = [sum(int(n * a - b) ** 2 for a, b in zip(row.tolist(), sums.tolist())) for row in x]
    centred = (n * x - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    keep = (e > len(e) * 2.3e-16 * e[0])[:components]
    k = len(keep)
    return n, deviation, (centred @ v[:, :k][:, keep]) / np.sqrt(e[:k][keep]), (e / e.sum())[:k][keep]


def assert_whitened(rows, ids, vectors):
    n, deviation, want, explained = plain(vectors)
    by = {}
    for r in rows:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by) == list(range(1, want.shape[1] + 1))
    for c, found in by.items():
        assert len(found) == len(ids)
        got = np.array([found[i]["whitened"] for i in ids])
        same = want[:, c - 1] * np.sign(got @ want[:, c - 1])
        assert np.abs(got - same).max() < 1e-7
        assert abs(found[ids[0]]["explained"] / explained[c - 1] - 1) < 1e-10
        assert all((found[i]["n"], found[i]["deviation"]) == (n, d) for i, d in zip(ids, deviation))
        assert found[ids[0]]["identity_error"] < 1e-8


def test_query_on_the_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = whitening.op12_whitening(spark, SMALL).collect()
    kept = [r for r in table if r["embedding"] is not None and np.isfinite(np.array(r["embedding"], float)).all()]
    assert_whitened(rows, [r["vec_id"] for r in kept], [r["embedding"] for r in kept])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(7)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    good += [(100 + i, good[3][1]) for i in range(200)]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] + [0.0] * 4),
           (904, []), (905, [1.0, 2.0]), (906, [1.0] * 9)]
    df = spark.createDataFrame([(i, v, 1, "c", 1, 1, 0) for i, v in good + bad], ROWS).repartition(7)
    assert_whitened(whitening.whiten(df).collect(), [i for i, _ in good], np.float32([v for _, v in good]))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [0.5]), (2, [0.5])], [(1, [])]])
def test_without_variance(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "c", 1, 1, 0) for i, v in rows], ROWS)
    assert whitening.whiten(df).collect() == []


def test_one_dimension_and_large_entries(spark):
    rows = [(1, [0.0]), (2, [1.0]), (3, [1e30]), (None, [2.0])]
    df = spark.createDataFrame([(i, v, 1, "c", 1, 1, 0) for i, v in rows], ROWS)
    found = {r["vec_id"]: r for r in whitening.whiten(df).collect()}
    assert set(found) == {1, 2, 3, None}
    assert abs(sum(r["whitened"] ** 2 for r in found.values()) / 4 - 1) < 1e-9
