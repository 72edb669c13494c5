"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps the eigenvalues and eigenvectors of the scatter matrix of the vectors it has
seen, and applies each vector as a centred rank-one update: the new eigenvalues are the roots of a
secular equation, found between the old ones, after entries that change nothing and equal
eigenvalues are deflated. Two spectra are combined by the rank-one updates of one's eigenpairs and of
the distance of their means, in a tree of groups of a few spectra. In the end one pass over all
vectors projects them on the basis found (Rayleigh-Ritz): the eigenvectors of the small projected
covariance correct what rounding has left, and a last pass measures the covariance of the result.

A spectrum has dimension x dimension doubles, 32 kB for 64 dimensions; spectra, the projected
covariance and the basis are all that reaches the driver or one task, however many vectors there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import written

#: x = floor(SCALE * c) + SHIFT; the shift only moves the mean, so sums are kept without it.
SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this are taken as this.
LARGEST = 2.0**31
#: Components of the result, spectra merged by one task of a level of the tree.
COMPONENTS, MERGED = 32, 8
EPS = float(np.finfo(float).eps)
STATE = "part long, n long, sums binary, eigenvalues binary, eigenvectors binary"


def _between(a, b, c, low, high):
    """The root of a t^2 - b t + c from low to high (0, a pole, is none), else their middle."""
    half = np.sqrt(np.maximum(b * b - 4 * a * c, 0)) * np.where(b < 0, -1, 1) + b
    with np.errstate(divide="ignore", invalid="ignore"):
        near, far = 2 * c / half, half / (2 * a)
    inside = (low + high) / 2
    for root in (far, near):
        inside = np.where((root >= low) & (root <= high) & (root != 0), root, inside)
    return inside


def secular_roots(d: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """d[i] - root[j] for the roots of 1 + sum_i weights[i] / (d[i] - x), each to full precision.

    ``d`` rises strictly and weights are positive, so one root lies above each d and below the next.
    It is sought as a distance from the nearer of the two, by rational interpolation with both poles
    inside a bracket that shrinks at every step.
    """
    k = len(d)
    gap = np.append(np.diff(d), weights.sum())
    apart = d[:, None] - d[None, :]
    w = weights[:, None]
    at_middle = 1 + (w / (apart - gap / 2)).sum(0)
    right = at_middle < 0
    right[-1] = False
    delta = np.where(right, d[:, None] - np.append(d[1:], d[-1]), apart)
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(at_middle < 0, gap, gap / 2))
    pole_left, pole_right = np.where(right, -gap, 0.0), np.where(right, 0.0, gap)
    left = np.arange(k)[:, None] <= np.arange(k)
    root = (low + high) / 2
    found = np.zeros(k, bool)
    for _ in range(60):
        distance = delta - root
        terms = w / distance
        slopes = terms / distance
        psi, phi = (terms * left).sum(0), (terms * ~left).sum(0)
        value = 1 + psi + phi
        found |= np.abs(value) <= 16 * EPS * (1 + np.abs(psi) + np.abs(phi))
        if found.all():
            break
        low, high = np.where(value < 0, root, low), np.where(value < 0, high, root)
        # psi is replaced by r + s / (left pole - t), phi likewise, equal here in value and slope.
        s, t = (slopes * left).sum(0), (slopes * ~left).sum(0)
        to_left, to_right = pole_left - root, pole_right - root
        a = value - s * to_left - t * to_right
        s, t = s * to_left**2, t * to_right**2
        b = a * (pole_left + pole_right) + s + t
        c = a * pole_left * pole_right + s * pole_right + t * pole_left
        root = np.where(found, root, _between(a, b, c, low, high))
    return delta - root


@dataclass
class Spectrum:
    """The scatter of some vectors: their number, exact sums, eigenvalues (rising) and eigenvectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimensions: int) -> Spectrum:
        return cls(0, np.zeros(dimensions, np.int64), np.zeros(dimensions), np.eye(dimensions))

    def rank_one(self, weight: float, vector: np.ndarray) -> None:
        """Adds weight * vector * vector' to the matrix."""
        d, q = self.values, self.vectors
        z = vector @ q
        size = math.sqrt(z @ z)
        if not weight * size:
            return
        least = 8 * EPS * max(abs(d[-1]), abs(d[0]), weight * size * size)
        # Eigenvectors of equal values may be turned: all of z falls to the last of them.
        close = np.append(np.diff(d) <= least, False)
        if close.any():
            ends = np.flatnonzero(~close)
            begins = np.append(0, ends[:-1] + 1)
            for a, b in zip(begins.tolist(), (ends + 1).tolist(), strict=True):
                part = z[a:b]
                if b - a == 1 or not part[:-1].any():
                    continue
                length = math.copysign(math.sqrt(part @ part), -part[-1] or 1)
                mirror = part.copy()
                mirror[-1] -= length
                q[:, a:b] -= np.outer(q[:, a:b] @ mirror, mirror) * (2 / (mirror @ mirror))
                part[:] = 0
                part[-1] = length
        live = np.flatnonzero(weight * np.abs(z) * size > least)
        if len(live) == 0:
            return
        old = d[live]
        apart = secular_roots(old, weight * z[live] ** 2)
        # The z for which these roots are exact, so that the new eigenvectors are orthogonal.
        between = old[None, :] - old[:, None]
        np.fill_diagonal(between, 1)
        exact = np.sqrt(np.abs((-apart / between).prod(1)))
        u = np.copysign(exact, z[live])[:, None] / apart
        u /= np.sqrt((u * u).sum(0))
        q[:, live] = q[:, live] @ u
        nearest = np.abs(apart).argmin(0)
        d[live] = old[nearest] - apart[nearest, np.arange(len(live))]
        order = d.argsort(kind="stable")
        self.values, self.vectors = d[order], q[:, order]

    def add(self, vector: np.ndarray, copies: int = 1) -> None:
        """Takes in a vector of whole numbers, so many times."""
        if self.n:
            centred = vector - self.sums / self.n
            self.rank_one(copies * self.n / (self.n + copies), centred)
        self.n += copies
        self.sums = self.sums + vector * copies

    def merge(self, other: Spectrum) -> None:
        """Takes in all vectors of another spectrum."""
        if self.n and other.n:
            for value, vector in zip(other.values, other.vectors.T, strict=True):
                if value > 0:
                    self.rank_one(float(value), vector)
            between = other.sums / other.n - self.sums / self.n
            self.rank_one(self.n * other.n / (self.n + other.n), between)
        elif other.n:
            self.values, self.vectors = other.values, other.vectors
        self.n += other.n
        self.sums = self.sums + other.sums

    def row(self, part: int) -> dict:
        return {
            "part": [part], "n": [self.n], "sums": [self.sums.tobytes()],
            "eigenvalues": [self.values.tobytes()], "eigenvectors": [self.vectors.tobytes()],
        }


def _spectrum(row) -> Spectrum:
    values = np.frombuffer(row.eigenvalues).copy()
    vectors = np.frombuffer(row.eigenvectors).reshape(len(values), -1).copy()
    return Spectrum(int(row.n), np.frombuffer(row.sums, np.int64), values, vectors)


def whole_numbers(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    """x - SHIFT of every vector of a batch, as rows."""
    entries = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    scaled = np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST)
    return scaled.astype(np.int64).reshape(-1, dimensions)


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the vectors that are finite throughout."""
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("vector").isNotNull() & finite)


@dataclass
class Whitening:
    """Mean and components of a fit: n vectors, sums and components by falling eigenvalue, as rows."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    components: np.ndarray
    identity_error: float = 0.0


def _summed(rows: DataFrame, work, size: int) -> np.ndarray:
    """The sum over all partitions of an array that ``work`` makes of each, as a flat array."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"cell": np.arange(size, dtype=np.int64), "value": total.ravel()})

    total = np.zeros(size)
    for cell, value in rows.mapInArrow(cells, "cell long, value double").groupBy("cell").agg(F.sum("value")).collect():
        total[cell] = value
    return total


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - mean: exact whole numbers, divided once."""
    return (n * x - sums) / n


def fit(rows: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all ``rows`` of ``usable``, vectors of so many dimensions."""

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum.empty(dimensions)
        for batch in batches:
            x = whole_numbers(batch, dimensions)
            if len(x):
                for vector, copies in zip(*np.unique(x, axis=0, return_counts=True), strict=True):
                    found.add(vector, int(copies))
        if found.n:
            yield pa.RecordBatch.from_pydict(found.row(TaskContext.get().partitionId()))

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        found = Spectrum.empty(dimensions)
        for row in group.itertuples():
            found.merge(_spectrum(row))
        return pd.DataFrame(found.row(int(group["part"].iloc[0])))

    states = written(rows.mapInArrow(spectra, STATE), "spectra")
    width = (states.agg(F.max("part")).head()[0] or 0) + 1
    while width > 1:
        placed = states.withColumn("place", F.col("part")).withColumn("part", F.floor(F.col("part") / MERGED))
        states = placed.groupBy("part").applyInPandas(merged, STATE)
        width = -(-width // MERGED)
    found = _spectrum(states.head())
    n, sums, basis = found.n, found.sums, found.vectors

    def projected(batch: pa.RecordBatch) -> np.ndarray:
        y = _centred(whole_numbers(batch, dimensions), n, sums) @ basis
        return y.T @ y

    small = _summed(rows, projected, dimensions**2).reshape(dimensions, -1) / n
    values, turned = np.linalg.eigh((small + small.T) / 2)
    values, turned = values[::-1], turned[:, ::-1]
    known = values > dimensions * EPS * max(values[0], 0)
    values, trace = values[known][:components], float(values.sum())
    axes = (basis @ turned[:, known][:, :components]).T
    # Of the two signs, the one whose largest entry is positive.
    axes *= np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(1)])[:, None]
    model = Whitening(n, sums, values, trace, axes)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w = np.column_stack([projection(batch, model), np.ones(batch.num_rows)])
        return w.T @ w

    if len(values):
        second = _summed(rows, moments, (len(values) + 1) ** 2).reshape(len(values) + 1, -1) / n
        mean = second[-1, :-1]
        model.identity_error = float(np.abs(second[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    return model


def projection(batch: pa.RecordBatch, model: Whitening) -> np.ndarray:
    x = whole_numbers(batch, len(model.sums))
    return _centred(x, model.n, model.sums) @ model.components.T / np.sqrt(model.eigenvalues)


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold a null, NaN or infinite entry are left out, as are vectors of
    another length than the most frequent one (of equally frequent lengths, the greatest). Scaled
    entries beyond 2^31 are taken as 2^31. Repeated rows count each; a null id stays a row. Components
    without variance are left out, so a single vector, or equal ones, give no rows, as does an empty
    table. A deviation that no long holds is null. Other columns are not looked at.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings, id_col, vector_col)
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if length is None or not length["d"]:
        return spark.createDataFrame([], schema)
    dimensions = length["d"]
    rows = rows.where(F.size("vector") == dimensions)
    model = fit(rows, dimensions, components)
    if not len(model.eigenvalues):
        return spark.createDataFrame([], schema)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = model.n * whole_numbers(batch, dimensions) - model.sums
            fits = (apart.astype(float) ** 2).sum(1) < 2.0**62
            deviation = pa.array(np.where(fits, (apart * apart).sum(1), 0), mask=~fits)
            whitened = projection(batch, model)
            ends = np.arange(0, whitened.size + 1, whitened.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), deviation, pa.ListArray.from_arrays(ends, whitened.ravel())],
                ["vec_id", "deviation", "values"],
            )

    found = rows.mapInArrow(project, "vec_id long, deviation long, values array<double>")
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    return found.select("vec_id", "deviation", F.posexplode("values").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("i")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op12_whitening": op12_whitening}
SQL: dict[str, str] = {}
