"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the eigenvalues and eigenvectors of the scatter of the vectors it has seen. A further vector changes
the scatter by one centred rank-one term; the new eigenvalues are the roots of a secular equation, those untouched by the
term being deflated. The spectra of partitions are combined in a tree: to add a spectrum is to apply its eigenpairs, and
the difference of the two means, as successive rank-one terms. A last pass over the data projects its covariance on the
basis found (Rayleigh-Ritz), which takes away what rounding has left, and gives the components.

Vectors are made integers first, so sums and deviations are exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.session import materialise

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Partial results that one task combines.
FAN = 16
EPS = np.finfo(np.float64).eps
#: A component whose share of the largest eigenvalue is below this is of no direction in the data.
LEAST_SHARE = 1e-12
#: Safeguarded steps towards a root; a handful suffice.
STEPS = 80


def roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum(z2 / (d - x))`` for ascending, different ``d``: for each its nearest pole's number and its
    distance from that pole. The root after ``d[i]`` is below ``d[i + 1]``, the last one below ``d[-1] + sum(z2)``.

    Steps fit the function by the two poles around the root, and halve the bracket where they would leave it.
    """
    k = len(d)
    here = np.arange(k)
    upper = np.append(d[1:], d[-1] + z2.sum())
    half = (upper - d) / 2
    middle = 1 + (z2 / ((d[None, :] - d[:, None]) - half[:, None])).sum(axis=1)
    right = (middle < 0) & (here < k - 1)
    origin = np.where(right, here + 1, here)
    gaps = d[None, :] - d[origin][:, None]
    next_gap = upper - d[origin]
    lo = np.where(right, -half, np.where(middle < 0, half, 0.0))
    hi = np.where(right, 0.0, np.where(middle < 0, 2 * half, half))
    x = (lo + hi) / 2
    below = here[None, :] <= here[:, None]
    for _ in range(STEPS):
        apart = gaps - x[:, None]
        share = z2 / apart
        f = 1 + share.sum(axis=1)
        slope = share / apart
        lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
        done = (np.abs(f) <= EPS * k * (1 + np.abs(share).sum(axis=1))) | (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        left_slope = np.where(below, slope, 0).sum(axis=1)
        all_slope = slope.sum(axis=1)
        near, far = apart[here, here], next_gap - x
        a = (near + far) * f - near * far * all_slope
        b = near * far * f
        c = f - near * left_slope - far * (all_slope - left_slope)
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = x + step
        fits = np.isfinite(moved) & (moved > lo) & (moved < hi)
        x = np.where(done, x, np.where(fits, moved, (lo + hi) / 2))
    return origin, x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors of the matrix of ``values`` and ``basis`` plus ``weight`` times the outer
    product of ``vector`` with itself."""
    z = basis.T @ vector
    size = float(np.abs(values).max(initial=0) + weight * (z @ z))
    tiny = 8 * EPS * size
    active = np.flatnonzero(weight * np.abs(z) * np.sqrt(z @ z) > tiny)
    if not len(active):
        return values, basis
    values, basis = values.copy(), basis.copy()
    if (np.diff(values[active]) <= tiny).any():
        kept = []
        for j in active.tolist():
            if kept and values[j] - values[kept[-1]] <= tiny:
                i = kept.pop()  # turn the plane of two equal values until one vector is out of the term's reach
                length = np.hypot(z[i], z[j])
                c, s = z[j] / length, z[i] / length
                basis[:, i], basis[:, j] = c * basis[:, i] - s * basis[:, j], s * basis[:, i] + c * basis[:, j]
                z[i], z[j] = 0.0, length
            kept.append(j)
        active = np.array(kept)
    d, part = values[active], z[active]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        origin, x = roots(d, weight * part * part)
        apart = (d[None, :] - d[origin][:, None]) - x[:, None]  # d[j] - root[i], without cancellation
        # the term for which these roots are exact; its vectors are orthogonal however close the roots are
        between = d[None, :] - d[:, None]
        np.fill_diagonal(between, 1.0)
        z_exact = np.sqrt(np.abs(np.prod(apart / between, axis=0))) * np.sign(part)
        turn = z_exact[None, :] / apart
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values[active] = d[origin] + x
    basis[:, active] = basis[:, active] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Count, exact sums and mean of vectors, and the eigenpairs of their scatter."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width, np.int64), np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, row: np.ndarray) -> None:
        gap = row - OFFSET - self.mean
        if self.n and gap.any():
            self.values, self.basis = rank_one(self.values, self.basis, gap, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + gap / self.n
        self.sums = self.sums + row

    def join(self, other: Spectrum) -> None:
        if not other.n or not self.n:
            if other.n:
                self.__dict__.update(other.__dict__)
            return
        gap, n = other.mean - self.mean, self.n + other.n
        for value, column in zip(other.values.tolist(), other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, column, value)
        if gap.any():
            self.values, self.basis = rank_one(self.values, self.basis, gap, self.n * other.n / n)
        self.mean, self.n, self.sums = self.mean + gap * (other.n / n), n, self.sums + other.sums
        self.basis, turn = np.linalg.qr(self.basis)  # as good as orthogonal before; signs are free
        self.basis = self.basis * np.where(np.diag(turn) < 0, -1, 1)


def integers(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """``floor(64 * c) + 1000000`` of each entry; entries that a vector lacks at its end count as 0."""
    lists = batch.column(1)
    sizes = np.diff(lists.offsets.to_numpy())
    entries = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = entries
    return np.clip(np.floor(SCALE * out), -(2.0**62), 2.0**62).astype(np.int64) + OFFSET


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows whose vector is there and has finite entries only."""
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("v").isNotNull() & ~bad)


def combined(rows: DataFrame, per_partition: Callable[[Iterator[np.ndarray]], object], join: Callable[[object, object], object], width: int):
    """What ``per_partition`` makes of each partition's rows, combined by ``join``, ``FAN`` at a time over many tasks."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = per_partition(integers(batch, width) for batch in batches if batch.num_rows)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["part"])

    def merge(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        total = None
        for part in table.column("part").to_pylist():
            found = pickle.loads(part)
            total = found if total is None else join(total, found)
        return pa.table({"part": pa.array([pickle.dumps(total)], pa.binary()), "place": pa.array([key[0].as_py()], pa.int64())})

    parts = rows.mapInArrow(first, "part binary").withColumn("place", F.spark_partition_id().cast("long"))
    while True:
        parts = materialise(parts, "spectra")
        if parts.count() <= 1:
            break
        group = F.floor(F.col("place") / FAN).alias("group")
        parts = parts.groupBy(group).applyInArrow(merge, "part binary, place long")
    row = parts.first()
    return pickle.loads(row.part) if row else None


def spectrum(rows: DataFrame, width: int) -> Spectrum | None:
    """The eigenpairs of the scatter of all rows."""

    def run(blocks: Iterator[np.ndarray]) -> Spectrum | None:
        own = Spectrum.empty(width)
        for block in blocks:
            for row in block:
                own.add(row)
        return own if own.n else None

    def join(a: Spectrum, b: Spectrum) -> Spectrum:
        a.join(b)
        return a

    return combined(rows, run, join, width)


def projected(rows: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Covariance and mean of the centred rows projected on the columns of ``basis``."""

    def run(blocks: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
        square, total, any_rows = np.zeros((basis.shape[1],) * 2), np.zeros(basis.shape[1]), False
        for block in blocks:
            y = ((n * block - sums) / n) @ basis
            square, total, any_rows = square + y.T @ y, total + y.sum(axis=0), True
        return (square, total) if any_rows else None

    square, total = combined(rows, run, lambda a, b: (a[0] + b[0], a[1] + b[1]), len(sums))
    return square / n - np.outer(total, total) / n**2, total / n


@dataclass
class Whitening:
    """Fitted to ``n`` integer vectors with the given sums: unit eigenvectors as columns, eigenvalues, their shares of the
    whole variance, and how far the covariance of the whitened vectors is from the identity."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows; None if there are none."""
    rows = usable(vectors, id_col, vector_col)
    width = rows.agg(F.max(F.size("v"))).first()[0]
    found = spectrum(rows, width) if width else None
    if not found:
        return None
    n, sums = found.n, found.sums
    covariance, _ = projected(rows, n, sums, found.basis)
    values, turn = np.linalg.eigh(covariance)
    values, basis = values[::-1], found.basis @ turn[:, ::-1]
    basis *= np.where(basis[np.abs(basis).argmax(axis=0), np.arange(width)] < 0, -1, 1)
    kept = min(components, int((values > LEAST_SHARE * values[0]).sum())) if values[0] > 0 else 0
    basis, error = basis[:, :kept], 0.0
    if kept:
        covariance, _ = projected(rows, n, sums, basis / np.sqrt(values[:kept]))
        error = float(np.abs(covariance - np.eye(kept)).max())
    return Whitening(n, sums, basis, values[:kept], values[:kept] / max(values.sum(), 1e-300), error)


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): for each usable row one row for each of the
    first ``components`` components.

    Rows whose vector is null or has a null or non-finite entry are dropped. Repeated rows count each time, a null id is
    kept, equal eigenvalues come in any order. Entries that a vector lacks at its end count as 0. A direction in which
    the data do not vary cannot be whitened and is no component, so equal vectors, one vector or none give no rows.
    ``deviation`` is exact as long as it fits a long. Only the id and vector columns are read.
    """
    model = fit(vectors, components, id_col, vector_col)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    k, names = len(model.values), [c.split(" ")[0] for c in SCHEMA.split(", ")]
    scaled = model.components / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = model.n * integers(batch, len(model.sums)) - model.sums
            m = len(centred)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(np.repeat((centred * centred).sum(axis=1), k)),
                pa.array(((centred / model.n) @ scaled).reshape(-1)),
                pa.array(np.tile(model.explained, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return usable(vectors, id_col, vector_col).mapInArrow(run, SCHEMA)
