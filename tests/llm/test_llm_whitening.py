"""Whitening against numpy's own eigenvectors, and the parts of the incremental decomposition."""

import math

import numpy as np
import pytest

from inciscope.llm import whitening
from inciscope.llm.whitening import Spectrum

SCHEMA = "vec_id long, embedding array<float>"


def spectrum_of(rows):
    out = Spectrum.empty(rows.shape[1])
    for row in rows:
        out.add(row)
    return out


def scatter(rows):
    centred = rows - rows.mean(axis=0)
    return centred.T @ centred


def data(rng, n, width):
    rows = np.floor(20 * rng.normal(size=(n, width)) @ rng.normal(size=(width, width))).astype(np.int64)
    return rows + whitening.OFFSET


def assert_spectrum(found, rows):
    want, size = scatter(rows), max(np.abs(scatter(rows)).max(), 1)
    assert np.abs(found.values - np.linalg.eigvalsh(want)).max() < 1e-11 * size * len(want)
    assert np.abs(found.basis.T @ found.basis - np.eye(len(want))).max() < 1e-11
    assert np.abs(want @ found.basis - found.basis * found.values).max() < 1e-11 * size * len(want)
    assert found.n == len(rows) and (found.sums == rows.sum(axis=0)).all()


@pytest.mark.parametrize("width", [1, 2, 7, 24])
def test_spectrum_of_one_partition(width):
    rows = data(np.random.default_rng(width), 300, width)
    for n in (1, 2, width, 300):
        assert_spectrum(spectrum_of(rows[:n]), rows[:n])


def test_deflation():
    """Equal and constant columns, repeated rows, rows in one plane: the secular equation has double poles and zero terms."""
    rng = np.random.default_rng(5)
    rows = data(rng, 200, 9)
    rows[:, 3], rows[:, 5], rows[50:120] = rows[:, 2], whitening.OFFSET, rows[0]
    assert_spectrum(spectrum_of(rows), rows)
    plane = (data(rng, 60, 2) - whitening.OFFSET) @ rng.integers(-3, 4, size=(2, 9)) + whitening.OFFSET
    assert_spectrum(spectrum_of(plane), plane)
    cross = np.concatenate([np.eye(6, dtype=np.int64), -np.eye(6, dtype=np.int64)]) * 10 + whitening.OFFSET
    assert_spectrum(spectrum_of(cross), cross)


def test_roots_interlace():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        d = np.sort(rng.normal(size=k)) + np.arange(k) * 1e-3
        z2 = rng.random(k) ** 8 + 1e-12
        origin, x = whitening.roots(d, z2)
        found = np.sort(d[origin] + x)
        assert np.abs(found - np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))).max() < 1e-12
        assert (found >= d).all() and (found[:-1] <= d[1:]).all()


def test_spectra_join():
    rng = np.random.default_rng(3)
    rows = data(rng, 90, 8)
    rows[60:] += 50
    total = Spectrum.empty(8)
    for cut in np.split(rows, [1, 4, 40, 60]):
        total.join(spectrum_of(cut))
    total.join(Spectrum.empty(8))
    assert_spectrum(total, rows)
    assert np.abs(total.mean + whitening.OFFSET - rows.mean(axis=0)).max() < 1e-9


def found_rows(spark, rows, partitions=6):
    return whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(partitions)).collect()


@pytest.mark.parametrize("width", [3, 40])
def test_against_numpy(spark, width):
    rng = np.random.default_rng(width)
    vectors = (rng.normal(size=(400, width)) @ np.diag(np.linspace(1, 3, width))).astype(np.float32)
    vectors[7] = vectors[8]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    bad = [(900, None), (901, [math.nan] + [0.0] * (width - 1)), (902, [math.inf] * width), (903, [None] * width)]
    found = found_rows(spark, rows + bad)
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    covariance = scatter(x) / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(width, 32)
    assert len(found) == n * k and {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, k + 1))
    want = ((x - sums / n) @ basis / np.sqrt(values))[:, :k]
    got = np.empty_like(want)
    for r in found:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    got *= np.sign((got * want).sum(axis=0))
    assert np.abs(got - want).max() < 1e-8
    error = found[0].identity_error
    assert {r.identity_error for r in found} == {error} and error < 1e-9
    assert np.abs(got.T @ got / n - np.eye(k)).max() < 1e-9


def test_few_or_equal_vectors(spark):
    assert found_rows(spark, []) == [] == found_rows(spark, [(1, None)]) == found_rows(spark, [(1, [1.0, 2.0])])
    assert found_rows(spark, [(k, [0.5, 0.5]) for k in range(9)]) == [] == found_rows(spark, [(1, []), (2, [])])
    two = found_rows(spark, [(1, [1.0, 0.0]), (None, [0.0, 0.0]), (1, [1.0, 0.0]), (4, [])])  # one direction; a short vector
    assert len(two) == 4 and {r.component for r in two} == {1} and two[0].explained == pytest.approx(1)
    assert sum(r.whitened for r in two) == pytest.approx(0) and sum(r.whitened**2 for r in two) == pytest.approx(4)
    assert {r.vec_id for r in two} == {1, None, 4} and {r.deviation for r in two} == {128 * 128}


def test_foreign_columns(spark):
    rows = spark.createDataFrame([(k, [float(k), float(k % 3)], 1, 2.0) for k in range(20)], SCHEMA + ", n long, whitened double")
    assert whitening.whiten(rows).count() == 40
