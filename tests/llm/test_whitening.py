"""Whitening against numpy's eigenvalues, and the iteration alone on wide spectra."""

from __future__ import annotations

import numpy as np
import pytest

from tallycart.llm import registry, whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(vectors):
    """n, deviations, whitened values and explained shares of float64 vectors."""
    x = np.floor(64 * np.asarray(vectors, dtype=float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centre = sums / n - 1_000_000
    own = fit - 1_000_000 - centre
    cov = own.T @ own / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    real = values > 1e-10 * values[0]
    values, vectors = values[real], vectors[:, real]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - 1_000_000 - centre) @ vectors / np.sqrt(values), values / np.trace(cov)


def checked(rows, ids, vectors, places=1e-9):
    n, deviation, want, explained = plain(vectors)
    k = want.shape[1]
    assert len(rows) == len(vectors) * k
    at = {v: i for i, v in enumerate(ids)}
    got = np.full(want.shape, np.nan)
    for r in rows:
        i = at[r.vec_id]
        got[i, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[i] and r.identity_error <= 1e-4
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < places


@pytest.mark.parametrize(("d", "n"), [(64, 500), (100, 300), (40, 1000)])
def test_equals_numpy(spark, d, n):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((n, d)) * np.linspace(2, 0.5, d)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(7)
    checked(whitening.whitened(frame).collect(), range(n), vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((60, 5)).astype(np.float32).tolist()
    good[7] = [0.0] * 5
    good[9] = good[8]
    nan, inf = float("nan"), float("inf")
    bad = [None, [None, 1.0, 1.0, 1.0, 1.0], [nan] * 5, [1.0, -inf, 0.0, 0.0, 0.0], [1.0, 2.0], [], [1e30] * 5]
    rows = [(i, v, i, "a") for i, v in enumerate(good)] + [(1000 + i, v, 0, None) for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, whitened string")
    got = whitening.whitened(frame)
    assert got.columns == COLUMNS
    checked(got.collect(), range(60), good)


def test_repeated_rows_and_null_ids_are_returned(spark):
    rng = np.random.default_rng(6)
    good = rng.standard_normal((30, 3)).tolist()
    frame = spark.createDataFrame([(None, good[0]), (4, good[1]), (4, good[1]), *((100 + i, v) for i, v in enumerate(good))], "id long, v array<double>")
    got = whitening.whitened(frame, "id", "v").collect()
    assert len(got) == 33 * 3 and sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 4 for r in got) == 6 and {r.n for r in got} == {30}


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whitened(spark.createDataFrame(rows, schema))
        assert got.columns == COLUMNS and got.collect() == []


def test_rank_below_the_components(spark):
    rng = np.random.default_rng(8)
    flat = np.round(rng.standard_normal((80, 4)) * 5) @ np.round(rng.standard_normal((4, 40)) * 3)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "vec_id long, embedding array<double>")
    checked(whitening.whitened(frame).collect(), range(80), flat)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [1e13 * i, float(i % 3)]) for i in range(5)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got if r.deviation is None} == {0, 1, 3, 4} and {r.deviation for r in got if r.vec_id == 2} != {None}


@pytest.mark.parametrize("spectrum", [np.linspace(80, 50, 300), 1 / np.arange(1, 301) ** 2, np.r_[np.full(20, 3.0), np.full(280, 1.0)]])
def test_iteration_on_wide_spectra(spectrum):
    rng = np.random.default_rng(1)
    basis, _ = np.linalg.qr(rng.standard_normal((300, 300)))
    cov = basis * spectrum @ basis.T
    passes = [0]

    def times(q):
        passes[0] += 1
        return cov @ q

    s = whitening.Settings()
    values, vectors, worst = whitening.leading(times, 300, s)
    assert worst <= s.accept and np.abs(values / np.sort(spectrum)[::-1][:16] - 1).max() < 1e-10
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-9 * spectrum.max()
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
    assert passes[0] < 200


def test_lower_end_of_the_spectrum():
    rng = np.random.default_rng(2)
    basis, _ = np.linalg.qr(rng.standard_normal((50, 50)))
    cov = basis * np.linspace(9, 4, 50) @ basis.T
    probe = whitening.Lanczos(rng.standard_normal(50))
    bounds = []
    for _ in range(60):
        probe.step(cov @ probe.vector)
        bounds.append(probe.least())
    assert all(b <= 4.05 for b in bounds[7:]) and abs(bounds[-1] - 4) < 1e-6


def test_query_covers_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()
    got = registry.QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001").collect()
    checked(got, table.vec_id.tolist(), np.array([np.asarray(v, dtype=float) for v in table.embedding]))
