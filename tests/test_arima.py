"""ARIMA and SARIMA panels against least squares and polynomial division in numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycart.plans import arima
from tests.test_forecasting import WAVE, ahead, seasonal, series

EDGE = arima.EDGE


def lagged(x, ks, start):
    return np.column_stack([x[start - k : len(x) - k] for k in ks])


def residuals(w, lags):
    """e of a long autoregression, 0 before its lags reach."""
    m = max(lags)
    x = lagged(w, lags, m)
    beta, *_ = np.linalg.lstsq(x, w[m:], rcond=None)
    return np.concatenate([np.zeros(m), w[m:] - x @ beta]), m


def psi(ar, ma, n):
    """Weights of past shocks from the polynomials 1 - ar and 1 + ma."""
    out = [1.0]
    for j in range(1, n):
        out.append(sum(a * out[j - k] for k, a in enumerate(ar, 1) if k <= j) + (ma[j - 1] if j <= len(ma) else 0.0))
    return np.array(out)


def forecasts(y, e, ar, ma, sigma2, n=12):
    y, e, out = list(y), list(e), []
    for _ in range(n):
        f = sum(a * y[-k] for k, a in enumerate(ar, 1)) + sum(q * e[-k] for k, q in enumerate(ma, 1))
        y.append(f)
        e.append(0.0)
        out.append(f)
    return np.array(out), 1.96 * np.sqrt(sigma2 * np.cumsum(psi(ar, ma, n) ** 2))


def noisy(n, seed, p=(0.5, -0.3), q=(0.4, 0.2)):
    rng = np.random.default_rng(seed)
    a, w = rng.normal(0, 10, n + 50), np.zeros(n + 50)
    for t in range(2, n + 50):
        w[t] = p[0] * w[t - 1] + p[1] * w[t - 2] + a[t] + q[0] * a[t - 1] + q[1] * a[t - 2]
    return 1000 + np.cumsum(w[50:])


@pytest.mark.parametrize("n", [24, 60, 300])
def test_arima_equals_two_regressions(spark, n):
    y = noisy(n, n)
    w = np.diff(y)
    e, m = residuals(w, arima.LONG_LAGS)
    x = np.column_stack([lagged(w, (1, 2), m), lagged(e, (1, 2), m)])
    c, *_ = np.linalg.lstsq(x, w[m:], rcond=None)
    p2 = np.clip(c[1], -EDGE, EDGE)
    p1 = np.clip(c[0] / (1 - p2), -EDGE, EDGE) * (1 - p2)
    sigma2 = ((w[m:] - x @ [p1, p2, c[2], c[3]]) ** 2).sum() / (len(w) - m - 4)
    want, band = forecasts(y, e, [1 + p1, p2 - p1, -p2], c[2:], sigma2)
    got = ahead(arima.arima(series(spark, a=y, short=y[:23])))
    assert set(got) == {"a"} and got["a"][:, 0] == pytest.approx(want, rel=1e-7)
    assert got["a"][:, 2] - got["a"][:, 0] == pytest.approx(band, rel=1e-6) and (np.diff(band) > 0).all()


def test_arima_finds_the_weights_of_a_long_series(spark):
    rows = arima.first_stage(arima.differenced(series(spark, a=noisy(6000, 3)), 24, False), arima.LONG_LAGS)
    laid = rows.select("*", *arima.along("w", (1, 2), "l"), *arima.along("e", (1, 2), "e")).where("full")
    sums = laid.groupBy("series").agg(*arima.sums_of_products(["w", "l1", "l2", "e1", "e2"]))
    got = sums.select(arima.solved(arima.equations(["l1", "l2", "e1", "e2"], "w"), 4)).first()[0]
    assert got == pytest.approx([0.5, -0.3, 0.4, 0.2], abs=0.12)


def seasonal_noise(n, seed):
    rng = np.random.default_rng(seed)
    a, w = rng.normal(0, 5, n), np.zeros(n)
    for t in range(n):
        at = lambda x, k: x[t - k] if t >= k else 0.0  # noqa: E731, B023
        w[t] = 0.4 * at(w, 1) + 0.3 * at(w, 12) - 0.12 * at(w, 13) + a[t] + 0.3 * at(a, 1) - 0.5 * at(a, 12) - 0.15 * at(a, 13)
    y = np.concatenate([1000 + WAVE, [1005.0], np.zeros(n)])
    for t in range(13, n + 13):
        y[t] = w[t - 13] + y[t - 1] + y[t - 12] - y[t - 13]
    return y


@pytest.mark.parametrize("n", [36, 90, 240])
def test_sarima_equals_alternating_regressions(spark, n):
    y = seasonal_noise(n - 13, n)
    w = y[13:] - y[12:-1] - y[1:-12] + y[:-13]
    e, m = residuals(w, arima.SEASONAL_LAGS)
    w0, w1, w12, w13 = (w[m - k : len(w) - k] for k in (0, 1, 12, 13))
    e1, e12, e13 = (e[m - k : len(e) - k] for k in (1, 12, 13))
    clip = lambda c: np.clip(c, -EDGE, EDGE)
    sp = sq = 0.0
    for _ in range(arima.TURNS):
        p, q = clip(np.linalg.lstsq(np.column_stack([w1 - sp * w13, e1 + sq * e13]), w0 - sp * w12 - sq * e12, rcond=None)[0])
        sp, sq = clip(np.linalg.lstsq(np.column_stack([w12 - p * w13, e12 + q * e13]), w0 - p * w1 - q * e1, rcond=None)[0])
    miss = w0 - p * w1 - sp * w12 + p * sp * w13 - q * e1 - sq * e12 - q * sq * e13
    poly = lambda *parts: __import__("functools").reduce(np.polymul, parts)
    at = lambda k, v: np.r_[v, np.zeros(k - 1), 1.0]  # noqa: E731  1 + v B^k, highest power first
    ar = -poly(at(1, -p), at(12, -sp), at(1, -1.0), at(12, -1.0))[::-1][1:]
    ma = poly(at(1, q), at(12, sq))[::-1][1:]
    want, band = forecasts(y, e, ar, ma, (miss**2).sum() / (len(w0) - 4))
    got = ahead(arima.sarima(series(spark, a=y, short=y[:35])))
    assert set(got) == {"a"} and got["a"][:, 0] == pytest.approx(want, rel=1e-6)
    assert got["a"][:, 2] - got["a"][:, 0] == pytest.approx(band, rel=1e-5)


def test_seasonal_model_inverts_the_differences_exactly(spark):
    got = ahead(arima.sarima(series(spark, wave=seasonal(72), line=100 + 5.0 * np.arange(60), flat=np.full(48, 7.0))))
    assert got["wave"][:, 0] == pytest.approx(seasonal(84)[72:]) and got["line"][:, 0] == pytest.approx(100 + 5.0 * np.arange(60, 72))
    assert got["flat"] == pytest.approx(np.full((12, 3), 7.0))


def test_flat_short_empty_and_explosive_series(spark):
    growing = 2.0 ** np.arange(40)
    got = ahead(arima.arima(series(spark, flat=np.full(30, 5.0), up=growing, zero=np.zeros(24), few=np.arange(10.0))))
    assert set(got) == {"flat", "up", "zero"} and got["flat"] == pytest.approx(np.full((12, 3), 5.0))
    assert np.isfinite(got["up"]).all() and got["zero"] == pytest.approx(np.zeros((12, 3)))
    empty = series(spark, a=[1.0]).where(F.lit(False))
    assert arima.arima(empty).collect() == [] and arima.sarima(empty).collect() == []


def test_elimination_drops_what_is_explained(spark):
    rows = [(2.0, 4.0, 6.0, 8.0), (2.0, 4.0, 7.0, 8.0)]
    for a, b, c, d in rows:  # second regressor is twice the first; only the first gets weight
        frame = spark.createDataFrame([([[a, b, c], [b, d, 2 * c]],)], "m array<array<double>>")
        assert frame.select(arima.solved(F.col("m"), 2)).first()[0] == pytest.approx([c / a, 0.0])
