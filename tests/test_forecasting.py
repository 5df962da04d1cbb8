"""Forecast models on constructed series."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycart.plans import forecasting
from tests.conftest import day, rows, sale

WAVE = np.array([50, -30, 20, 0, 10, -40, 60, -20, 30, -50, -10, -20], dtype=float)


def seasonal(n, slope=4.0, level=1000.0):
    k = np.arange(n)
    return level + slope * k + WAVE[k % 12]


def series(spark, **named):
    data = []
    for name, values in named.items():
        data += [(name, dt.date(2020 + k // 12, k % 12 + 1, 1), float(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(data, "series string, month date, revenue double")


def test_moving_average_feeds_back(spark):
    got = forecasting.moving_average(series(spark, a=[9, 1, 2, 6], b=[4, 8]), horizon=3)
    by = {}
    for r in got.orderBy("series", "month").collect():
        by.setdefault(r.series, []).append((r.month, r.forecast))
    m1 = 3.0
    m2 = (2 + 6 + m1) / 3
    assert [v for _, v in by["a"]] == pytest.approx([m1, m2, (6 + m1 + m2) / 3])
    assert by["a"][0][0] == dt.date(2020, 5, 1)
    assert [v for _, v in by["b"]] == pytest.approx([6.0, 6.0, 20 / 3])


def test_metrics_and_undefined_mape(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0), ("a", 20.0, 24.0), ("b", 0.0, 1.0)], "series string, revenue double, forecast double")
    got = {r.series: r for r in forecasting.metrics(df, "series").collect()}
    assert (got["a"].rmse, got["a"].mae, got["a"].mape) == (pytest.approx(10**0.5), 3.0, pytest.approx(20.0))
    assert got["b"].mape is None and got["b"].mae == 1.0


def test_holdout_is_the_end_of_each_series(spark):
    train, test = forecasting.holdout(series(spark, a=range(20), b=range(30)), 12)
    assert {(r.series, r["count"]) for r in train.groupBy("series").count().collect()} == {("a", 8), ("b", 18)}
    assert test.where("series = 'b'").agg(F.min("revenue")).first()[0] == 18.0


def ahead(frame):
    out = {}
    for r in frame.orderBy("series", "month").collect():
        out.setdefault(r.series, []).append((r.forecast, r.lower, r.upper))
    return {k: np.array(v) for k, v in out.items()}


def test_smoothing_continues_a_pure_season_and_follows_a_line(spark):
    k = np.arange(48)
    got = ahead(forecasting.smoothing(series(spark, wave=1000 + WAVE[k % 12], line=100 + 5.0 * k, short=k[:23])))
    assert set(got) == {"wave", "line"}
    assert got["wave"][:, 0] == pytest.approx(1000 + WAVE, abs=1e-6)
    assert (got["wave"][:, 2] - got["wave"][:, 1]) == pytest.approx(np.zeros(12), abs=1e-6)
    assert got["line"][:, 0] == pytest.approx(100 + 5.0 * np.arange(48, 60), abs=1e-6)


def errors(y, a, b, g):
    """Squared one-step errors and forecasts for arrays of weights."""
    slope = np.full(len(a), (y[12:24].mean() - y[:12].mean()) / 12)
    season = [np.full(len(a), y[k] - y[:12].mean() - slope[0] * (k - 5.5)) for k in range(12)]
    level, sse = y[:12].mean() + slope * 5.5, np.zeros(len(a))
    for v in y[12:]:
        s = season.pop(0)
        e = v - level - slope - s
        up = a * (v - s) + (1 - a) * (level + slope)
        slope = b * (up - level) + (1 - b) * slope
        season.append(g * (v - up) + (1 - g) * s)
        level, sse = up, sse + e * e
    return sse, np.array([level + h * slope + season[(h - 1) % 12] for h in range(1, 13)])


def grid(*axes):
    return [x.ravel() for x in np.meshgrid(*axes, indexing="ij")]


def test_smoothing_zooms_to_the_best_weights(spark):
    rng = np.random.default_rng(1)
    walk = 500 + np.cumsum(rng.normal(3, 12, 60))
    given = dict(noisy=seasonal(40) + rng.normal(0, 20, 40), walk=walk, both=walk + seasonal(60) / 2, drifting=seasonal(72) * np.linspace(1, 1.4, 72) + rng.normal(0, 9, 72))
    got = ahead(forecasting.smoothing(series(spark, **given)))
    for name, y in given.items():
        best = (0.5, 0.5, 0.5)
        for points, width in forecasting.ZOOM:
            tried = grid(*(np.linspace(max(0, w - width), min(1, w + width), points) for w in best))
            sse, forecasts = errors(y, *tried)
            k = sse.argmin()
            best = tuple(x[k] for x in tried)
        fine, _ = errors(y, *grid(*[np.linspace(0, 1, 30)] * 3))
        assert sse[k] <= 1.04 * fine.min()  # the error has several valleys; the zoom follows the best of the first grid
        assert got[name][:, 0] == pytest.approx(forecasts[:, k], rel=1e-6)
        assert got[name][:, 2] - got[name][:, 0] == pytest.approx(np.full(12, 1.96 * np.sqrt(sse[k] / (len(y) - 12))), rel=1e-6)


def test_log_linear_equals_least_squares(spark):
    rng = np.random.default_rng(2)
    k = np.arange(43)
    y = np.exp(6 + 0.01 * k + 0.2 * np.sin(2 * np.pi * k / 12) + rng.normal(0, 0.05, 43)) - 1
    x = np.column_stack([k.astype(float), (k[:, None] % 12 == np.arange(12)).astype(float)])
    beta, *_ = np.linalg.lstsq(x, np.log1p(y), rcond=None)
    t = np.arange(43, 55)
    want = np.exp(np.column_stack([t.astype(float), (t[:, None] % 12 == np.arange(12)).astype(float)]) @ beta) - 1
    sigma = np.sqrt(((np.log1p(y) - x @ beta) ** 2).sum() / 30)
    got = ahead(forecasting.log_linear(series(spark, a=y, low=np.full(30, -2.0), short=k[:20])))
    assert set(got) == {"a"} and got["a"][:, 0] == pytest.approx(want)
    assert got["a"][:, 2] == pytest.approx((want + 1) * np.exp(1.96 * sigma) - 1)


def test_best_model_is_chosen_per_series_and_no_series_is_lost(spark):
    gap = np.full(48, 100.0)
    gap[47] = 0.0  # a held-out month without revenue
    panel = series(spark, wave=1000 + WAVE[np.arange(60) % 12], flat=np.full(60, 5.0), ten=range(1, 11), twenty=range(1, 21), gap=gap)
    scores = forecasting.scorecard(panel).collect()
    assert {(r.series, r.model) for r in scores} == {(s, m) for s in ("wave", "flat", "ten", "twenty", "gap") for m in forecasting.MODELS}
    chosen = {r.series: r for r in scores if r.chosen}
    assert set(chosen) == {"wave", "flat", "ten", "twenty", "gap"} and chosen["wave"].mape < 0.01
    assert chosen["ten"].model == forecasting.MOVING_AVERAGE and chosen["ten"].reason == forecasting.NO_HOLDOUT
    assert {r.reason for r in scores if r.series == "twenty" and r.model != forecasting.MOVING_AVERAGE} == {forecasting.SHORT}
    gaps = [r for r in scores if r.series == "gap"]
    assert all(r.mape is None for r in gaps) and chosen["gap"].rmse == min(r.rmse for r in gaps)
    out = forecasting.outlook(panel).collect()
    assert {(s, sum(r.series == s for r in out)) for s in chosen} == {(s, 12) for s in chosen}
    assert {r.reason for r in out if r.series == "ten"} == {forecasting.NO_HOLDOUT}


def test_series_are_gap_free_and_split_by_attribute(make):
    wh = make(
        fact_sales=[sale(5, "2024-01-10"), sale(7, "2024-04-10"), sale(9, "2024-02-10", product=2)],
        dim_products=[dict(product_id=1, category="A"), dict(product_id=2, category="B")],
    )
    total = {r.month: r.revenue for r in forecasting.monthly_series(wh).collect()}
    assert total == {day("2024-01-01"): 5.0, day("2024-02-01"): 9.0, day("2024-03-01"): 0.0, day("2024-04-01"): 7.0}
    parts = forecasting.monthly_series(wh, ["category"])
    assert rows(parts.groupBy("series").count(), "series", "count") == [("A", 4), ("B", 1)]
    assert Decimal(parts.agg(F.sum("revenue")).first()[0]) == Decimal(21)
