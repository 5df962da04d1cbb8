"""Statistics against textbook values and exact constructions."""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallycart.functions import tails
from tallycart.plans import statistics
from tests.conftest import day, sale


@pytest.mark.parametrize(
    ("t", "df", "p"),
    [(12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (2.042, 30, 0.05), (1.960, 1e7, 0.05), (0.0, 5, 1.0)],
)
def test_t_tail_matches_the_tables(t, df, p):
    assert tails.t_two_sided(t, df) == pytest.approx(p, abs=2e-4)


@pytest.mark.parametrize(("f", "a", "b", "p"), [(4.96, 1, 10, 0.05), (3.49, 3, 12, 0.05), (5.95, 3, 12, 0.01), (2.68, 3, 120, 0.05)])
def test_f_tail_matches_the_tables(f, a, b, p):
    assert tails.f_upper(f, a, b) == pytest.approx(p, abs=3e-4)


def test_t_quantile_inverts_the_tail():
    for df in (2, 7, 40, 50000):
        assert tails.t_two_sided(tails.t_quantile(0.95, df), df) == pytest.approx(0.05, abs=1e-10)


def _varied(make, n=300):
    rng = np.random.default_rng(5)
    return make(
        fact_sales=[
            sale(
                round(float(rng.normal(100, 20)) ** 1 + 50, 2), f"2024-{k % 12 + 1:02d}-11", customer=k % 40, quantity=int(rng.integers(1, 9)),
                discount=Decimal(int(rng.integers(0, 30))) / 100, profit=Decimal(int(rng.integers(-500, 3000))) / 100,
                sales_channel="Online" if rng.random() < 0.6 else "Offline",
            )
            for k in range(n)
        ],
        dim_customers=[
            dict(customer_id=c, segment=("Premium", "New", "Budget", "Regular")[c % 4], age=20 + c,
                 income=None if c % 10 == 0 else Decimal(1000 * c))
            for c in range(40)
        ],
    )


@pytest.fixture(scope="module")
def wh(make):
    return _varied(make)


@pytest.fixture(scope="module")
def frame(wh):
    return statistics.features(wh).toPandas().astype(
        {c: float for c in ("quantity", "discount", "sales_amount", "profit", "income", "age")}
    )


def test_correlations_match_numpy(wh, frame):
    kept = frame.dropna(subset=["income", "age"])
    for r in statistics.correlations(wh).collect():
        assert r.n == len(kept)
        assert r.r == pytest.approx(np.corrcoef(kept[r.x], kept[r.y])[0, 1], abs=2e-6)


def test_regression_recovers_a_plane(make):
    """profit = 3 + 2 quantity - 40 discount + 0.1 amount, without noise."""
    sales = []
    for k in range(80):
        q, d, a = k % 7 + 1, (k * 3 % 11) / 100, 20 + (k * 7 % 31)
        sales.append(sale(a, quantity=q, discount=Decimal(str(d)), profit=Decimal(str(round(3 + 2 * q - 40 * d + 0.1 * a, 2)))))
    got = {r.term: r for r in statistics.regression(make(fact_sales=sales)).collect()}
    assert [got[t].coefficient for t in ("intercept", "quantity", "discount", "sales_amount")] == pytest.approx([3, 2, -40, 0.1], abs=1e-3)
    assert got["discount"].r_squared == pytest.approx(1.0)


def test_welch_and_interval_match_the_formulas(wh, frame):
    a, b = (frame[frame.sales_channel == c].sales_amount for c in ("Online", "Offline"))
    va, vb = a.var() / len(a), b.var() / len(b)
    r = statistics.channel_test(wh).first()
    assert r.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(va + vb), abs=1e-4)
    assert r.df == pytest.approx((va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)), abs=0.01)
    i = statistics.mean_interval(wh).first()
    reach = tails.t_quantile(0.95, 299) * frame.sales_amount.std() / math.sqrt(300)
    assert i.upper - i.lower == pytest.approx(2 * reach, abs=0.02)


def test_anova_matches_the_sums_of_squares(wh, frame):
    groups = [g.sales_amount.to_numpy() for _, g in frame.groupby("segment")]
    between = sum(len(g) * (g.mean() - frame.sales_amount.mean()) ** 2 for g in groups) / 3
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (300 - 4)
    assert statistics.segment_anova(wh).first().f == pytest.approx(between / within, abs=1e-3)


def test_outlier_rules(make):
    wh = make(fact_sales=[sale(10 + k % 5) for k in range(60)] + [sale(500)])
    out = statistics.outliers(wh).collect()
    assert [(r.sales_amount, r.iqr_outlier, r.z_outlier) for r in out] == [(500.0, True, True)]
    summary = {r.method: r.outliers for r in statistics.outlier_summary(wh).collect()}
    assert summary == {"iqr": 1, "z_score": 1}


def test_every_customer_is_nearest_to_its_own_centre(make):
    blobs = [(1, 1000), (4, 10), (12, 300), (9, 5000)]
    sales = []
    for c in range(40):
        months, amount = blobs[c % 4]
        sales += [sale(amount + c, f"2024-{m + 1:02d}-0{c % 7 + 1}", customer=c) for m in range(months)]
    got = statistics.clustered(make(fact_sales=sales)).toPandas()
    points = np.array(got.features.tolist())
    centres = {k: points[got.cluster == k].mean(axis=0) for k in sorted(got.cluster.unique())}
    assert len(centres) == 4
    for point, own in zip(points, got.cluster):
        assert min(centres, key=lambda k: ((point - centres[k]) ** 2).sum()) == own
    assert got.groupby("cluster").customer_id.apply(lambda ids: len({i % 4 for i in ids})).max() == 1


def test_forest_ignores_an_unrelated_input(make):
    rng = np.random.default_rng(3)
    sales = [
        sale(round(float(rng.uniform(10, 90)), 2), customer=k % 50, quantity=int(q), profit=Decimal(str(round(20.0 * q, 2))))
        for k, q in enumerate(rng.integers(1, 10, 600))
    ]
    people = [dict(customer_id=c, age=int(rng.integers(20, 70)), income=Decimal(int(rng.integers(1, 9)) * 1000)) for c in range(50)]
    got = {r.feature: r for r in statistics.importance(make(fact_sales=sales, dim_customers=people), trees=10, depth=5).collect()}
    assert got["quantity"].importance > 0.95 and got["age"].importance < 0.02
    assert got["quantity"].test_r_squared > 0.95


SEASON = [5, -3, 2, 0, 1, -4, 6, -2, 3, -5, -1, -2]  # sums to zero


def _months(n, value):
    return [sale(value(k), f"{2020 + k // 12}-{k % 12 + 1:02d}-15") for k in range(n)]


def test_decomposition_of_an_exact_series(make):
    wh = make(fact_sales=_months(48, lambda k: 1000 + 3 * k + 10 * SEASON[k % 12]))
    for r in statistics.decomposed(wh).collect():
        k = (r.month.year - 2020) * 12 + r.month.month - 1
        assert r.seasonal == pytest.approx(10 * SEASON[k % 12], abs=1e-6)
        if 6 <= k < 42:
            assert r.trend == pytest.approx(1000 + 3 * k) and r.resid == pytest.approx(0.0, abs=1e-6)
            assert r.trend + r.seasonal + r.resid == pytest.approx(r.observed)
        else:
            assert r.trend is None and r.resid is None
    s = statistics.seasonality(wh).first()
    assert (s.seasonal_strength, s.peak_month, s.trough_month) == (1.0, 7, 10)


def test_trend_of_a_line(make):
    r = statistics.trend(make(fact_sales=_months(24, lambda k: 100 + 7 * k + (k % 2)))).first()
    assert r.slope == pytest.approx(7.0, abs=0.02) and r.p == 0.0 and r.direction == "upward"


def test_elasticity_recovers_a_constant_slope(make):
    data = []
    for month in range(1, 13):
        price = 10 + month
        units = round(100_000 * price**-2.0)
        data.append(sale(price * units, f"2024-{month:02d}-10", quantity=units))
    got = statistics.price_elasticity(make(fact_sales=data, dim_products=[dict(product_id=1, category="A")])).first()
    assert got.product_months == 12 and got.elasticity == pytest.approx(-2.0, abs=0.01) and got.r_squared > 0.999
    flat = statistics.price_elasticity(make(fact_sales=[sale(10), sale(10, "2024-02-10")], dim_products=[dict(product_id=1, category="A")])).first()
    assert flat.elasticity is None


def test_churn_probability_follows_recency(make):
    data = []
    for c in range(1, 121):
        idle = c % 2 == 0  # idle customers bought long ago and never come back
        data.append(sale(50, "2023-02-01" if idle else "2023-12-20", customer=c))
        if not idle:
            data.append(sale(20, "2024-02-01", customer=c))
    rows = {r.customer_id: r for r in statistics.churn_propensity(make(fact_sales=data), day("2023-12-31")).collect()}
    assert len(rows) == 120 and {r.churned for c, r in rows.items() if c % 2 == 0} == {1}
    assert min(r.churn_probability for c, r in rows.items() if c % 2 == 0) > 0.8
    assert max(r.churn_probability for c, r in rows.items() if c % 2) < 0.2


def test_churn_in_a_session_that_has_observed_metrics(spark, make):
    """Loads observe counts; such a session can't be sent to tasks, and a fitted model holds it by its summary."""
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    data = [sale(50, "2023-02-01" if c % 2 else "2023-12-20", customer=c) for c in range(1, 21)]
    data += [sale(20, "2024-02-01", customer=c) for c in range(2, 21, 2) if c != 4]
    wh = make(fact_sales=data)
    got = statistics.churn_propensity(wh, day("2023-12-31")).collect()
    chance = {r.customer_id: r.churn_probability for r in got}
    assert {r.customer_id for r in got if r.churned} == {4, *range(1, 21, 2)}
    assert len(chance) == 20 and len(set(chance.values())) == 2  # alike customers score alike
    # the intercept isn't regularised, so the probabilities add up to the number of those who stayed away
    assert chance[1] > 0.8 and chance[2] < 0.3 and sum(chance.values()) == pytest.approx(11, abs=1e-2)
    # nobody stays away, or everybody does: the regression has an infinite intercept
    for back, all_alike in ((["2024-02-01"], 0.0), ([], 1.0)):
        sales = [sale(50, d, customer=c) for c in (1, 2, 3) for d in ["2023-12-20", *back]]
        assert {r.churn_probability for r in statistics.churn_propensity(make(fact_sales=sales), day("2023-12-31")).collect()} == {all_alike}
