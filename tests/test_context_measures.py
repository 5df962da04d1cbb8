"""Time intelligence in sparse filter contexts against a plain evaluation month by month."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tallycart.plans import measures
from tests.conftest import sale

CATEGORY = {1: "A", 2: "B", 3: "C"}


def facts(seed):
    rng = random.Random(seed)
    out = []
    for product, share in ((1, 0.9), (2, 0.25), (3, 0.06)):
        for k in range(40):
            if rng.random() < share:
                for _ in range(rng.randint(1, 3)):
                    out.append((product, dt.date(2021 + (k + 4) // 12, (k + 4) % 12 + 1, rng.randint(1, 28)), rng.randint(1, 50)))
    return out


@pytest.fixture(scope="module")
def sold(make):
    rows = facts(7)
    wh = make(
        fact_sales=[sale(amount, str(day), product=product) for product, day, amount in rows],
        dim_products=[dict(product_id=k, category=c) for k, c in CATEGORY.items()],
    )
    return wh, rows


def number(day):
    return day.year * 12 + day.month - 1


def plain(rows, category, month):
    """The measures of one context and month number, straight from the sales."""
    own = [(number(d), a) for p, d, a in rows if CATEGORY[p] == category]

    def total(first, last):
        found = [a for m, a in own if first <= m <= last]
        return float(sum(found)) if found else None

    year, quarter = month - month % 12, month - month % 3
    return dict(
        running_total_revenue=total(0, month), revenue_ytd=total(year, month), revenue_qtd=total(quarter, month),
        rolling_12_month_revenue=total(month - 11, month), rolling_3_month_revenue=total(month - 2, month),
        prior_year_revenue=total(month - 12, month - 12), prior_year_revenue_ytd=total(year - 12, month - 12),
    )


@pytest.mark.parametrize("gaps", [True, False])
def test_time_intelligence_of_sparse_contexts(sold, gaps):
    wh, rows = sold
    got = {(r.category, number(r.month)): r for r in measures.time_intelligence(wh, ["category"], gaps).collect()}
    end = max(number(d) for _, d, _ in rows)
    want = set()
    for c in CATEGORY.values():
        own = {number(d) for p, d, _ in rows if CATEGORY[p] == c}
        want |= {(c, m) for m in (range(min(own), end + 1) if gaps else own)}
    assert set(got) == want
    for (c, m), row in got.items():
        for name, value in plain(rows, c, m).items():
            assert getattr(row, name) == value, (c, m, name)


def test_growth_and_averages_see_empty_months(sold):
    wh, rows = sold
    for row in measures.growth(wh, ["category"]).collect():
        m = number(row.month)
        at = lambda k: plain(rows, row.category, k)  # noqa: E731, B023
        now, before = at(m + 12)["prior_year_revenue"], at(m + 11)["prior_year_revenue"]
        assert row.total_revenue == now and row.revenue_prior_month == before
        assert (row.mom_growth is None) == (now is None or before is None)
        if now is not None and before is not None:
            assert row.mom_growth == pytest.approx((now - before) / before, abs=5.1e-5)
    days = {}
    for p, d, a in rows:
        days.setdefault(CATEGORY[p], {}).setdefault(d, 0)
        days[CATEGORY[p]][d] += a
    for row in measures.moving_averages(wh, ["category"]).collect():
        own = [v for d, v in days[row.category].items() if number(row.month) - 2 <= number(d) <= number(row.month)]
        assert row.revenue_3_month_moving_avg == (pytest.approx(sum(own) / len(own), abs=0.0051) if own else None)


@pytest.mark.parametrize("gaps", [True, False])
def test_daily_measures_of_sparse_contexts(sold, gaps):
    wh, rows = sold
    got = measures.daily_measures(wh, ["category"], gaps).collect()
    for row in got:
        day = row.order_date
        own = {}
        for p, d, a in rows:
            if CATEGORY[p] == row.category:
                own[d] = own.get(d, 0) + a
        week = [v for d, v in own.items() if 0 <= (day - d).days < 7]
        month = [v for d, v in own.items() if (d.year, d.month) == (day.year, day.month) and d <= day]
        assert row.total_revenue == own.get(day) and row.revenue_mtd == (sum(month) if month else None)
        assert row.revenue_7_day_moving_avg == (pytest.approx(sum(week) / len(week), abs=0.0051) if week else None)
    last = max(d for _, d, _ in rows)
    first = {c: min(d for p, d, _ in rows if CATEGORY[p] == c) for c in CATEGORY.values()}
    sold_days = len({(p, d) for p, d, _ in rows})
    assert len(got) == (sum((last - d).days + 1 for d in first.values()) if gaps else sold_days)


def test_no_sales_no_rows(make):
    wh = make(fact_sales=[])
    for plan in (measures.time_intelligence, measures.growth, measures.moving_averages, measures.daily_measures, measures.flags):
        assert plan(wh, ["category"]).collect() == [] and plan(wh).collect() == []
