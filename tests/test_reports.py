"""Edge cases of the reports on hand-made rows: ties, gaps, zero denominators, duplicate returns."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallycart.plans import customers, insights, kpis, measures, places, products, returns, sequences, stock, views
from tests.conftest import day, rows, sale


def test_q01_empty_sales_give_null_margin(make):
    wh = make(fact_sales=[])
    row = kpis.q01(wh).first()
    assert row.total_revenue is None and row.gross_margin_pct is None


def test_q02_second_return_of_an_order_does_not_repeat_its_profit(make):
    wh = make(
        fact_sales=[sale(100, profit=Decimal("40.00"))],
        fact_returns=[
            dict(order_id="o1", refund_amount=Decimal("10.00")),
            dict(order_id="o1", refund_amount=Decimal("5.00")),
            dict(order_id="o1", refund_amount=Decimal("99.00"), return_status="Rejected"),
            dict(order_id="gone", refund_amount=Decimal("7.00")),
        ],
    )
    row = kpis.q02(wh).first()
    assert (row.gross_profit, row.total_refunds, row.net_profit, row.net_margin_pct) == (40.0, 15.0, 25.0, 25.0)


def test_q08_share_of_the_top_tenth(make):
    """Eleven customers: rank shares are 0, .1, .2 ...; the two best count."""
    wh = make(fact_sales=[sale(100 - 5 * c, customer=c) for c in range(11)])
    every = sum(100 - 5 * c for c in range(11))
    assert kpis.q08(wh).first()[0] == round(100 * 195 / every, 2)


def test_q08_single_customer_is_the_top(make):
    assert kpis.q08(make(fact_sales=[sale(5)])).first()[0] == 100.0


def test_growth_after_zero_revenue_is_null(make):
    wh = make(fact_sales=[sale(0, "2024-01-05"), sale(10, "2024-02-05"), sale(15, "2024-03-05")])
    assert [r.mom_growth_pct for r in kpis.q11(wh).orderBy("month").collect()] == [None, None, 50.0]


def test_q13_counts_rows_but_the_measure_counts_months(make):
    """With a month missing the report's lag lands on the wrong month, the spine-based measure does not."""
    months = [f"2023-{m:02d}-03" for m in range(1, 13) if m != 6] + ["2024-01-03"]
    wh = make(fact_sales=[sale(10 + k, m) for k, m in enumerate(months)])
    report = {r.month: r.revenue_same_month_last_year for r in kpis.q13(wh).collect()}
    measure = {r.month: r.prior_year_revenue for r in measures.time_intelligence(wh).collect()}
    assert report[day("2024-01-01")] is None
    assert measure[day("2024-01-01")] == 10.0
    assert measures.month_rows(wh).count() == 13


def test_q18_keeps_ties(make):
    wh = make(
        fact_sales=[sale(v, product=p) for p, v in ((1, 9), (2, 9), (3, 5), (4, 4), (5, 1))],
        dim_products=[dict(product_id=p) for p in range(1, 6)],
    )
    assert rows(sequences.q18(wh), "product_id", "rnk") == [(1, 1), (2, 1), (3, 2), (4, 3)]


def test_q20_quartiles_split_tied_products(make):
    wh = make(fact_sales=[sale(5, product=p) for p in range(1, 7)])
    assert rows(sequences.q20(wh), "quartile", "num_products", "total_revenue") == [
        (1, 2, 10.0), (2, 2, 10.0), (3, 1, 5.0), (4, 1, 5.0)
    ]


def test_q22_tie_takes_lowest_order_id(make):
    wh = make(fact_sales=[sale(7, order_id="b"), sale(7, order_id="a"), sale(3, order_id="c")])
    assert [r.order_id for r in sequences.q22(wh).collect()] == ["a"]


def test_q23_peers_share_the_cumulative_value(make):
    wh = make(fact_sales=[sale(50, product=1), sale(25, product=2), sale(25, product=3)])
    assert rows(sequences.q23(wh), "product_id", "cumulative_pct") == [(1, 50.0), (2, 100.0), (3, 100.0)]


def test_abc_without_any_a_product(make):
    wh = make(fact_sales=[sale(90, product=1), sale(6, product=2), sale(4, product=3)])
    assert rows(products.q36(wh), "product_id", "abc_class") == [(1, "B"), (2, "C"), (3, "C")]
    assert rows(products.q37(wh), "abc_class", "num_skus") == [("B", 1), ("C", 2)]


def test_abc_cut_is_inclusive(make):
    wh = make(fact_sales=[sale(80, product=1), sale(15, product=2), sale(5, product=3)])
    assert rows(products.q36(wh), "product_id", "abc_class") == [(1, "A"), (2, "B"), (3, "C")]
    assert sum(r.pct_of_revenue for r in products.q37(wh).collect()) == pytest.approx(100.0)


def test_q24_scores_and_bands(make):
    wh = make(fact_sales=[sale(10 * c, f"2024-01-{c:02d}", customer=c) for c in range(1, 11)])
    got = {r.customer_id: r for r in customers.q24(wh, day("2024-12-31")).collect()}
    assert got[10].rfm_total == 15 and got[10].rfm_segment == "Champion"
    assert got[1].r_score == 1 and got[1].m_score == 1


def test_q28_month_zero_never_exceeds_the_cohort(make):
    wh = make(
        dim_customers=[dict(customer_id=c, signup_date=day("2023-01-20")) for c in (1, 2)],
        fact_sales=[sale(1, "2023-01-25"), sale(1, "2023-01-26"), sale(1, "2022-12-01", 2), sale(1, "2024-03-01", 2)],
    )
    assert rows(customers.q28(wh), "month_number", "active_customers", "retention_pct") == [(0, 1, 50.0)]


def test_churn_rules_differ_at_the_boundary(make):
    """Exactly 180 days: the strict report does not count the customer, the insight does."""
    wh = make(fact_sales=[sale(1, "2024-01-01", 1), sale(1, "2024-06-29", 2)])
    assert customers.q29(wh, day("2024-06-29")).first().churned_customers == 0
    assert insights.churn_rate(wh).first().at_risk == 1


def test_q32_mean_gap_equals_pairwise_mean(make):
    dates = ["2024-01-01", "2024-01-04", "2024-01-04", "2024-02-01"]
    row = customers.q32(make(fact_sales=[sale(1, d) for d in dates])).first()
    assert row.avg_days_between_purchases == round((3 + 0 + 28) / 3, 1)


def test_q34_first_day_orders_are_new(make):
    wh = make(fact_sales=[sale(5, "2024-01-01"), sale(6, "2024-01-01"), sale(7, "2024-01-02")])
    row = customers.q34(wh).first()
    assert (row.new_customer_revenue, row.returning_customer_revenue) == (11.0, 7.0)


def test_q46_products_without_stock_come_first(make):
    wh = make(
        fact_inventory=[
            dict(product_id=1, opening_stock=0, closing_stock=0, sold_stock=3),
            dict(product_id=2, opening_stock=10, closing_stock=10, sold_stock=5),
        ]
    )
    got = [(r.product_id, r.turnover_ratio) for r in stock.q46(wh).collect()]
    assert got == [(1, None), (2, 0.5)]


def test_q48_repeats_sums_and_the_corrected_form_does_not(make):
    wh = make(
        fact_inventory=[dict(warehouse_id=w, closing_stock=6) for w in (1, 2)],
        fact_sales=[sale(1, quantity=2), sale(1, quantity=3), sale(1, quantity=4)],
    )
    assert rows(stock.q48(wh), "total_stock_on_hand", "units_sold_lifetime") == [(36, 18)]
    assert rows(stock.q48_single(wh), "total_stock_on_hand", "units_sold_lifetime") == [(12, 9)]


def test_q51_unknown_damage_scores_zero(make):
    wh = make(fact_inventory=[dict(received_stock=0, damaged_stock=0)])
    row = stock.q51(wh).first()
    assert row.damage_rate_pct is None and row.inventory_health_score == 0.0


def test_q56_counts_each_return_of_an_order(make):
    wh = make(
        fact_sales=[sale(1), sale(1)],
        fact_returns=[dict(order_id="o1"), dict(order_id="o1"), dict(order_id="unknown")],
    )
    row = returns.q56(wh).first()
    assert (row.orders, row["returns"], row.return_rate_pct) == (2, 2, 100.0)


def test_q61_ranks_ties_alike(make):
    wh = make(fact_sales=[sale(9, store_id=1), sale(9, store_id=2), sale(4, store_id=3)])
    assert rows(places.q61(wh), "store_id", "store_rank") == [(1, 1), (2, 1), (3, 3)]


def test_q64_fills_empty_months(make):
    wh = make(fact_sales=[sale(5, "2024-01-10")])
    got = places.q64(wh, day("2023-12-01"), day("2024-02-01"))
    assert [r.revenue for r in got.orderBy("month").collect()] == [0.0, 5.0, 0.0]


def test_q65_average_itself_is_not_above(make):
    wh = make(fact_sales=[sale(10), sale(10), sale(4, customer=2), sale(6, customer=2)])
    assert rows(places.q65(wh), "customer_id", "sales_amount") == [(2, 6.0)]


def test_q69_first_month_has_no_history(make):
    wh = make(fact_sales=[sale(5, "2024-01-10"), sale(5, "2024-02-10"), sale(4, "2024-03-10")])
    flags = [r.trend_flag for r in places.q69(wh).orderBy("month").collect()]
    assert flags == ["Insufficient History", "Above Trend", "Below Trend"]


def test_running_total_ends_at_the_total(make):
    wh = make(fact_sales=[sale(v, f"2024-01-{v:02d}") for v in range(1, 20)])
    assert sequences.q16(wh).agg(F.max("running_total_revenue")).first()[0] == 190.0


def test_results_do_not_depend_on_partitioning(make):
    wh = make(
        fact_sales=[sale(v % 7 + 1, f"2024-0{v % 9 + 1}-11", customer=v % 5, product=v % 6 + 1) for v in range(60)],
        dim_customers=[dict(customer_id=c) for c in range(5)],
        dim_products=[dict(product_id=p, category="AB"[p % 2]) for p in range(1, 7)],
    )
    spread = views.Warehouse.of(
        wh.spark, {t: wh.table(t).repartition(7) for t in ("fact_sales", "dim_customers", "dim_products")}
    )
    for plan in (products.q36, customers.q24, customers.q35, sequences.q18, places.q66):
        assert sorted(map(str, plan(wh).collect())) == sorted(map(str, plan(spread).collect()))


def test_category_missing_in_one_month_counts_as_zero(make):
    wh = make(
        dim_products=[dict(product_id=1, category="A"), dict(product_id=2, category="B")],
        fact_sales=[sale(10, "2024-01-10", product=1), sale(8, "2024-02-10", product=2)],
    )
    row = insights.sales_movement(wh).first()
    assert (row.biggest_drag, row.drag_change, row.biggest_lift, row.lift_change) == ("A", -10.0, "B", 8.0)


def test_declining_region_is_empty_when_all_grow(make):
    wh = make(fact_sales=[sale(5, "2023-01-10"), sale(6, "2024-01-10")])
    assert insights.declining_region(wh).count() == 0


def test_sql_functions_are_registered(make):
    wh = make(
        fact_sales=[sale(9, product=1), sale(5, product=2), sale(7, "2024-02-10", product=3)],
        dim_products=[dict(product_id=p, product_name=f"n{p}") for p in (1, 2, 3)],
    )
    views.register_sql(wh, day("2024-12-31"))
    top = wh.spark.sql("SELECT product_id FROM top_products_by_category('A', 2) ORDER BY revenue DESC").collect()
    assert [r.product_id for r in top] == [1, 3]
    growth = wh.spark.sql("SELECT * FROM monthly_growth_pct() ORDER BY month").collect()
    assert [r.growth_pct for r in growth] == [None, -50.0]
    assert wh.spark.sql("SELECT count(*) n FROM vw_product_abc").first().n == 3


def test_r1_keeps_value_of_customers_without_sales(make):
    wh = make(
        dim_customers=[dict(customer_id=1), dict(customer_id=2, lifetime_value=Decimal("77.00"))],
        fact_sales=[sale(12), sale(30)],
    )
    assert rows(views.r1(wh), "customer_id", "lifetime_value") == [(1, Decimal("42.00")), (2, Decimal("77.00"))]


def test_all_equal_values_are_all_platinum(make):
    wh = make(dim_customers=[dict(customer_id=c) for c in range(4)], fact_sales=[sale(5, customer=c) for c in range(4)])
    assert {r.loyalty_tier for r in views.r1(wh).collect()} == {"Platinum"}


def test_r4_unknown_product_keeps_profit(make):
    wh = make(
        fact_sales=[sale(10, product=1, quantity=1, profit=Decimal("0.00")), sale(10, product=9, profit=Decimal("3.33"))]
    )
    assert rows(views.r4(wh), "product_id", "profit") == [(1, Decimal("4.00")), (9, Decimal("3.33"))]


def test_r5_unknown_stock_raises_nothing(make):
    wh = make(fact_inventory=[dict(closing_stock=5), dict(product_id=2, received_stock=None), dict(product_id=3)])
    assert rows(views.r5(wh), "product_id", "expected_stock", "closing_stock") == [(1, 6, 5)]


def test_measures_add_up_over_any_context(make):
    wh = make(
        fact_sales=[sale(v, customer=v % 3, product=v % 2 + 1, sales_channel="Online" if v % 4 else "Offline") for v in range(1, 30)],
        dim_customers=[dict(customer_id=c, segment=("Premium", "New", "Budget")[c]) for c in range(3)],
        dim_products=[dict(product_id=1, category="A"), dict(product_id=2, category="B")],
    )
    whole = measures.base(wh).first().total_revenue
    for by in (["segment"], ["category", "sales_channel"], ["month"], ["customer_id"], ["region"]):
        assert measures.base(wh, by).agg(F.sum("total_revenue")).first()[0] == whole
    assert measures.base(wh).first().distinct_customers == 3


def test_year_to_date_ends_at_the_year_total(make):
    wh = make(fact_sales=[sale(m, f"2023-{m:02d}-03") for m in range(1, 13)] + [sale(5, "2024-01-03")])
    got = {r.month: r.revenue_ytd for r in measures.time_intelligence(wh).collect()}
    assert got[dt.date(2023, 12, 1)] == 78.0 and got[dt.date(2024, 1, 1)] == 5.0


def test_daily_average_skips_days_without_sales(make):
    wh = make(fact_sales=[sale(10, "2024-01-01"), sale(20, "2024-01-05")])
    got = {r.order_date: r.revenue_7_day_moving_avg for r in measures.daily_measures(wh).collect()}
    assert got[day("2024-01-03")] == 10.0 and got[day("2024-01-05")] == 15.0 and len(got) == 5
