
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.functions.numeric import dbl, rnd
from tallycart.plans import (
    calendar, cube, customers, extract_checks, feeds, forecasting, insights, kpis, measures, places, products, returns, sequences,
    statistics, stock, views,
)
from tallycart.sources.warehouse import Warehouse
from tallycart.streaming import checks

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 8, 1)
FIRST_MONTH, LAST_MONTH = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
LAST_FULL_MONTH = dt.date(2001, 7, 1)
LAUNCH_CUT = dt.date(2000, 1, 1)
BANDS = {"light": "0.03", "deep": "0.07"}

QUERIES: dict[str, Query] = {}


def on_star(name: str, plan: Callable[..., DataFrame], **params) -> None:
    """Register a plan over the derived star schema."""
    QUERIES[name] = lambda spark, sf_dir: plan(Warehouse.open(spark, sf_dir), **params)


PARAMS = {
    "q24": {"as_of": AS_OF},
    "q29": {"as_of": AS_OF},
    "q31": {"cuts": (1000000, 700000)},
    "q42": BANDS,
    "q43": {"since": LAUNCH_CUT},
    "q64": {"first": FIRST_MONTH, "last": LAST_MONTH},
}
for module in (kpis, sequences, customers, products, stock, returns, places):
    for name in sorted(n for n in vars(module) if n[0] == "q" and n[1:3].isdigit()):
        on_star(name, getattr(module, name), **PARAMS.get(name, {}))
on_star("q33_full_month", customers.q33, month=LAST_FULL_MONTH)


def _reset_then_refresh(wh: Warehouse) -> DataFrame:
    """R1 on customers whose stored values were all set to one amount: buyers change, the others keep it."""
    reset = wh.customers.withColumn("lifetime_value", F.lit(1000000).cast("decimal(14,2)"))
    tables = {"dim_customers": reset, "fact_sales": wh.sales}
    return views.r1(Warehouse.of(wh.spark, tables)).select("customer_id", dbl("lifetime_value").alias("lifetime_value"), "loyalty_tier")


def _profit_restored(wh: Warehouse) -> DataFrame:
    """R4 on sales whose profit was blanked, summed per channel."""
    blank = wh.sales.withColumn("profit", F.lit(0).cast("decimal(12,2)"))
    fixed = views.r4(Warehouse.of(wh.spark, {"fact_sales": blank, "dim_products": wh.products}))
    return fixed.groupBy("sales_channel").agg(
        F.count(F.lit(1)).alias("orders"),
        dbl(F.sum("profit")).alias("profit"),
        dbl(F.min("profit")).alias("least"),
        dbl(F.max("profit")).alias("most"),
    )


on_star("v1_monthly_kpis", views.v1)
on_star("v2_customer_rfm", views.v2, as_of=AS_OF)
on_star("v3_product_abc", views.v3)
on_star("v4_inventory_health", views.v4)
on_star("v1_after_loads", lambda wh: extract_checks.refreshed(wh).v1())
on_star("v2_after_loads", lambda wh: extract_checks.refreshed(wh).v2(AS_OF))
on_star("v3_after_loads", lambda wh: extract_checks.refreshed(wh).v3())
on_star("v4_after_loads", lambda wh: extract_checks.refreshed(wh).v4())
on_star("r1_refresh_customer_ltv", _reset_then_refresh)
on_star("r2_top_products_by_category", views.r2, category="ECONOMY")
on_star("r3_monthly_growth", views.r3)
on_star("r4_profit_recomputed", _profit_restored)
on_star("r5_stock_mismatches", views.r5)
on_star("g1_revenue_in_range", views.g1, first=dt.date(2000, 11, 1), last=dt.date(2000, 12, 31))
on_star("g2_revenue_of_category", views.g2, category="ECONOMY")
on_star("g3_revenue_by_store_since", views.g3, since=LAUNCH_CUT)

for name, plan in {
    "s1_csv_extracts": extract_checks.s1,
    "s2_csv_corrupt_rows": extract_checks.s2,
    "s3_csv_unquoted": extract_checks.s3,
    "s4_csv_folder": extract_checks.s4,
    "s5_idempotent_load": extract_checks.s5,
    "s6_csv_sink": extract_checks.s6,
    "c1_clean_customers": extract_checks.c1,
    "c2_clean_products": extract_checks.c2,
    "c3_clean_sales": extract_checks.c3,
    "c4_clean_inventory": extract_checks.c4,
    "c5_clean_returns": extract_checks.c5,
    "c6_derive_stores": extract_checks.c6,
    "c7_derive_warehouses": extract_checks.c7,
    "c8_refresh_ltv": extract_checks.c8,
    "c10_rules_before_cleaning": extract_checks.c10,
    "c10_rules_after_cleaning": extract_checks.c10_clean,
    "c11_sanity": extract_checks.c11,
}.items():
    on_star(name, plan)

FORECAST_FROM = dt.date(2000, 7, 1)  # last month the comparison forecast may see

on_star("k1_dim_date", calendar.dated_orders)
on_star("d_base_margin", measures.base, by=["month"])
on_star("d_base_total", measures.base)
on_star("d_base_region_category", measures.base, by=["region", "category"])
on_star("d_base_segment_channel", measures.base, by=["segment", "sales_channel"])
on_star("d_time_intelligence", measures.time_intelligence)
on_star("d_daily", measures.daily_measures)
on_star("d_moving_avg", measures.moving_averages)
on_star("d_growth", measures.growth)
on_star("d_growth_quarter", measures.quarter_growth)
for context in (["region"], ["category", "sales_channel"]):
    own = "_".join(c.removeprefix("sales_") for c in context)
    on_star(f"d_time_{own}", measures.time_intelligence, by=context)
    on_star(f"d_growth_{own}", measures.growth, by=context)
    on_star(f"d_moving_avg_{own}", measures.moving_averages, by=context)
    on_star(f"d_daily_{own}", measures.daily_measures, by=context)
    on_star(f"d_growth_quarter_{own}", measures.quarter_growth, by=context)
    on_star(f"d_flags_{own}", measures.flags, by=context)
# few sales in each context: months between them are empty
on_star("d_time_subcategory_segment", measures.time_intelligence, by=["subcategory", "segment", "region"])
on_star("d_time_subcategory_segment_sold", measures.time_intelligence, by=["subcategory", "segment", "region"], gaps=False)
on_star("d_rank_product", measures.product_rank)
on_star("d_rank_customer", measures.customer_rank)
on_star("d_rank_store", measures.store_rank)
on_star("d_rank_category", measures.category_rank)
on_star("d_kpi_switch", measures.kpi_long)
on_star("d_kpi_selected", measures.selected_kpi, kpi="Margin %")
on_star("d_flags", measures.flags)
on_star("d_variance", lambda wh: measures.variance(wh, calendar.sample_targets(wh.spark, FIRST_MONTH, LAST_MONTH)))
on_star(
    "d_forecast_compare",
    lambda wh: measures.forecast_compare(wh, forecasting.total_outlook(wh, FORECAST_FROM)),
)
on_star("d_customer_returns", measures.customer_measures)
on_star("d_inventory", measures.inventory_measures)
on_star("d_dead_stock", measures.dead_stock)
on_star("d_churn_by_year", measures.churn_by_year)
on_star("d_refunds_by_return_month", measures.refunds_by_return_month)


def _total_and(plan: Callable[..., DataFrame], by: str) -> Callable[[Warehouse], DataFrame]:
    """A per-series plan for the total series and one series per attribute value, complete months only."""
    return lambda wh: plan(wh, by=[by], last=LAST_FULL_MONTH, with_total=True)


on_star("m0_features", statistics.feature_profile)
on_star("m1_correlations", statistics.correlations)
on_star("m2_regression", statistics.regression)
on_star("m3_channel_test", statistics.channel_test)
on_star("m4_mean_interval", statistics.mean_interval)
on_star("m5_segment_anova", statistics.segment_anova)
on_star("m6_rfm_features", statistics.rfm_features)
on_star("m6_cluster_profile", statistics.cluster_profile)
on_star("m7_outliers", statistics.outliers)
on_star("m7_outliers_tight", statistics.outliers, fence=0.4, deviations=1.75)  # the fixture's amounts lie inside the usual fences
on_star("m7_outlier_summary", statistics.outlier_summary)
on_star("m8_importance", statistics.importance)
on_star("m11_price_elasticity", statistics.price_elasticity)
on_star("m12_churn_propensity", statistics.churn_propensity, cut=dt.date(2000, 12, 31))
on_star("m9_trend", _total_and(statistics.trend, "category"))
on_star("m10_decomposition", _total_and(statistics.decomposition, "category"))
on_star("m10_seasonality", _total_and(statistics.seasonality, "category"))

on_star("i1_sales_movement", insights.sales_movement, month=LAST_FULL_MONTH)
on_star("i2_profitable_segment", insights.profitable_segment)
on_star("i3_declining_region", insights.declining_region)
on_star("i4_discontinue", insights.discontinue)
on_star("i5_replenishment", insights.replenishment)
on_star("i6_discount_damage", insights.discount_damage, **BANDS)
on_star("i7_churn_list", insights.churn_list)
on_star("i7_churn_rate", insights.churn_rate)
on_star("i8_inventory_advice", insights.inventory_advice)
on_star("i9_marketing", insights.marketing)
on_star("i10_executive", insights.executive)

on_star("b1_cards", feeds.executive_cards, month=LAST_FULL_MONTH)
on_star("b1_trend", feeds.revenue_trend)
QUERIES["b1_forecast"] = QUERIES["d_forecast_compare"]
on_star("b1_category_share", products.q38)
on_star("b1_growth_strip", feeds.growth_strip, month=LAST_FULL_MONTH)
on_star(
    "b2_region_target",
    lambda wh: feeds.region_against_target(wh, calendar.sample_targets(wh.spark, FIRST_MONTH, LAST_MONTH)),
)
on_star("b2_country", feeds.revenue_by, attribute="country")
on_star("b2_top_stores", feeds.top_stores, month=LAST_FULL_MONTH)
on_star("b2_heatmap", feeds.heatmap)
on_star("b2_channel_trend", feeds.channel_trend)
on_star("b3_rfm_points", feeds.rfm_points, as_of=AS_OF)
on_star("b3_tier_mix", feeds.tier_mix)
on_star("b3_cards", feeds.customer_cards, as_of=AS_OF)
on_star("b3_cohorts", customers.q28)
on_star("b3_top_customers", customers.q35)
on_star("b3_segments", feeds.revenue_by, attribute="segment")
on_star("b4_cards", feeds.inventory_cards)
on_star("b4_reorder", feeds.reorder_table)
on_star("b4_stockouts", stock.q50)
on_star("b4_abc_turnover", feeds.abc_turnover)
on_star("b4_dead_stock", feeds.dead_stock_list)
on_star("b5_cards", feeds.returns_cards)
on_star("b5_refunds_by_reason", feeds.refunds_by_reason)
on_star("b5_return_rates", returns.q56)
on_star("b5_problem_products", returns.q57)
on_star("b5_status_funnel", returns.q58)
on_star("b5_days_to_return", feeds.days_to_return)
on_star("b6_seasonal_index", _total_and(statistics.seasonal_index, "category"))
SLICE = {
    "region": ["ASIA", "EUROPE"], "category": ["ECONOMY"], "channel": ["Online"], "segment": ["Premium", "New"],
    "first": dt.date(1998, 1, 15), "last": dt.date(2000, 6, 30),
}
on_star("b7_sliced_sales", lambda wh: measures.base(feeds.sliced(wh, **SLICE)))
# the same questions answered from stored cuboids
on_star("b7_cube_region_category", lambda wh: cube.cube_of(wh).answer(["region", "category"]))
on_star("b7_cube_total", lambda wh: cube.cube_of(wh).answer())
on_star("b7_cube_segment_channel", lambda wh: cube.cube_of(wh).answer(["segment", "sales_channel"]))
on_star(
    "b7_cube_sliced_months",
    lambda wh: cube.cube_of(wh).answer(["month"], region=["ASIA", "EUROPE"], category=["ECONOMY"], sales_channel=["Online"], segment=["Premium", "New"]),
)
on_star("b7_cube_tiers", lambda wh: cube.cube_of(wh).answer(["loyalty_tier", "category"], country=["ASIA", "AFRICA"]))
on_star("b7_sliced_inventory", lambda wh: stock.q50(feeds.sliced(wh, warehouse=[3, 7, 11], category=["ECONOMY"])))
on_star(
    "b7_sliced_returns",
    lambda wh: returns.q58(feeds.sliced(wh, reason=["Late Delivery", "Changed Mind"], category=["ECONOMY"])),
)
on_star("b7_product_detail", feeds.detail, entity="product", key=17)
on_star("b7_customer_detail", feeds.detail, entity="customer", key=101)
on_star("b7_store_detail", feeds.detail, entity="store", key=9)


def _panel(wh: Warehouse) -> DataFrame:
    return forecasting.panel(wh, ["category"], LAST_FULL_MONTH)


def _fits(model: str) -> Callable[[Warehouse], DataFrame]:
    """Forecasts of one model for the panel."""


    def plan(wh: Warehouse) -> DataFrame:
        return forecasting.MODELS[model](_panel(wh)).select("series", "month", *[rnd(c).alias(c) for c in ("forecast", "lower", "upper")])

    return plan


def _holdout_errors(wh: Warehouse) -> DataFrame:
    train, test = forecasting.holdout(_panel(wh))
    errors = forecasting.metrics(forecasting.moving_average(train).join(test, ["series", "month"]), "series")
    return errors.select("series", rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), rnd("mape", 4).alias("mape"))


on_star("e0_series", lambda wh: _panel(wh).select("series", "month", rnd("revenue").alias("revenue")))
on_star("e1_metrics", _holdout_errors)
on_star(
    "e2_moving_average",
    lambda wh: forecasting.moving_average(_panel(wh)).select("series", "month", rnd("forecast").alias("forecast")),
)
on_star("e3_holt_winters", _fits(forecasting.SMOOTHING))
on_star("e4_arima", _fits(forecasting.ARIMA))
on_star("e5_sarima", _fits(forecasting.SARIMA))
on_star("e6_trend_and_season", _fits(forecasting.LOG_LINEAR))
on_star("e7_scorecard", lambda wh: forecasting.scorecard(_panel(wh)))
on_star("e8_outlook", lambda wh: forecasting.outlook(_panel(wh)))
on_star("s10_forecast_csv", extract_checks.s10, last=FORECAST_FROM)
on_star("b6_outlook", lambda wh: forecasting.outlook_with_history(_panel(wh)))

on_star("x1_clean_orders", checks.x1)
on_star("x2_stock_alerts", checks.x2)
on_star("x3_customer_value", checks.x3)
on_star("x4_daily_revenue", checks.x4)
on_star("x5_sliding_revenue", checks.x5)
