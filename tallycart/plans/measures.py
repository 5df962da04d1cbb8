"""Measure library D-01 to D-65.

A measure belongs to a filter context. Here the context is the grain: ``base`` and the time-intelligence functions evaluate
measures for any set of attributes ``by``. Windows range over the numbers of months or days, so that "prior month" means the
calendar month and not the previous row, and contexts with few sales need no calendar of their own. An empty context is NULL, and a division by
zero or by nothing is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of, quarter_of
from tallycart.functions.numeric import big, count_if, dbl, ratio, rnd
from tallycart.operators.ladder import ranked
from tallycart.plans.calendar import KPIS
from tallycart.plans.rollups import money, refunds_per_order
from tallycart.session import staged
from tallycart.sources.warehouse import Warehouse

# Attribute -> (fact key, Warehouse table) for context columns that live in a dimension.
ATTRIBUTES = {
    **{a: ("product_id", "dim_products") for a in ("category", "subcategory", "brand", "supplier")},
    **{a: ("customer_id", "dim_customers") for a in ("segment", "country", "loyalty_tier")},
    "region": ("store_id", "dim_stores"),
}
DATES = {
    "month": lambda: month_of("order_date"),
    "quarter": lambda: quarter_of("order_date"),
    "year": lambda: F.year("order_date"),
}


def in_context(wh: Warehouse, reduced: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the dimension attributes that ``by`` asks for to rows that still carry the fact keys."""
    for key, table in dict.fromkeys(ATTRIBUTES[a] for a in by if a in ATTRIBUTES):
        wanted = [a for a in by if ATTRIBUTES.get(a) == (key, table)]
        reduced = reduced.join(wh.table(table).select(key, *wanted), key)
    return reduced


def fact_keys(by: Sequence[str]) -> list[Column]:
    """Fact-side grouping columns that are enough to reach every attribute in ``by``."""
    keys = dict.fromkeys(ATTRIBUTES[a][0] if a in ATTRIBUTES else a for a in by)
    return [DATES[k]().alias(k) if k in DATES else F.col(k) for k in keys]


def base(wh: Warehouse, by: Sequence[str] = ()) -> DataFrame:
    """D-01 to D-13 for any context: revenue, profit, orders, units, customers, averages, refunds and margins."""
    by = list(by)
    keys = fact_keys([*by, "customer_id"])
    per_buyer = wh.sales.groupBy(*keys).agg(*money())
    context = [b for b in by if b != "customer_id"]
    sold = (
        in_context(wh, per_buyer, by)
        .groupBy(*context, "customer_id")
        .agg(*[F.sum(c).alias(c) for c in ("revenue", "profit", "orders", "units", "discounts")])
        .groupBy(*by)
        .agg(
            *[F.sum(c).alias(c) for c in ("revenue", "profit", "orders", "units", "discounts")],
            F.count(F.lit(1)).alias("customers"),
        )
    )
    paid = refunds_per_order(wh).join(wh.sales, "order_id").groupBy(*fact_keys(by)).agg(F.sum("refunds").alias("refunds"))
    refunds = in_context(wh, paid, by).groupBy(*by).agg(F.sum("refunds").alias("refunds"))
    return base_of(sold.join(refunds, by, "left") if by else sold.crossJoin(F.broadcast(refunds)), by)


def base_of(both: DataFrame, by: Sequence[str]) -> DataFrame:
    """The base measures of rows with their sums and number of customers."""
    net = F.col("profit") - F.coalesce("refunds", F.lit(0))
    return both.select(
        *by,
        dbl("revenue").alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        big("orders").alias("total_orders"),
        big("units").alias("total_units_sold"),
        big("customers").alias("distinct_customers"),
        rnd(ratio("revenue", "orders")).alias("average_order_value"),
        rnd(ratio("discounts", "orders"), 4).alias("average_discount"),
        dbl("refunds").alias("total_refunds"),
        rnd(ratio("profit", "revenue"), 4).alias("gross_margin"),
        dbl(net).alias("net_profit"),
        rnd(ratio(net, "revenue"), 4).alias("net_margin"),
        rnd(ratio("profit", "customers")).alias("profit_per_customer"),
        rnd(ratio("profit", "orders")).alias("profit_per_order"),
    )


def month_rows(wh: Warehouse, by: Sequence[str] = (), gaps: bool = True) -> DataFrame:
    """A row per context and month with revenue, profit, orders and days_sold (days with sales). With ``gaps`` a context has
    a row for every month from its first sale to the last month of all sales, empty where it sold nothing.

    Days are marked as bits of a month, so that the fact is reduced to months at once."""
    marked = wh.sales.groupBy(*fact_keys([*by, "month"])).agg(*money(), F.expr("bit_or(1L << dayofmonth(order_date))").alias("days"))
    sums = [F.sum(c).alias(c) for c in ("revenue", "profit", "orders")]
    months = in_context(wh, marked, by).groupBy(*by, "month").agg(*sums, F.bit_count(F.bit_or("days")).cast("long").alias("days_sold"))
    return _without_gaps(months, by, "month", "month") if gaps else months


def _without_gaps(rows: DataFrame, by: Sequence[str], at: str, unit: str) -> DataFrame:
    """Every row repeated up to the one after it in its context (or to the last date of all rows), without its values. No
    calendar is joined: the work is that of the rows that come out."""
    step = F.expr(f"interval 1 {unit}")
    rows = staged(rows, "context-rows")
    until = F.coalesce(F.lead(at).over(Window.partitionBy(*by).orderBy(at)) - step, F.col("_end")).cast("date")
    spread = rows.crossJoin(F.broadcast(rows.agg(F.max(at).alias("_end")))).withColumn("_until", until)
    spread = spread.withColumn("_at", F.explode(F.sequence(F.col(at), F.col("_until"), step)))
    values = [F.when(F.col("_at") == F.col(at), F.col(c)).alias(c) for c in rows.columns if c not in (*by, at)]
    return spread.select(*by, F.col("_at").alias(at), *values)


class Months:
    """Windows over months of a context by RANGE of the month's number, so that a missing row is a month without sales.
    Their size is that of a calendar, not of the data."""

    def __init__(self, by: Sequence[str]):
        self.by = by
        self.number = F.year("month") * 12 + F.month("month")
        self.along = Window.partitionBy(*by).orderBy(self.number)

    def last(self, months: int, back: int = 0) -> Window:
        return self.along.rangeBetween(1 - months - back, -back)

    def back(self, column: str, months: int) -> Column:
        """The value of the month so many months ago."""
        return F.max(column).over(self.last(1, months))

    def to_date(self, column: str, months: int = 12, back: int = 0) -> Column:
        """The sum from the start of the year (3: quarter) to this month, or the one so many months ago."""
        place = (F.month("month") - 1) % months
        return F.coalesce(*(F.when(place == k, F.sum(column).over(self.last(k + 1, back))) for k in range(months)))


def _growth(now: Column, before: Column) -> Column:
    return rnd(ratio(now - before, before), 4)


def time_intelligence(wh: Warehouse, by: Sequence[str] = (), gaps: bool = True) -> DataFrame:
    """D-14, D-15, D-17 to D-22 per context and month; see ``month_rows`` for ``gaps``."""
    m = Months(by)
    running = m.along.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return month_rows(wh, by, gaps).select(
        *by,
        "month",
        dbl(F.sum("revenue").over(running)).alias("running_total_revenue"),
        dbl(m.to_date("revenue")).alias("revenue_ytd"),
        dbl(m.to_date("revenue", 3)).alias("revenue_qtd"),
        dbl(m.to_date("profit")).alias("profit_ytd"),
        dbl(F.sum("revenue").over(m.last(12))).alias("rolling_12_month_revenue"),
        dbl(F.sum("revenue").over(m.last(3))).alias("rolling_3_month_revenue"),
        dbl(m.back("revenue", 12)).alias("prior_year_revenue"),
        dbl(m.to_date("revenue", back=12)).alias("prior_year_revenue_ytd"),
    )


def daily_measures(wh: Warehouse, by: Sequence[str] = (), gaps: bool = True) -> DataFrame:
    """D-16 month to date and D-24 mean of the last seven calendar days, days without sales left out of the mean, per context
    and day. With ``gaps`` a context's days without sales have rows too."""
    sold = in_context(wh, wh.sales.groupBy(*fact_keys([*by, "order_date"])).agg(F.sum("sales_amount").alias("revenue")), by)
    rows = sold.groupBy(*by, "order_date").agg(F.sum("revenue").alias("revenue"))
    rows = _without_gaps(rows, by, "order_date", "day") if gaps else rows
    week = Window.partitionBy(*by).orderBy(F.unix_date("order_date")).rangeBetween(-6, Window.currentRow)
    month = Window.partitionBy(*by, month_of("order_date")).orderBy("order_date")
    return rows.select(
        *by,
        "order_date",
        dbl("revenue").alias("total_revenue"),
        dbl(F.sum("revenue").over(month)).alias("revenue_mtd"),
        rnd(ratio(F.sum("revenue").over(week), F.count("revenue").over(week))).alias("revenue_7_day_moving_avg"),
    )


def moving_averages(wh: Warehouse, by: Sequence[str] = (), gaps: bool = True) -> DataFrame:
    """D-23 and D-25: mean of the daily totals over three months; and the mean of the monthly totals beside it."""
    quarter = Months(by).last(3)
    days = F.sum("days_sold").over(quarter)
    return month_rows(wh, by, gaps).select(
        *by,
        "month",
        dbl("revenue").alias("total_revenue"),
        rnd(ratio(F.sum("revenue").over(quarter), days)).alias("revenue_3_month_moving_avg"),
        rnd(ratio(F.sum("orders").over(quarter), days)).alias("orders_3_month_moving_avg"),
        rnd(ratio(F.sum("revenue").over(quarter), F.count("revenue").over(quarter))).alias("monthly_3_month_moving_avg"),
    )


def growth(wh: Warehouse, by: Sequence[str] = (), gaps: bool = True) -> DataFrame:
    """D-26 to D-32 per context and month; the prior quarter of a month is the same month one quarter back."""
    m = Months(by)
    now = F.col("revenue")
    return month_rows(wh, by, gaps).select(
        *by,
        "month",
        dbl("revenue").alias("total_revenue"),
        dbl(m.back("revenue", 1)).alias("revenue_prior_month"),
        _growth(now, m.back("revenue", 1)).alias("mom_growth"),
        dbl(m.back("revenue", 3)).alias("revenue_prior_quarter"),
        _growth(now, m.back("revenue", 3)).alias("qoq_growth"),
        _growth(now, m.back("revenue", 12)).alias("yoy_growth"),
        _growth(m.to_date("revenue"), m.to_date("revenue", back=12)).alias("yoy_growth_ytd"),
        _growth(F.col("profit"), m.back("profit", 12)).alias("profit_yoy_growth"),
    )


def quarter_growth(wh: Warehouse, by: Sequence[str] = ()) -> DataFrame:
    """D-28 and D-29 per context and quarter with sales; the prior quarter is the calendar's."""
    months = month_rows(wh, by, gaps=False)
    quarters = months.groupBy(*by, quarter_of("month").alias("quarter")).agg(F.sum("revenue").alias("revenue"))
    number = F.year("quarter") * 4 + F.quarter("quarter")
    before = F.max("revenue").over(Window.partitionBy(*by).orderBy(number).rangeBetween(-1, -1))
    return quarters.select(
        *by,
        "quarter",
        dbl("revenue").alias("total_revenue"),
        dbl(before).alias("revenue_prior_quarter"),
        _growth(F.col("revenue"), before).alias("qoq_growth"),
    )


def _valued(wh: Warehouse, dimension: DataFrame, key: str) -> DataFrame:
    """Revenue per member of a dimension, 0 for members without sales."""
    sold = wh.sales.groupBy(key).agg(F.sum("sales_amount").alias("revenue"))
    return dimension.select(key).join(sold, key, "left").select(
        key, F.coalesce("revenue", F.lit(0)).cast("decimal(22,2)").alias("revenue")
    )


def product_rank(wh: Warehouse) -> DataFrame:
    """D-33 dense revenue rank over all products and D-37 top-ten flag."""
    return ranked(_valued(wh, wh.products, "product_id"), "product_id", "revenue").select(
        "product_id",
        dbl("revenue").alias("total_revenue"),
        big("level").alias("product_revenue_rank"),
        F.when(F.col("level") <= 10, "Top 10").otherwise("Other").alias("is_top_10_product"),
    )


def customer_rank(wh: Warehouse) -> DataFrame:
    """D-34 dense rank of all customers by revenue."""
    return ranked(_valued(wh, wh.customers, "customer_id"), "customer_id", "revenue").select(
        "customer_id", dbl("revenue").alias("total_revenue"), big("level").alias("customer_ltv_rank")
    )


def store_rank(wh: Warehouse) -> DataFrame:
    """D-35 dense rank of all stores by revenue."""
    return ranked(_valued(wh, wh.stores, "store_id"), "store_id", "revenue").select(
        "store_id", dbl("revenue").alias("total_revenue"), big("level").alias("store_revenue_rank")
    )


def category_rank(wh: Warehouse) -> DataFrame:
    """D-36 dense rank of the categories by profit (a short list)."""
    sold = wh.sales.groupBy("product_id").agg(F.sum("profit").alias("profit"))
    profit = (
        wh.products.select("product_id", "category")
        .join(sold, "product_id", "left")
        .groupBy("category")
        .agg(F.coalesce(F.sum("profit"), F.lit(0)).alias("profit"))
    )
    return profit.select(
        "category",
        dbl("profit").alias("total_profit"),
        big(F.dense_rank().over(Window.orderBy(F.desc("profit")))).alias("category_profit_rank"),
    )


def kpi_columns() -> dict[str, Column]:
    values = ("total_revenue", "total_profit", "total_orders", "gross_margin", "average_order_value")
    return {kpi: dbl(value) for kpi, value in zip(KPIS, values)}


def kpi_long(wh: Warehouse, by: Sequence[str] = ("month",)) -> DataFrame:
    """D-38 unpivoted: one row per context and KPI name."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kpi_name"), v.alias("kpi_value")) for k, v in kpi_columns().items()])
    return base(wh, by).select(*by, F.explode(pairs).alias("p")).select(*by, "p.kpi_name", "p.kpi_value")


def selected_kpi(wh: Warehouse, kpi: str | None = None, by: Sequence[str] = ("month",)) -> DataFrame:
    """D-38 the chosen KPI, revenue when none or an unknown one is chosen."""
    columns = kpi_columns()
    return base(wh, by).select(*by, columns.get(kpi or "", columns["Revenue"]).alias("selected_kpi_value"))


def flags(wh: Warehouse, by: Sequence[str] = (), gaps: bool = True) -> DataFrame:
    """D-43 margin health, D-44 growth sign, D-46 revenue against the trailing mean of daily totals, per context and month."""
    m = Months(by)
    days = F.sum("days_sold").over(m.last(3))
    before = m.back("revenue", 1)
    rows = month_rows(wh, by, gaps).select(
        *by,
        "month",
        ratio("profit", "revenue").alias("margin"),
        ratio(F.col("revenue") - before, before).alias("mom"),
        dbl("revenue").alias("revenue"),
        ratio(F.sum("revenue").over(m.last(3)), days).alias("trailing"),
    )
    return rows.select(
        *by,
        "month",
        F.when(F.col("margin") >= 0.20, "Healthy").when(F.col("margin") >= 0.10, "Watch").otherwise("At Risk")
        .alias("margin_health_flag"),
        F.when(F.col("mom") > 0.02, "▲").when(F.col("mom") < -0.02, "▼").otherwise("▬").alias("growth_trend_icon"),
        F.when(F.coalesce("revenue", F.lit(0.0)) >= F.coalesce("trailing", F.lit(0.0)), "Above Trend")
        .otherwise("Below Trend").alias("above_or_below_trailing_average"),
    )


def variance(wh: Warehouse, targets: DataFrame) -> DataFrame:
    """D-47 to D-50 per month of the targets table."""
    gap = F.coalesce(dbl("revenue"), F.lit(0.0)) - F.col("target_revenue")
    share = ratio(gap, "target_revenue")
    return targets.join(month_rows(wh), "month", "left").select(
        "month",
        "target_revenue",
        rnd(gap).alias("revenue_variance_vs_target"),
        rnd(share, 4).alias("revenue_variance_pct_vs_target"),
        F.when(share >= 0, "On/Above Target").when(share >= -0.05, "Slightly Below").otherwise("Materially Below")
        .alias("variance_status"),
    )


def forecast_compare(wh: Warehouse, forecast: DataFrame) -> DataFrame:
    """D-51 to D-56 per forecast month; ``forecast`` has the columns of the stored forecast file."""
    actual = F.coalesce(dbl("revenue"), F.lit(0.0))
    planned = forecast.groupBy(F.col("Month").alias("month")).agg(
        F.sum("Forecasted_Revenue").alias("forecasted_revenue"),
        F.sum("Lower_95CI").alias("forecast_lower_bound"),
        F.sum("Upper_95CI").alias("forecast_upper_bound"),
    )
    gap = actual - F.col("forecasted_revenue")
    inside = (actual >= F.col("forecast_lower_bound")) & (actual <= F.col("forecast_upper_bound"))
    return planned.join(month_rows(wh), "month", "left").select(
        "month",
        rnd("forecasted_revenue").alias("forecasted_revenue"),
        rnd("forecast_lower_bound").alias("forecast_lower_bound"),
        rnd("forecast_upper_bound").alias("forecast_upper_bound"),
        rnd(gap).alias("actual_vs_forecast_variance"),
        rnd(ratio(gap, "forecasted_revenue"), 4).alias("actual_vs_forecast_variance_pct"),
        F.when(inside, "Within Range").otherwise("Outside Range").alias("is_actuals_within_forecast_ci"),
    )


def customer_measures(wh: Warehouse) -> DataFrame:
    """D-57 repeat rate, D-58 mean lifetime value, D-59 return rate and D-60 refund ratio per month of sale."""
    buyers = (
        wh.sales.groupBy(month_of("order_date").alias("month"), "customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("sales_amount").alias("revenue"))
        .groupBy("month")
        .agg(
            F.sum("n").alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.count(F.lit(1)).alias("customers"),
            count_if(F.col("n") > 1).alias("repeaters"),
        )
    )
    paid = F.col("return_status").isin("Approved", "Refunded")
    back = (
        wh.returns.join(wh.sales.select("order_id", "order_date"), "order_id")
        .groupBy(month_of("order_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("returns"), F.sum(F.when(paid, F.col("refund_amount"))).alias("refunds"))
    )
    value = wh.customers.agg(rnd(ratio(F.sum("lifetime_value"), F.count("lifetime_value"))).alias("ltv"))
    return (
        buyers.join(back, "month", "left")
        .crossJoin(F.broadcast(value))
        .select(
            "month",
            rnd(ratio("repeaters", "customers"), 4).alias("repeat_purchase_rate"),
            F.col("ltv").alias("average_customer_lifetime_value"),
            rnd(ratio("returns", "orders"), 4).alias("return_rate"),
            rnd(ratio("refunds", "revenue"), 4).alias("refund_cost_ratio"),
        )
    )


def inventory_measures(wh: Warehouse) -> DataFrame:
    """D-61 turnover on closing stock and D-62 stockout rate per category."""
    lines = wh.inventory.groupBy("product_id").agg(
        F.sum("sold_stock").alias("sold"),
        F.sum("closing_stock").alias("closing"),
        F.count("closing_stock").alias("known"),
        count_if(F.col("closing_stock") == 0).alias("empty"),
        F.count(F.lit(1)).alias("lines"),
    )
    return (
        lines.join(wh.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in ("sold", "closing", "known", "empty", "lines")])
        .select(
            "category",
            rnd(ratio("sold", ratio("closing", "known"))).alias("turnover_ratio_closing"),
            rnd(ratio("empty", "lines"), 4).alias("stockout_rate"),
        )
    )


def dead_stock(wh: Warehouse) -> DataFrame:
    """D-63 flag per stocked product."""
    return wh.inventory.groupBy("product_id").agg(
        F.when((F.sum("closing_stock") > 0) & (F.sum("sold_stock") == 0), "Dead Stock")
        .otherwise("Active")
        .alias("dead_stock_flag")
    )


def churn_by_year(wh: Warehouse, days: int = 180) -> DataFrame:
    """D-64 in the context of each year: buyers of the year whose last order in it lies ``days`` before its end."""
    last = wh.sales.groupBy(F.year("order_date").alias("year"), "customer_id").agg(F.max("order_date").alias("seen"))
    closes = F.make_date("year", F.lit(12), F.lit(31))
    return last.groupBy(big("year").alias("year")).agg(
        count_if(F.col("seen") < F.date_sub(closes, days)).alias("churn_risk_customers"),
        F.count(F.lit(1)).alias("distinct_customers"),
    )


def refunds_by_return_month(wh: Warehouse) -> DataFrame:
    """D-65 approved and refunded amounts by the month of the return, the inactive date relationship."""
    paid = wh.returns.where(F.col("return_status").isin("Approved", "Refunded"))
    return paid.groupBy(month_of("return_date").alias("month")).agg(
        dbl(F.sum("refund_amount")).alias("refunds_by_return_date")
    )

