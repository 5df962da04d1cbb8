"""Data behind the dashboard pages B1-B7. Every feed takes a Warehouse, so ``sliced`` gives it any page filter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of
from tallycart.functions.numeric import big, count_if, dbl, pct, ratio, rnd
from tallycart.plans import measures
from tallycart.plans.customers import AS_OF, rfm_segments
from tallycart.plans.measures import base, month_rows
from tallycart.plans.products import abc_products
from tallycart.plans.rollups import per_product, refunds_per_order, totals
from tallycart.plans.stock import health, reorder_lines, stock_metrics
from tallycart.sources.warehouse import Warehouse


def sliced(
    wh: Warehouse,
    region: Sequence[str] = (),
    category: Sequence[str] = (),
    channel: Sequence[str] = (),
    tier: Sequence[str] = (),
    segment: Sequence[str] = (),
    country: Sequence[str] = (),
    warehouse: Sequence[int] = (),
    reason: Sequence[str] = (),
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> Warehouse:
    """The same star seen through slicers. A filter on a dimension reaches the facts that point to it, and a filter
    on sales reaches the returns of those sales."""

    def keep(df: DataFrame, **wanted: Sequence) -> DataFrame:
        for column, values in wanted.items():
            if values:
                df = df.where(F.col(column).isin(*values))
        return df

    def follow(fact: DataFrame, key: str, parent: DataFrame, active: bool) -> DataFrame:
        return fact.join(parent.select(key), key, "left_semi") if active else fact

    products = keep(wh.products, category=category)
    customers = keep(wh.customers, loyalty_tier=tier, segment=segment, country=country)
    stores = keep(wh.stores, region=region)
    places = keep(wh.warehouses, warehouse_id=warehouse, region=region)
    sales = keep(wh.sales_between(first, last), sales_channel=channel)
    sales = follow(sales, "product_id", products, bool(category))
    sales = follow(sales, "customer_id", customers, bool(tier or segment or country))
    sales = follow(sales, "store_id", stores, bool(region))
    inventory = follow(wh.inventory, "product_id", products, bool(category))
    inventory = follow(inventory, "warehouse_id", places, bool(warehouse or region))
    on_sales = bool(category or tier or segment or country or region or channel or first or last)
    returns = follow(keep(wh.returns, reason=reason), "order_id", sales, on_sales)
    return Warehouse.of(
        wh.spark,
        {
            "dim_products": products, "dim_customers": customers, "dim_stores": stores, "dim_warehouses": places,
            "fact_sales": sales, "fact_inventory": inventory, "fact_returns": returns,
        },
    )


def detail(wh: Warehouse, entity: str, key: int | str) -> DataFrame:
    """B7 drill-through: the base measures of one product, customer or store, per month."""
    column = {"product": "product_id", "customer": "customer_id", "store": "store_id"}[entity]
    one = {name: wh.table(name) for name in ("dim_products", "dim_customers", "dim_stores", "fact_returns")}
    one["fact_sales"] = wh.sales.where(F.col(column) == F.lit(key))
    return base(Warehouse.of(wh.spark, one), ["month"])


def executive_cards(wh: Warehouse, month: dt.date) -> DataFrame:
    """B1 cards: the four headline numbers with the month-over-month change of ``month``."""
    change = measures.growth(wh).where(F.col("month") == F.lit(month)).select("mom_growth")
    sold = wh.sales.agg(
        F.sum("sales_amount").alias("revenue"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("orders")
    )
    return sold.select(
        dbl("revenue").alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        rnd(ratio("profit", "revenue"), 4).alias("gross_margin"),
        rnd(ratio("revenue", "orders")).alias("average_order_value"),
    ).crossJoin(F.broadcast(change))


def revenue_trend(wh: Warehouse) -> DataFrame:
    """B1 trend line: revenue, profit and revenue to date in the year."""
    year = Window.partitionBy(F.year("month")).orderBy("month")
    return month_rows(wh).select(
        "month",
        dbl("revenue").alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        dbl(F.sum("revenue").over(year)).alias("revenue_ytd"),
    )


def growth_strip(wh: Warehouse, month: dt.date) -> DataFrame:
    """B1 strip: growth at three cadences with its sign."""
    names = ("mom_growth", "qoq_growth", "yoy_growth")
    cells = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("growth")) for n in names])
    rows = measures.growth(wh).where(F.col("month") == F.lit(month)).select(F.explode(cells).alias("c"))
    sign = F.when(F.col("growth") > 0.02, "▲").when(F.col("growth") < -0.02, "▼").otherwise("▬")
    return rows.select("c.measure", "c.growth").withColumn("icon", sign)


def region_against_target(wh: Warehouse, targets: DataFrame) -> DataFrame:
    """B2 bars: revenue per region against the whole target, which knows no regions."""
    goal = targets.agg(F.sum("target_revenue").alias("target"))
    return (
        base(wh, ["region"])
        .select("region", "total_revenue")
        .crossJoin(F.broadcast(goal))
        .select(
            "region",
            "total_revenue",
            rnd(ratio(F.col("total_revenue") - F.col("target"), "target"), 4).alias("revenue_variance_pct_vs_target"),
        )
    )


def revenue_by(wh: Warehouse, attribute: str) -> DataFrame:
    """B2 map and B3 bars: revenue and profit per buyer for one attribute."""
    return base(wh, [attribute]).select(attribute, "total_revenue", "profit_per_customer")


def top_stores(wh: Warehouse, month: dt.date, limit: int = 10) -> DataFrame:
    """B2 table: best stores with dense rank and the change of ``month`` against the month before."""
    stores = totals(wh.sales, "store_id", month_of("order_date").alias("month"))

    def of(day: dt.date) -> Column:
        return F.sum(F.when(F.col("month") == F.lit(day), F.col("revenue")))

    earlier = (month - dt.timedelta(days=1)).replace(day=1)
    best = (
        stores.groupBy("store_id")
        .agg(F.sum("revenue").alias("revenue"), of(month).alias("now"), of(earlier).alias("before"))
        .orderBy(F.desc("revenue"), "store_id")
        .limit(limit)
    )
    return best.select(
        "store_id",
        dbl("revenue").alias("total_revenue"),
        big(F.dense_rank().over(Window.orderBy(F.desc("revenue")))).alias("store_revenue_rank"),
        rnd(ratio(F.col("now") - F.col("before"), "before"), 4).alias("mom_growth"),
    )


MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]  # fixed values


def heatmap(wh: Warehouse) -> DataFrame:
    """B2 matrix: category by month of the year."""
    wide = (
        per_product(wh, F.month("order_date").alias("m"))
        .groupBy("category")
        .pivot("m", list(range(1, 13)))
        .agg(F.sum("revenue"))
    )
    return wide.select("category", *[dbl(str(k + 1)).alias(name) for k, name in enumerate(MONTH_NAMES)])


def channel_trend(wh: Warehouse) -> DataFrame:
    """B2 line: monthly revenue and order value by channel."""
    rows = totals(wh.sales, month_of("order_date").alias("month"), "sales_channel")
    return rows.select(
        "month", "sales_channel", dbl("revenue").alias("total_revenue"),
        rnd(ratio("revenue", "orders")).alias("average_order_value"),
    )


def rfm_points(wh: Warehouse, as_of: dt.date = AS_OF) -> DataFrame:
    """B3 scatter: every buyer's recency, frequency, monetary value and segment."""
    return rfm_segments(wh, as_of).select("customer_id", "recency_days", "frequency", "monetary", "rfm_segment")


def tier_mix(wh: Warehouse) -> DataFrame:
    """B3 donut: buyers per loyalty tier."""
    return base(wh, ["loyalty_tier"]).select("loyalty_tier", "distinct_customers")


def customer_cards(wh: Warehouse, as_of: dt.date, days: int = 180) -> DataFrame:
    """B3 cards: mean lifetime value, repeat rate, customers at risk of churn on ``as_of``."""
    value = wh.customers.agg(
        rnd(ratio(F.sum("lifetime_value"), F.count("lifetime_value"))).alias("average_customer_lifetime_value")
    )
    buyers = wh.sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.max("order_date").alias("seen"))
    rates = buyers.agg(
        rnd(ratio(count_if(F.col("n") > 1), F.count(F.lit(1))), 4).alias("repeat_purchase_rate"),
        count_if(F.col("seen") < F.date_sub(F.lit(as_of), days)).alias("churn_risk_customers"),
    )
    return value.crossJoin(F.broadcast(rates))


def inventory_cards(wh: Warehouse) -> DataFrame:
    """B4 cards and gauge: turnover on closing stock, stockout rate, dead products, mean health score."""
    lines = wh.inventory.agg(
        F.sum("sold_stock").alias("sold"),
        F.sum("closing_stock").alias("closing"),
        F.count("closing_stock").alias("known"),
        count_if(F.col("closing_stock") == 0).alias("empty"),
        F.count(F.lit(1)).alias("lines"),
    )
    dead = measures.dead_stock(wh).agg(count_if(F.col("dead_stock_flag") == "Dead Stock").alias("dead_stock_products"))
    score = health(wh).agg(rnd(F.avg("inventory_health_score"), 1).alias("avg_health_score"))
    return (
        lines.crossJoin(F.broadcast(dead))
        .crossJoin(F.broadcast(score))
        .select(
            rnd(ratio("sold", ratio("closing", "known"))).alias("turnover_ratio_closing"),
            rnd(ratio("empty", "lines"), 4).alias("stockout_rate"),
            "dead_stock_products",
            "avg_health_score",
        )
    )


def reorder_table(wh: Warehouse) -> DataFrame:
    """B4 table: every line at or below its reorder level."""
    stocks = [big(c).alias(c) for c in ("closing_stock", "reorder_level", "lead_time_days")]
    return reorder_lines(wh).select("product_id", "product_name", "warehouse_id", "region", *stocks)


def abc_turnover(wh: Warehouse) -> DataFrame:
    """B4 scatter: ABC class and cumulative share against turnover."""
    turns = stock_metrics(wh).select("product_id", rnd("turnover").alias("turnover_ratio"))
    return abc_products(wh).join(turns, "product_id").select("product_id", "abc_class", "cumulative_pct", "turnover_ratio")


def dead_stock_list(wh: Warehouse) -> DataFrame:
    """B4 table: stocked products that sold nothing, by the money tied up."""
    held = wh.inventory.groupBy("product_id").agg(F.sum("closing_stock").alias("stock"), F.sum("sold_stock").alias("sold"))
    return (
        held.where((F.col("stock") > 0) & (F.col("sold") == 0))
        .join(wh.products.select("product_id", "product_name", "category", "cost_price"), "product_id")
        .select(
            "product_id", "product_name", "category", big("stock").alias("stock_on_hand"),
            dbl(F.col("stock") * F.col("cost_price")).alias("stock_value"),
        )
        .orderBy(F.desc("stock_value"), "product_id")
    )


def returns_cards(wh: Warehouse) -> DataFrame:
    """B5 cards: return rate, refunds and their share of revenue."""
    sold = wh.sales.agg(F.count(F.lit(1)).alias("orders"), F.sum("sales_amount").alias("revenue"))
    back = wh.returns.agg(F.count(F.lit(1)).alias("returned"))
    paid = refunds_per_order(wh).agg(F.sum("refunds").alias("refunds"))
    return (
        sold.crossJoin(F.broadcast(back))
        .crossJoin(F.broadcast(paid))
        .select(
            rnd(ratio("returned", "orders"), 4).alias("return_rate"),
            dbl("refunds").alias("total_refunds"),
            rnd(ratio("refunds", "revenue"), 4).alias("refund_cost_ratio"),
        )
    )


def refunds_by_reason(wh: Warehouse) -> DataFrame:
    """B5 bars: approved and refunded amounts per reason."""
    paid = wh.returns.where(F.col("return_status").isin("Approved", "Refunded"))
    return paid.groupBy("reason").agg(dbl(F.sum("refund_amount")).alias("total_refunds"))


def days_to_return(wh: Warehouse, width: int = 7) -> DataFrame:
    """B5 line: returns per reason in bins of ``width`` days."""
    start = F.floor((F.col("days_after_purchase") - 1) / width) * width + 1
    counts = wh.returns.groupBy("reason", big(start).alias("from_day")).agg(F.count(F.lit(1)).alias("returns"))
    per_reason = Window.partitionBy("reason")
    return counts.withColumn("share_pct", pct(F.col("returns"), F.sum("returns").over(per_reason)))
