"""Answers to the standing business questions I1-I10, as tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.bands import DISCOUNT_LABELS
from tallycart.functions.dates import month_of
from tallycart.functions.numeric import big, count_if, dbl, pct, ratio, rnd
from tallycart.plans.customers import segment_profit
from tallycart.plans.products import banded
from tallycart.plans.rollups import per_customer, per_product, totals
from tallycart.sources.warehouse import Warehouse


def sales_movement(wh: Warehouse, month: dt.date | None = None) -> DataFrame:
    """Last month against the one before, with the category that held it back most and the one that lifted it most.

    Categories that sold in only one of the months count with 0 in the other.
    """
    if month is None:  # one value decides which two month folders are read
        latest = wh.sales.agg(F.max("order_date")).first()[0]
        month = latest.replace(day=1)
    before = (month - dt.timedelta(days=1)).replace(day=1)
    sold = wh.sales_between(before, (month + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1))
    per = (
        totals(sold, "product_id", month_of("order_date").alias("month"))
        .join(wh.products, "product_id")
        .withColumn("now", F.lit(month))
        .withColumn("before", F.lit(before))
    )
    zero = F.lit(0).cast("decimal(32,2)")

    def of(which: str):
        return F.coalesce(F.sum(F.when(F.col("month") == F.col(which), F.col("revenue"))), zero)

    moved = per.groupBy("category", "now", "before").agg(of("now").alias("last"), of("before").alias("prev"))
    change = F.col("last") - F.col("prev")
    low = F.min(F.struct(change.alias("c"), "category"))
    high = F.min(F.struct((-change).alias("c"), "category"))
    row = moved.groupBy("now", "before").agg(
        F.sum("last").alias("last"), F.sum("prev").alias("prev"), low.alias("low"), high.alias("high")
    )
    return row.select(
        F.col("now").alias("last_month"),
        F.col("before").alias("previous_month"),
        dbl("last").alias("last_revenue"),
        dbl("prev").alias("previous_revenue"),
        pct(F.col("last") - F.col("prev"), F.col("prev")).alias("change_pct"),
        F.col("low.category").alias("biggest_drag"),
        dbl("low.c").alias("drag_change"),
        F.col("high.category").alias("biggest_lift"),
        dbl(-F.col("high.c")).alias("lift_change"),
    )


def profitable_segment(wh: Warehouse) -> DataFrame:
    """The segment with most profit and the one with most profit per buyer."""
    rows = segment_profit(wh).select(
        "segment",
        F.col("profit").cast("decimal(32,2)").alias("exact"),
        dbl("profit").alias("profit"),
        big("customers").alias("customers"),
        ratio("profit", "customers").alias("each"),
    )
    by_total = F.min(F.struct((-F.col("exact")).alias("o"), "segment", "profit", "customers", "each")).alias("w")
    by_each = F.min(F.struct((-F.col("each")).alias("o"), "segment", "profit", "customers", "each")).alias("w")
    out = None
    for name, winner in (("total profit", by_total), ("profit per customer", by_each)):
        row = rows.agg(winner).select(
            F.lit(name).alias("criterion"), "w.segment", "w.profit", "w.customers", rnd("w.each").alias("profit_per_customer")
        )
        out = row if out is None else out.unionByName(row)
    return out


def declining_region(wh: Warehouse) -> DataFrame:
    """Steepest fall in the latest year by the sale's own region; no row when none fell."""
    yearly = totals(wh.sales, F.col("sale_region").alias("region"), F.year("order_date").alias("yr"))
    before = F.lag("revenue").over(Window.partitionBy("region").orderBy("yr"))
    latest = wh.sales.agg(F.year(F.max("order_date")).alias("yr"))
    change = F.col("revenue") - F.col("prev")
    return (
        yearly.withColumn("prev", before)
        .join(F.broadcast(latest), "yr")
        .where(change < 0)
        .orderBy(change, "region")
        .limit(1)
        .select(
            "region",
            big("yr").alias("yr"),
            dbl("revenue").alias("revenue"),
            dbl("prev").alias("previous_revenue"),
            dbl(change).alias("yoy_change"),
            pct(change, F.col("prev")).alias("yoy_change_pct"),
        )
    )


def discontinue(wh: Warehouse, min_orders: int = 5, limit: int = 10) -> DataFrame:
    """I4: products that lose money in spite of enough orders, worst first."""
    return (
        per_product(wh)
        .where((F.col("orders") >= min_orders) & (F.col("profit") < 0))
        .orderBy("profit", "product_id")
        .limit(limit)
        .select(
            "product_id", "product_name", "category", big("orders").alias("orders"), dbl("profit").alias("profit")
        )
    )


def replenishment(wh: Warehouse, limit: int = 5) -> DataFrame:
    """Warehouses with most lines at or below the reorder level, beside the network's counts."""
    below = F.col("closing_stock") <= F.col("reorder_level")
    per = wh.inventory.groupBy("warehouse_id").agg(count_if(below).alias("lines_below"), F.count(F.lit(1)).alias("lines"))
    whole = per.agg(F.sum("lines_below").alias("all_below"), F.sum("lines").alias("all_lines"))
    return (
        per.where(F.col("lines_below") > 0)
        .orderBy(F.desc("lines_below"), "warehouse_id")
        .limit(limit)
        .crossJoin(F.broadcast(whole))
        .select("warehouse_id", "lines_below", "all_below", "all_lines", pct("all_below", "all_lines").alias("below_pct"))
    )


def discount_damage(wh: Warehouse, light: str = "0.10", deep: str = "0.25", limit: int = 3) -> DataFrame:
    """Categories with the worst margin in the deepest discount band."""
    return (
        banded(wh, light, deep)
        .where(F.col("discount_band") == DISCOUNT_LABELS[-1])
        .select("category", dbl("revenue").alias("revenue"), pct("profit", "revenue").alias("margin_pct"))
        .orderBy("margin_pct", "category")
        .limit(limit)
    )


def churn_list(wh: Warehouse, days: int = 180) -> DataFrame:
    """Buyers whose last order is ``days`` or more before the last order of all."""
    latest = wh.sales.agg(F.max("order_date").alias("latest"))
    last = wh.sales.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    return (
        last.crossJoin(F.broadcast(latest))
        .withColumn("days_since_last_order", F.datediff("latest", "last_order").cast("bigint"))
        .where(F.col("days_since_last_order") >= days)
        .select("customer_id", "last_order", "days_since_last_order")
    )


def churn_rate(wh: Warehouse, days: int = 180) -> DataFrame:
    """Their number and share of all buyers."""
    buyers = wh.sales.select("customer_id").distinct().agg(F.count(F.lit(1)).alias("customers"))
    risky = churn_list(wh, days).agg(F.count(F.lit(1)).alias("at_risk"))
    return risky.crossJoin(F.broadcast(buyers)).select("at_risk", "customers", pct("at_risk", "customers").alias("at_risk_pct"))


def inventory_advice(wh: Warehouse) -> DataFrame:
    """I8: products that hold stock and sold nothing, and the damage rate of the network."""
    per = wh.inventory.groupBy("product_id").agg(
        *[F.sum(c).alias(c) for c in ("closing_stock", "sold_stock", "damaged_stock", "received_stock")]
    )
    return per.agg(
        count_if((F.col("closing_stock") > 0) & (F.col("sold_stock") == 0)).alias("dead_stock_products"),
        F.sum("damaged_stock").alias("damaged"),
        F.sum("received_stock").alias("received"),
    ).select("dead_stock_products", pct("damaged", "received").alias("damage_rate_pct"))


def marketing(wh: Warehouse) -> DataFrame:
    """Online share by orders and by revenue (two different numbers), and the repeat rate."""
    online = F.col("sales_channel") == "Online"
    per = wh.sales.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        count_if(online).alias("online"),
        F.sum("sales_amount").alias("revenue"),
        F.sum(F.when(online, F.col("sales_amount"))).alias("online_revenue"),
    )
    return per.agg(
        *[F.sum(c).alias(c) for c in ("n", "online", "revenue", "online_revenue")],
        count_if(F.col("n") > 1).alias("again"),
        F.count(F.lit(1)).alias("buyers"),
    ).select(
        pct("online", "n").alias("online_share_of_orders_pct"),
        pct("online_revenue", "revenue").alias("online_share_of_revenue_pct"),
        pct("again", "buyers").alias("repeat_rate_pct"),
    )


def executive(wh: Warehouse) -> DataFrame:
    """Overall margin and return rate."""
    sold = wh.sales.agg(
        F.sum("sales_amount").alias("revenue"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("orders")
    )
    back = wh.returns.agg(F.count(F.lit(1)).alias("returned"))
    return sold.crossJoin(F.broadcast(back)).select(
        dbl("revenue").alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        pct("profit", "revenue").alias("margin_pct"),
        pct("returned", "orders").alias("return_rate_pct"),
    )


def report(wh: Warehouse) -> dict[str, DataFrame]:
    """All insight tables by name, ready for ``loading.write_report``."""
    plans = (
        sales_movement, profitable_segment, declining_region, discontinue, replenishment, discount_damage,
        churn_rate, inventory_advice, marketing, executive,
    )
    return {plan.__name__: plan(wh) for plan in plans}
