"""Ranking, running and neighbour reports Q16-Q23."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.numeric import big, dbl, pct, ratio, rnd
from tallycart.operators.ladder import ladder, ranked
from tallycart.plans.rollups import customer_months, daily, per_product, product_revenue
from tallycart.sources.warehouse import Warehouse


def q16(wh: Warehouse) -> DataFrame:
    """Q16 running total of daily revenue (one row per calendar day)."""
    return (
        daily(wh)
        .select(
            "order_date",
            dbl("revenue").alias("daily_revenue"),
            dbl(F.sum("revenue").over(Window.orderBy("order_date"))).alias("running_total_revenue"),
        )
        .orderBy("order_date")
    )


def q17(wh: Warehouse, days: int = 7) -> DataFrame:
    """Q17 average over the last seven days that have sales (rows, not calendar days)."""
    last = Window.orderBy("order_date").rowsBetween(1 - days, Window.currentRow)
    return (
        daily(wh)
        .select(
            "order_date",
            dbl("revenue").alias("revenue"),
            rnd(ratio(F.sum("revenue").over(last), F.count("revenue").over(last))).alias("moving_avg_7d"),
        )
        .orderBy("order_date")
    )


def q18(wh: Warehouse, top: int = 3) -> DataFrame:
    """Q18 best products of each category with ties. Spark trims each task to the top ranks before the shuffle."""
    rank = F.dense_rank().over(Window.partitionBy("category").orderBy(F.desc("revenue")))
    return (
        per_product(wh)
        .withColumn("rnk", rank)
        .where(F.col("rnk") <= top)
        .select("category", "product_id", "product_name", dbl("revenue").alias("revenue"), big("rnk").alias("rnk"))
        .orderBy("category", "rnk", "product_id")
    )


def q19(wh: Warehouse, limit: int = 200) -> DataFrame:
    """Q19 each customer month with the neighbouring months' revenue."""
    own = Window.partitionBy("customer_id").orderBy("month")
    return (
        customer_months(wh)
        .select(
            "customer_id",
            "month",
            dbl("revenue").alias("revenue"),
            dbl(F.lag("revenue").over(own)).alias("prev_month_revenue"),
            dbl(F.lead("revenue").over(own)).alias("next_month_revenue"),
        )
        .orderBy("customer_id", "month")
        .limit(limit)
    )


def q20(wh: Warehouse, tiles: int = 4) -> DataFrame:
    """Q20 product count and revenue per NTILE quartile.

    Products with equal revenue are interchangeable in the sums, so each ladder step is split over the quartiles it
    overlaps and no product has to be placed individually.
    """
    steps = ladder(product_revenue(wh), "revenue", descending=True).withColumn(
        "quartile", F.explode(F.array(*[F.lit(i) for i in range(1, tiles + 1)]))
    )
    size, extra = F.floor(F.col("rows_total") / tiles), F.col("rows_total") % tiles
    first = (F.col("quartile") - 1) * size + F.least(F.col("quartile") - 1, extra)
    last = F.col("quartile") * size + F.least(F.col("quartile").cast("bigint"), extra)
    inside = F.greatest(F.least(F.col("ahead") + F.col("n"), last) - F.greatest(F.col("ahead"), first), F.lit(0))
    return (
        steps.withColumn("inside", inside)
        .where(F.col("inside") > 0)
        .groupBy("quartile")
        .agg(
            big(F.sum("inside")).alias("num_products"),
            dbl(F.sum(F.col("revenue") * F.col("inside"))).alias("total_revenue"),
        )
        .select(big("quartile").alias("quartile"), "num_products", "total_revenue")
        .orderBy("quartile")
    )


def q21(wh: Warehouse, limit: int = 200) -> DataFrame:
    """Q21 first and last purchase per customer; plain MIN and MAX replace the frame functions."""
    return (
        wh.sales.groupBy("customer_id")
        .agg(F.min("order_date").alias("first_purchase"), F.max("order_date").alias("last_purchase"))
        .orderBy("customer_id")
        .limit(limit)
    )


def q22(wh: Warehouse, limit: int = 50) -> DataFrame:
    """Q22 each customer's largest order, the lowest order id on a tie; an aggregate, so map-side combined."""
    best = F.min(F.struct((-F.col("sales_amount")).alias("minus"), "order_id", "order_date", "sales_amount"))
    return (
        wh.sales.groupBy("customer_id")
        .agg(best.alias("b"))
        .select("customer_id", "b.order_id", "b.order_date", "b.sales_amount")
        .orderBy(F.desc("sales_amount"), "order_id")
        .limit(limit)
        .withColumn("sales_amount", dbl("sales_amount"))
    )


def q23(wh: Warehouse) -> DataFrame:
    """Q23 cumulative revenue share per product; equal revenues share one value, as a RANGE frame gives."""
    return (
        ranked(product_revenue(wh), "product_id", "revenue")
        .select("product_id", dbl("revenue").alias("revenue"), pct("running", "value_total").alias("cumulative_pct"))
        .orderBy(F.desc("revenue"), "product_id")
    )
