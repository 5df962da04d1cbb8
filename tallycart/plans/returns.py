"""Returns reports Q54-Q59."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.functions.numeric import big, dbl, pct, ratio, rnd
from tallycart.plans.rollups import returns_per_product
from tallycart.sources.warehouse import Warehouse


def q54(wh: Warehouse) -> DataFrame:
    """Q54 overall return rate and refund cost."""
    sold = wh.sales.agg(F.count(F.lit(1)).alias("total_orders"))
    back = wh.returns.agg(F.count(F.lit(1)).alias("total_returns"), dbl(F.sum("refund_amount")).alias("total_refund_cost"))
    return sold.crossJoin(F.broadcast(back)).select(
        "total_orders",
        "total_returns",
        pct("total_returns", "total_orders").alias("return_rate_pct"),
        "total_refund_cost",
    )


def _share_of_returns(wh: Warehouse, key: str) -> DataFrame:
    groups = wh.returns.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("refund_amount").alias("cost"))
    whole = wh.returns.agg(F.count(F.lit(1)).alias("whole"))
    return groups.crossJoin(F.broadcast(whole)).withColumn("share", pct("n", "whole"))


def q55(wh: Warehouse) -> DataFrame:
    """Q55 returns and refund cost per reason."""
    return (
        _share_of_returns(wh, "reason")
        .select(
            "reason", F.col("n").alias("return_count"), F.col("share").alias("pct_of_returns"),
            dbl("cost").alias("refund_cost"),
        )
        .orderBy(F.desc("refund_cost"), "reason")
    )


def _sold_and_returned(wh: Warehouse) -> DataFrame:
    """Orders and returns per product: counted apart, then joined product by product."""
    sold = wh.sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("orders"))
    return (
        sold.join(returns_per_product(wh), "product_id", "left")
        .withColumn("returns", F.coalesce("returns", F.lit(0)))
        .join(wh.products, "product_id")
    )


def q56(wh: Warehouse) -> DataFrame:
    """Q56 return rate per category."""
    return (
        _sold_and_returned(wh)
        .groupBy("category")
        .agg(big(F.sum("orders")).alias("orders"), big(F.sum("returns")).alias("returns"))
        .withColumn("return_rate_pct", pct("returns", "orders"))
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def q57(wh: Warehouse, min_orders: int = 10, limit: int = 20) -> DataFrame:
    """Q57 products with the highest return rate among those with enough orders."""
    return (
        _sold_and_returned(wh)
        .where(F.col("orders") >= min_orders)
        .select(
            "product_id", "product_name", "supplier", big("orders").alias("orders"), big("returns").alias("returns"),
            pct("returns", "orders").alias("return_rate_pct"),
        )
        .orderBy(F.desc("return_rate_pct"), "product_id")
        .limit(limit)
    )


def q58(wh: Warehouse) -> DataFrame:
    """Q58 returns per status."""
    return (
        _share_of_returns(wh, "return_status")
        .select("return_status", F.col("n").alias("count"), F.col("share").alias("pct"))
        .orderBy(F.desc("count"), "return_status")
    )


def q59(wh: Warehouse) -> DataFrame:
    """Q59 mean days until a return per reason."""
    return (
        wh.returns.groupBy("reason")
        .agg(
            rnd(ratio(F.sum("days_after_purchase"), F.count("days_after_purchase")), 1).alias("avg_days_to_return"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy("avg_days_to_return", "reason")
    )
