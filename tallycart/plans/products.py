"""Product reports Q36-Q45."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.bands import abc_class, discount_band
from tallycart.functions.numeric import big, dbl, pct, ratio, rnd
from tallycart.operators.ladder import ladder, ranked
from tallycart.plans.rollups import per_product, product_revenue, resum
from tallycart.sources.warehouse import Warehouse


def abc_products(wh: Warehouse) -> DataFrame:
    """Every product with its cumulative share and ABC class; peers in revenue share both."""
    return abc_of(product_revenue(wh))


def abc_of(revenue: DataFrame) -> DataFrame:
    return ranked(revenue, "product_id", "revenue").select(
        "product_id",
        dbl("revenue").alias("revenue"),
        pct("running", "value_total").alias("cumulative_pct"),
        abc_class(F.col("running"), F.col("value_total")).alias("abc_class"),
    )


def q36(wh: Warehouse) -> DataFrame:
    """Q36 ABC class per product (80 / 95 % of cumulative revenue)."""
    return abc_products(wh).orderBy(F.desc("revenue"), "product_id")


def q37(wh: Warehouse) -> DataFrame:
    """Q37 product count and revenue per ABC class, summed from the ladder without placing single products."""
    classes = (
        ladder(product_revenue(wh), "revenue", descending=True)
        .groupBy(abc_class(F.col("running"), F.col("value_total")).alias("abc_class"))
        .agg(F.sum("n").alias("n"), F.sum(F.col("revenue") * F.col("n")).alias("held"))
    )
    every = Window.partitionBy()  # at most three rows
    return classes.select(
        "abc_class",
        big("n").alias("num_skus"),
        pct(F.col("n"), F.sum("n").over(every)).alias("pct_of_skus"),
        dbl("held").alias("revenue"),
        pct(F.col("held"), F.sum("held").over(every)).alias("pct_of_revenue"),
    ).orderBy("abc_class")


def q38(wh: Warehouse) -> DataFrame:
    """Q38 revenue share per category."""
    shares = per_product(wh).groupBy("category").agg(*resum())
    whole = wh.sales.agg(F.sum("sales_amount").alias("whole"))
    return (
        shares.crossJoin(F.broadcast(whole))
        .select("category", dbl("revenue").alias("revenue"), pct("revenue", "whole").alias("pct_of_total_revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def q39(wh: Warehouse, limit: int = 10) -> DataFrame:
    """Q39 best-selling products."""
    return (
        per_product(wh)
        .orderBy(F.desc("revenue"), "product_id")
        .limit(limit)
        .select(
            "product_id", "product_name", "category", dbl("revenue").alias("revenue"), big("units").alias("units_sold")
        )
    )


def q40(wh: Warehouse, min_orders: int = 5, limit: int = 10) -> DataFrame:
    """Q40 weakest products among those with enough orders."""
    return (
        per_product(wh)
        .where(F.col("orders") >= min_orders)
        .orderBy("revenue", "product_id")
        .limit(limit)
        .select(
            "product_id",
            "product_name",
            "category",
            dbl("revenue").alias("revenue"),
            big("orders").alias("orders"),
            dbl("profit").alias("profit"),
        )
    )


def q41(wh: Warehouse, limit: int = 15) -> DataFrame:
    """Q41 products with the thinnest margin."""
    return (
        per_product(wh)
        .where(F.col("revenue") > 0)
        .withColumn("margin_pct", pct("profit", "revenue"))
        .orderBy("margin_pct", "product_id")
        .limit(limit)
        .select(
            "product_id",
            "product_name",
            "category",
            dbl("revenue").alias("revenue"),
            dbl("profit").alias("profit"),
            "margin_pct",
        )
    )


def banded(wh: Warehouse, light: str, deep: str) -> DataFrame:
    return (
        per_product(wh, discount_band(F.col("discount"), light, deep).alias("discount_band"))
        .groupBy("category", "discount_band")
        .agg(*resum())
    )


def q42(wh: Warehouse, light: str = "0.10", deep: str = "0.25") -> DataFrame:
    """Q42 margin per category and discount band."""
    return (
        banded(wh, light, deep)
        .select(
            "category",
            "discount_band",
            big("orders").alias("orders"),
            dbl("revenue").alias("revenue"),
            pct("profit", "revenue").alias("margin_pct"),
        )
        .orderBy("category", "discount_band")
    )


def q43(wh: Warehouse, since: dt.date = dt.date(2024, 1, 1)) -> DataFrame:
    """Q43 new launches against the older range."""
    cohort = F.when(F.col("launch_date") >= F.lit(since), f"Launched {since.year}").otherwise(
        f"Launched Before {since.year}"
    )
    return (
        per_product(wh)
        .groupBy(cohort.alias("launch_cohort"))
        .agg(F.count(F.lit(1)).alias("num_products"), F.sum("revenue").alias("revenue"))
        .select(
            "launch_cohort",
            "num_products",
            dbl("revenue").alias("revenue"),
            rnd(ratio("revenue", "num_products")).alias("revenue_per_product"),
        )
    )


def q44(wh: Warehouse) -> DataFrame:
    """Q44 most profitable subcategory of each category, ties kept."""
    rank = F.rank().over(Window.partitionBy("category").orderBy(F.desc("profit")))
    return (
        per_product(wh)
        .groupBy("category", "subcategory")
        .agg(*resum())
        .withColumn("rnk", rank)
        .where(F.col("rnk") == 1)
        .select(
            "category",
            "subcategory",
            dbl("revenue").alias("revenue"),
            pct("profit", "revenue").alias("margin_pct"),
            big("rnk").alias("rnk"),
        )
        .orderBy(F.desc("revenue"), "category", "subcategory")
    )


def q45(wh: Warehouse, limit: int = 15) -> DataFrame:
    """Q45 suppliers by revenue, with the number of their products sold."""
    return (
        per_product(wh)
        .groupBy("supplier")
        .agg(*resum(), F.count(F.lit(1)).alias("num_products"))
        .orderBy(F.desc("revenue"), "supplier")
        .limit(limit)
        .select(
            "supplier",
            "num_products",
            dbl("revenue").alias("revenue"),
            pct("profit", "revenue").alias("margin_pct"),
        )
    )
