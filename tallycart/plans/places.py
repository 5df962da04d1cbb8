"""Regional and store reports Q60-Q63 and the mixed reports Q64-Q69."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.dates import month_spine
from tallycart.functions.numeric import big, dbl, pct, ratio, rnd
from tallycart.operators.skew import salted_join
from tallycart.plans.rollups import monthly, per_customer, per_product, per_store, resum, totals
from tallycart.sources.warehouse import Warehouse

SEGMENTS = ["Premium", "Regular", "Budget", "New"]  # fixed values: the pivot's columns


def q60(wh: Warehouse) -> DataFrame:
    """Q60 revenue, profit and margin per store region."""
    return (
        per_store(wh)
        .groupBy("region")
        .agg(*resum())
        .select(
            "region",
            dbl("revenue").alias("revenue"),
            dbl("profit").alias("profit"),
            pct("profit", "revenue").alias("margin_pct"),
        )
        .orderBy(F.desc("revenue"))
    )


def q61(wh: Warehouse, limit: int = 10) -> DataFrame:
    """Q61 top stores with rank. The rank is taken among the top rows only: nothing below them can change it."""
    best = totals(wh.sales, "store_id").orderBy(F.desc("revenue"), "store_id").limit(limit)
    return best.select(
        "store_id",
        dbl("revenue").alias("revenue"),
        big(F.rank().over(Window.orderBy(F.desc("revenue")))).alias("store_rank"),
    ).orderBy(F.desc("revenue"), "store_id")


def q62(wh: Warehouse) -> DataFrame:
    """Q62 revenue per year and channel."""
    return (
        totals(wh.sales, F.year("order_date").alias("yr"), "sales_channel")
        .select(big("yr").alias("yr"), "sales_channel", dbl("revenue").alias("revenue"))
        .orderBy("yr", "sales_channel")
    )


def q63(wh: Warehouse) -> DataFrame:
    """Q63 revenue by country with one column per segment."""
    wide = per_customer(wh).groupBy("country").pivot("segment", SEGMENTS).agg(F.sum("revenue"))
    return wide.select("country", *[dbl(s).alias(f"{s.lower()}_revenue") for s in SEGMENTS]).orderBy("country")


def q64(wh: Warehouse, first: dt.date = dt.date(2022, 1, 1), last: dt.date = dt.date(2024, 12, 1)) -> DataFrame:
    """Q64 revenue on a gap-free month spine."""
    spine = month_spine(wh.spark, first, last)
    return (
        spine.join(monthly(wh), "month", "left")
        .select("month", F.coalesce(dbl("revenue"), F.lit(0.0)).alias("revenue"))
        .orderBy("month")
    )


def q65(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q65 orders above their customer's own average, compared exactly as amount * orders > total."""
    own = wh.sales.groupBy("customer_id").agg(F.sum("sales_amount").alias("total"), F.count("sales_amount").alias("n"))
    orders = wh.sales.select("order_id", "customer_id", "sales_amount")
    return (
        salted_join(orders, own, "customer_id", spread="order_id", rows="n")
        .where(F.col("sales_amount") * F.col("n") > F.col("total"))
        .orderBy(F.desc("sales_amount"), "order_id")
        .limit(limit)
        .select("order_id", "customer_id", dbl("sales_amount").alias("sales_amount"))
    )


def q66(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q66 products above the mean margin of their category (mean of the rounded product margins)."""
    margins = (
        per_product(wh)
        .where(F.col("revenue") != 0)
        .select("product_id", "product_name", "category", pct("profit", "revenue").alias("product_margin_pct"))
    )
    exact = F.col("product_margin_pct").cast("decimal(18,2)")
    mean = ratio(F.sum(exact), F.count(exact)).alias("category_avg_margin_pct")
    means = margins.groupBy("category").agg(mean, F.count(F.lit(1)).alias("n"))
    gap = F.col("product_margin_pct") - F.col("category_avg_margin_pct")
    return (
        salted_join(margins, means, "category", spread="product_id", rows="n")
        .where(gap > 0)
        .orderBy(F.desc(gap), "product_id")
        .limit(limit)
        .select("product_id", "product_name", "category", "product_margin_pct", "category_avg_margin_pct")
    )


def _gaps(df: DataFrame, table: str, first: str, second: str) -> DataFrame:
    rows = F.count(F.lit(1))
    return df.agg(
        F.lit(table).alias("table_name"),
        rows.alias("total_rows"),
        (rows - F.count(first)).alias("missing_income"),
        (rows - F.count(second)).alias("missing_loyalty_tier"),
    )


def q67(wh: Warehouse) -> DataFrame:
    """Q67 missing attributes; the product row reuses the customer column names, as published."""
    customers = _gaps(wh.customers, "dim_customers", "income", "loyalty_tier")
    return customers.unionByName(_gaps(wh.products, "dim_products", "supplier", "launch_date"))


def q67_long(wh: Warehouse) -> DataFrame:
    """Q67 with one honest row per table and column."""

    def counted(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
        one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("k"), (F.col("_rows") - F.col(c)).alias("v")) for c in columns])
        return one.select("_rows", F.explode(pairs).alias("p")).select(
            F.lit(table).alias("table_name"),
            F.col("p.k").alias("column_name"),
            F.col("_rows").alias("total_rows"),
            F.col("p.v").alias("missing_rows"),
        )

    return counted(wh.customers, "dim_customers", ["income", "loyalty_tier"]).unionByName(
        counted(wh.products, "dim_products", ["supplier", "launch_date"])
    )


def q68(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q68 buyers who never returned an order."""
    returning = wh.returns.select("order_id").join(wh.sales.select("order_id", "customer_id"), "order_id")
    return (
        wh.customers.where(F.col("lifetime_value") > 0)
        .join(returning.select("customer_id").distinct(), "customer_id", "left_anti")
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(limit)
        .select("customer_id", "country", "loyalty_tier", dbl("lifetime_value").alias("lifetime_value"))
    )


def q69(wh: Warehouse) -> DataFrame:
    """Q69 each month against the mean of the three rows before it."""
    prior = Window.orderBy("month").rowsBetween(-3, -1)
    mean = ratio(F.sum("revenue").over(prior), F.count("revenue").over(prior))
    return (
        monthly(wh)
        .withColumn("mean", mean)
        .select(
            "month",
            dbl("revenue").alias("revenue"),
            rnd("mean").alias("trailing_3mo_avg"),
            F.when(F.col("mean").isNull(), "Insufficient History")
            .when(dbl("revenue") >= F.col("mean"), "Above Trend")
            .otherwise("Below Trend")
            .alias("trend_flag"),
        )
        .orderBy("month")
    )
