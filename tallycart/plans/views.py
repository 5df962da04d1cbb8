"""Views V1-V4, routines R1-R5 and the three plan examples G1-G3."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of
from tallycart.functions.numeric import big, dbl, pct, ratio, rnd
from tallycart.operators.integrity import recompute_profit, stock_mismatches
from tallycart.plans.customers import AS_OF, rfm_scored
from tallycart.plans.kpis import q11
from tallycart.plans.products import abc_products
from tallycart.plans.rollups import money, resum, totals
from tallycart.plans.stock import health
from tallycart.sources.schemas import STAR
from tallycart.sources.warehouse import Warehouse, with_tiers


def v1(wh: Warehouse) -> DataFrame:
    """V1 monthly KPIs. Customers are counted by grouping twice, which keeps partial sums and avoids DISTINCT."""
    buyers = totals(wh.sales, month_of("order_date").alias("month"), "customer_id")
    return monthly_kpis(buyers.groupBy("month").agg(*resum(), F.count(F.lit(1)).alias("active_customers")))


def monthly_kpis(months: DataFrame) -> DataFrame:
    return months.select(
        "month",
        big("orders").alias("orders"),
        "active_customers",
        dbl("revenue").alias("revenue"),
        dbl("profit").alias("profit"),
        pct("profit", "revenue").alias("margin_pct"),
        rnd(ratio("revenue", "orders")).alias("avg_order_value"),
    )


def v2(wh: Warehouse, as_of: dt.date = AS_OF) -> DataFrame:
    """V2 RFM scores of every customer."""
    return rfm_scored(wh, as_of)


def v3(wh: Warehouse) -> DataFrame:
    """V3 ABC class of every product."""
    return abc_products(wh)


def v4(wh: Warehouse) -> DataFrame:
    """V4 inventory health of every product."""
    return health(wh)


def r1(wh: Warehouse) -> DataFrame:
    """R1 customers with refreshed lifetime value and tier; customers without sales keep the value they had."""
    spend = wh.sales.groupBy("customer_id").agg(F.sum("sales_amount").alias("spend"))
    value = F.coalesce("spend", "lifetime_value").cast("decimal(14,2)")
    fresh = wh.customers.join(spend, "customer_id", "left").withColumn("lifetime_value", value).drop("spend")
    return with_tiers(fresh)


def r2(wh: Warehouse, category: str, limit: int = 10) -> DataFrame:
    """R2 top products of one category; the category filter reaches the product scan before any join."""
    wanted = wh.products.where(F.col("category") == category).select("product_id", "product_name")
    return (
        wh.sales.join(wanted.select("product_id"), "product_id", "left_semi")  # before the sums: Spark broadcasts a small list
        .groupBy("product_id")
        .agg(F.sum("sales_amount").alias("revenue"))
        .join(wanted, "product_id")
        .orderBy(F.desc("revenue"), "product_id")
        .limit(limit)
        .select("product_id", "product_name", dbl("revenue").alias("revenue"))
    )


def r3(wh: Warehouse) -> DataFrame:
    """R3 monthly growth as a table function."""
    return q11(wh).withColumnRenamed("mom_growth_pct", "growth_pct")


def r4(wh: Warehouse) -> DataFrame:
    """R4 sales with profit recomputed from cost; unknown products keep the given profit."""
    return recompute_profit(wh.sales, wh.products)


def r5(wh: Warehouse) -> DataFrame:
    """R5 inventory lines whose closing stock does not reconcile."""
    return stock_mismatches(wh.inventory)


def g1(wh: Warehouse, first: dt.date = dt.date(2024, 11, 1), last: dt.date = dt.date(2024, 12, 31)) -> DataFrame:
    """G1 revenue of a date range: two month folders are read, not the table."""
    return wh.sales_between(first, last).agg(dbl(F.sum("sales_amount")).alias("revenue"))


def g2(wh: Warehouse, category: str = "Electronics") -> DataFrame:
    """G2 revenue of one category."""
    wanted = wh.products.where(F.col("category") == category).select("product_id", "category")
    return (
        totals(wh.sales.join(wanted.select("product_id"), "product_id", "left_semi"), "product_id")
        .join(wanted, "product_id")
        .groupBy("category")
        .agg(dbl(F.sum("revenue")).alias("revenue"))
    )


def g3(wh: Warehouse, since: dt.date = dt.date(2024, 1, 1)) -> DataFrame:
    """G3 revenue per store since a date."""
    return (
        wh.sales_between(first=since)
        .groupBy("store_id")
        .agg(*money())
        .select("store_id", dbl("revenue").alias("revenue"))
    )


def register_sql(wh: Warehouse, as_of: dt.date = AS_OF) -> None:
    """Tables, views and table functions under their SQL names, for ``spark.sql``."""
    for name in STAR:
        wh.table(name).createOrReplaceTempView(name)
    for name, frame in {
        "vw_monthly_kpis": v1(wh),
        "vw_customer_rfm": v2(wh, as_of),
        "vw_product_abc": v3(wh),
        "vw_inventory_health": v4(wh),
    }.items():
        frame.createOrReplaceTempView(name)
    key = dict(wh.products.dtypes)["product_id"]
    wh.spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION top_products_by_category(wanted STRING, top INT DEFAULT 10)
        RETURNS TABLE (product_id {key}, product_name STRING, revenue DOUBLE)
        RETURN SELECT product_id, product_name, CAST(held AS DOUBLE)
          FROM (SELECT p.product_id, p.product_name, t.held,
                       row_number() OVER (ORDER BY t.held DESC, p.product_id) AS place
                FROM (SELECT product_id, sum(sales_amount) AS held FROM fact_sales GROUP BY product_id) t
                JOIN dim_products p ON p.product_id = t.product_id AND p.category = wanted)
          WHERE place <= top"""
    )
    r3(wh).createOrReplaceTempView("monthly_growth")
    wh.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION monthly_growth_pct()
        RETURNS TABLE (month DATE, revenue DOUBLE, growth_pct DOUBLE)
        RETURN SELECT month, revenue, growth_pct FROM monthly_growth"""
    )
