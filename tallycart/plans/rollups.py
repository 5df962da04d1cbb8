"""Shared first steps of the reports: facts are reduced to one row per entity before any dimension is joined.

The facts then never travel whole: partial sums are formed where the files are read, a hot product or customer
shrinks to one row per task, and the dimension join runs on entities instead of order lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of
from tallycart.sources.warehouse import Warehouse


def money() -> list[Column]:
    return [
        F.sum("sales_amount").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("discount").alias("discounts"),
    ]


def resum() -> list[Column]:
    """Second level of ``money`` over already reduced rows."""
    return [F.sum(c).alias(c) for c in ("revenue", "profit", "orders", "units", "discounts")]


def totals(sales: DataFrame, *keys: str | Column) -> DataFrame:
    return sales.groupBy(*keys).agg(*money())


def per_product(wh: Warehouse, *keys: str | Column) -> DataFrame:
    """Product totals (optionally per further key) with the product's attributes."""
    return totals(wh.sales, "product_id", *keys).join(wh.products, "product_id")


def per_customer(wh: Warehouse, *keys: str | Column) -> DataFrame:
    return totals(wh.sales, "customer_id", *keys).join(wh.customers, "customer_id")


def per_store(wh: Warehouse, *keys: str | Column) -> DataFrame:
    return totals(wh.sales, "store_id", *keys).join(wh.stores, "store_id")


def product_revenue(wh: Warehouse) -> DataFrame:
    return wh.sales.groupBy("product_id").agg(F.sum("sales_amount").alias("revenue"))


def monthly(wh: Warehouse) -> DataFrame:
    return totals(wh.sales, month_of("order_date").alias("month"))


def daily(wh: Warehouse) -> DataFrame:
    return totals(wh.sales, "order_date")


def customer_months(wh: Warehouse) -> DataFrame:
    return wh.sales.groupBy("customer_id", month_of("order_date").alias("month")).agg(
        F.sum("sales_amount").alias("revenue")
    )


def returns_per_product(wh: Warehouse) -> DataFrame:
    """Returns counted on the product of the returned order. Every return row counts, also a second one per order."""
    bought = wh.sales.select("order_id", "product_id")
    return (
        wh.returns.select("order_id").join(bought, "order_id").groupBy("product_id").agg(F.count(F.lit(1)).alias("returns"))
    )


def refunds_per_order(wh: Warehouse) -> DataFrame:
    """Approved and refunded amounts, one row per order so that a second return cannot repeat the sale."""
    paid = wh.returns.where(F.col("return_status").isin("Approved", "Refunded"))
    return paid.groupBy("order_id").agg(F.sum("refund_amount").alias("refunds"))
