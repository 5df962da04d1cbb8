"""Revenue and profitability reports Q01-Q10 and growth reports Q11-Q15."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.dates import quarter_of
from tallycart.functions.numeric import big, dbl, growth_pct, pct, ratio, rnd
from tallycart.operators.ladder import ladder
from tallycart.plans.rollups import (
    money, monthly, per_customer, per_product, per_store, refunds_per_order, resum, totals,
)
from tallycart.sources.warehouse import Warehouse


def q01(wh: Warehouse) -> DataFrame:
    """Q01 revenue, profit and gross margin."""
    return wh.sales.agg(*money()).select(
        dbl("revenue").alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        pct("profit", "revenue").alias("gross_margin_pct"),
    )


def q02(wh: Warehouse) -> DataFrame:
    """Q02 margin after refunds. Refunds are summed through the orders they belong to; no fact-wide outer join."""
    sold = wh.sales.agg(*money())
    refunded = refunds_per_order(wh).join(wh.sales.select("order_id"), "order_id").agg(F.sum("refunds").alias("r"))
    refunds = F.coalesce("r", F.lit(0))
    net = F.col("profit") - refunds
    return sold.crossJoin(F.broadcast(refunded)).select(
        dbl("profit").alias("gross_profit"),
        dbl(refunds).alias("total_refunds"),
        dbl(net).alias("net_profit"),
        pct(net, F.col("revenue")).alias("net_margin_pct"),
    )


def q03(wh: Warehouse) -> DataFrame:
    """Q03 orders and average order value per channel."""
    return (
        totals(wh.sales, "sales_channel")
        .select("sales_channel", big("orders").alias("orders"), rnd(ratio("revenue", "orders")).alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"))
    )


def q04(wh: Warehouse) -> DataFrame:
    """Q04 average discount and kept margin per category."""
    return (
        per_product(wh)
        .groupBy("category")
        .agg(*resum())
        .select(
            "category",
            rnd(ratio("discounts", "orders") * 100).alias("avg_discount_pct"),
            pct("profit", "revenue").alias("margin_pct"),
        )
        .orderBy(F.desc("avg_discount_pct"), "category")
    )


def q05(wh: Warehouse) -> DataFrame:
    """Q05 units per order and revenue per unit."""
    return wh.sales.agg(*money()).select(
        rnd(ratio("units", "orders")).alias("avg_basket_size"), rnd(ratio("revenue", "units")).alias("revenue_per_unit")
    )


def q06(wh: Warehouse) -> DataFrame:
    """Q06 orders, revenue and margin per payment method."""
    return (
        totals(wh.sales, "payment_method")
        .select(
            "payment_method",
            big("orders").alias("orders"),
            dbl("revenue").alias("revenue"),
            pct("profit", "revenue").alias("margin_pct"),
        )
        .orderBy(F.desc("revenue"))
    )


def q07(wh: Warehouse) -> DataFrame:
    """Q07 revenue and profit per month."""
    return monthly(wh).select("month", dbl("revenue").alias("revenue"), dbl("profit").alias("profit")).orderBy("month")


def q08(wh: Warehouse, share: float = 0.10) -> DataFrame:
    """Q08 share of revenue from the top tenth of customers by PERCENT_RANK, read off the value ladder."""
    spend = wh.sales.groupBy("customer_id").agg(F.sum("sales_amount").alias("rev"))
    steps = ladder(spend, "rev", descending=True)
    rank = F.coalesce(ratio(F.col("ahead"), F.col("rows_total") - 1), F.lit(0.0))
    held = F.col("rev") * F.col("n")
    return steps.agg(F.sum(F.when(rank <= share, held)).alias("top"), F.sum(held).alias("every")).select(
        pct("top", "every").alias("pct_revenue_from_top_10pct_customers")
    )


def q09(wh: Warehouse, limit: int = 15) -> DataFrame:
    """Q09 brands by profit; equal profits in brand order."""
    return (
        per_product(wh)
        .groupBy("brand")
        .agg(*resum())
        .orderBy(F.desc("profit"), "brand")
        .limit(limit)
        .select(
            "brand",
            dbl("revenue").alias("revenue"),
            dbl("profit").alias("profit"),
            pct("profit", "revenue").alias("margin_pct"),
        )
    )


def q10(wh: Warehouse) -> DataFrame:
    """Q10 orders, revenue and average order value per customer segment."""
    return (
        per_customer(wh)
        .groupBy("segment")
        .agg(*resum())
        .select(
            "segment",
            big("orders").alias("orders"),
            dbl("revenue").alias("revenue"),
            rnd(ratio("revenue", "orders")).alias("aov"),
        )
        .orderBy(F.desc("revenue"))
    )


# The windows below run over one row per month, quarter or year: a calendar bounds them, not the data.


def q11(wh: Warehouse) -> DataFrame:
    """Q11 month-over-month growth."""
    before = F.lag("revenue").over(Window.orderBy("month"))
    return (
        monthly(wh)
        .select("month", dbl("revenue").alias("revenue"), growth_pct(F.col("revenue"), before).alias("mom_growth_pct"))
        .orderBy("month")
    )


def q12(wh: Warehouse) -> DataFrame:
    """Q12 quarter-over-quarter growth."""
    before = F.lag("revenue").over(Window.orderBy("quarter"))
    return (
        totals(wh.sales, quarter_of("order_date").alias("quarter"))
        .select("quarter", dbl("revenue").alias("revenue"), growth_pct(F.col("revenue"), before).alias("qoq_growth_pct"))
        .orderBy("quarter")
    )


def q13(wh: Warehouse) -> DataFrame:
    """Q13 growth against the row twelve months back."""
    before = F.lag("revenue", 12).over(Window.orderBy("month"))
    return (
        monthly(wh)
        .select(
            "month",
            dbl("revenue").alias("revenue"),
            dbl(before).alias("revenue_same_month_last_year"),
            growth_pct(F.col("revenue"), before).alias("yoy_growth_pct"),
        )
        .orderBy("month")
    )


def q14(wh: Warehouse) -> DataFrame:
    """Q14 yearly growth per category."""
    before = F.lag("revenue").over(Window.partitionBy("category").orderBy("yr"))
    return (
        per_product(wh, F.year("order_date").alias("yr"))
        .groupBy("category", "yr")
        .agg(F.sum("revenue").alias("revenue"))
        .select(
            "category",
            big("yr").alias("yr"),
            dbl("revenue").alias("revenue"),
            growth_pct(F.col("revenue"), before).alias("yoy_growth_pct"),
        )
        .orderBy("category", "yr")
    )


def region_years(wh: Warehouse) -> DataFrame:
    return (
        per_store(wh, F.year("order_date").alias("yr"))
        .groupBy("region", "yr")
        .agg(F.sum("revenue").alias("revenue"))
    )


def q15(wh: Warehouse) -> DataFrame:
    """Q15 region years that earned less than the year before."""
    before = F.lag("revenue").over(Window.partitionBy("region").orderBy("yr"))
    return (
        region_years(wh)
        .withColumn("delta", F.col("revenue") - before)
        .where(F.col("delta") < 0)
        .select("region", big("yr").alias("yr"), dbl("revenue").alias("revenue"), dbl("delta").alias("delta"))
        .orderBy("delta", "region", "yr")
    )
