"""The streams X1-X5 over sales that arrive in two rounds, with duplicates and late rows (FIXTURES.md section 5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of
from tallycart.functions.numeric import big, dbl
from tallycart.session import scratch
from tallycart.sources.warehouse import Warehouse
from tallycart.streaming import streams

CUT = dt.date(1998, 7, 1)  # the second round starts here
KEY = "CAST(split_part(order_id, '-', 1) AS BIGINT)"


def _rounds(wh: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First round, second round, and orders that arrive half a year too late with the second."""
    sales = wh.sales.drop("order_month")
    late = sales.where(F.col("order_date") < F.add_months(F.lit(CUT), -6)).where(f"{KEY} % 307 = 0")
    late = late.withColumn("order_id", F.concat("order_id", F.lit("-LATE")))
    return sales.where(F.col("order_date") < F.lit(CUT)), sales.where(F.col("order_date") >= F.lit(CUT)), late


def _spoiled(sales: DataFrame) -> DataFrame:
    """Zero quantities, unknown customers, impossible discounts and no profit yet."""
    return (
        sales.withColumn("k", F.expr(KEY))
        .withColumn("quantity", F.when(F.col("k") % 89 == 0, 0).otherwise(F.col("quantity")))
        .withColumn("customer_id", F.col("customer_id") + F.when(F.col("k") % 211 == 0, 10000000).otherwise(0))
        .withColumn("discount", F.when(F.col("k") % 97 == 0, F.lit("1.5")).otherwise(F.col("discount")).cast("decimal(5,3)"))
        .withColumn("profit", F.lit(0).cast("decimal(12,2)"))
        .drop("k")
    )


def x1(wh: Warehouse) -> DataFrame:
    """X1 both rounds contain copies, the second also copies of June orders and rows beyond the watermark."""
    first, second, late = _rounds(wh)
    first, second = _spoiled(first), _spoiled(second)
    again = first.where(F.col("order_date") >= F.date_sub(F.lit(CUT), 20))
    copies = [df.where(f"{KEY} % 101 = 0") for df in (first, second)]
    source, sink, state = (scratch(wh.spark, n) for n in ("orders", "clean", "checkpoint"))

    def run() -> None:
        arriving = streams.read_files(wh.spark, source, first.schema)
        streams.append_to(streams.clean_orders(arriving, wh.customers, wh.products), sink, state)

    rounds = [first.unionByName(copies[0]), second.unionByName(copies[1]).unionByName(again).unionByName(_spoiled(late))]
    streams.in_rounds(rounds, source, run)
    return (
        wh.spark.read.parquet(sink)
        .groupBy(month_of("order_date").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            big(F.sum("quantity")).alias("units"),
            dbl(F.sum("discount")).alias("discounts"),
            dbl(F.sum("profit")).alias("profit"),
        )
    )


def x2(wh: Warehouse) -> DataFrame:
    """X2 the alerts of a stream of inventory lines in two rounds."""
    lines = wh.inventory
    source, sink, state = (scratch(wh.spark, n) for n in ("lines", "alerts", "checkpoint"))
    rounds = [lines.where("product_id % 2 = 0"), lines.where("product_id % 2 = 1")]

    def run() -> None:
        streams.append_to(streams.stock_alerts(streams.read_files(wh.spark, source, lines.schema)), sink, state)

    streams.in_rounds(rounds, source, run)
    return wh.spark.read.parquet(sink)


def x3(wh: Warehouse) -> DataFrame:
    """X3 lifetime value after both rounds."""
    first, second, _ = _rounds(wh)
    source, sink, state = (scratch(wh.spark, n) for n in ("orders", "ltv", "checkpoint"))

    def run() -> None:
        streams.upsert_to(streams.spend_per_customer(streams.read_files(wh.spark, source, first.schema)), sink, state, "customer_id")

    streams.in_rounds([first, second], source, run)
    return streams.latest(wh.spark, sink, "customer_id").select(
        "customer_id", dbl("lifetime_value").alias("lifetime_value"), "orders"
    )


def _windows(wh: Warehouse, length: str, slide: str | None, sink_to=streams.append_to) -> str:
    first, second, late = _rounds(wh)
    source, sink, state = (scratch(wh.spark, n) for n in ("orders", "windows", "checkpoint"))

    def run() -> None:
        arriving = streams.read_files(wh.spark, source, first.schema)
        sink_to(streams.windowed_revenue(arriving, length, slide), sink, state)

    streams.in_rounds([first, second.unionByName(late)], source, run)
    return sink


def x4(wh: Warehouse) -> DataFrame:
    """X4 final days, judged in the stream by the days before them; late rows do not count."""
    return wh.spark.read.parquet(_windows(wh, "1 day", None, streams.judge_to) + "/days").drop("batch")


def x5(wh: Warehouse) -> DataFrame:
    """X5 seven-day windows sliding by a day."""
    return wh.spark.read.parquet(_windows(wh, "7 days", "1 day")).select("from_day", dbl("revenue").alias("revenue"), "orders")
