"""Date dimension and the auxiliary tables of the BI model (K1-K3)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.functions.dates import spine_between
from tallycart.functions.numeric import big
from tallycart.sources.warehouse import Warehouse

KPIS = ("Revenue", "Profit", "Orders", "Margin %", "AOV")  # fixed values: names of the KPI selector


def _described(days: DataFrame) -> DataFrame:
    """Attributes of each date. WEEKDAY counts Monday as 0, so 5 and 6 are the weekend."""
    day = F.col("date")
    return days.select(
        "date",
        big(F.year(day)).alias("year"),
        big(F.month(day)).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        big(F.year(day)).alias("fiscal_year"),
    )


def dim_date(spark: SparkSession, first: dt.date = dt.date(2022, 1, 1), last: dt.date = dt.date(2025, 12, 31)) -> DataFrame:
    """K1: one row per day between two dates."""
    days = spark.range((last - first).days + 1)
    return _described(days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")))


def dated_orders(wh: Warehouse) -> DataFrame:
    """K1 over the full years that the sales touch, with the orders of each day through the date relationship."""
    bounds = wh.sales.agg(
        F.trunc(F.min("order_date"), "YEAR").alias("first"),
        F.make_date(F.year(F.max("order_date")), F.lit(12), F.lit(31)).alias("last"),
    )
    sold = wh.sales.groupBy(F.col("order_date").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    dates = _described(spine_between(bounds, "first", "last", "day", "date"))
    return dates.join(sold, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def kpi_selector(spark: SparkSession) -> DataFrame:
    """K2: the names a dashboard can switch between."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in KPIS])).alias("kpi_name"))


def targets(spark: SparkSession, amounts: Mapping[dt.date, float]) -> DataFrame:
    """K3: monthly revenue targets as entered by the user."""
    rows = [(month, float(amount)) for month, amount in sorted(amounts.items())]
    return spark.createDataFrame(rows, "month date, target_revenue double")


def sample_targets(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Targets of the checks: 900,000 plus 10,000 per month number."""
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    months = [dt.date(first.year + (first.month - 1 + k) // 12, (first.month - 1 + k) % 12 + 1, 1) for k in range(count)]
    return targets(spark, {m: 900000 + 10000 * m.month for m in months})
