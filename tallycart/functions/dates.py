"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_of(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def quarter_of(day: Column | str) -> Column:
    return F.trunc(day, "QUARTER")


def months_apart(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def month_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per month start between two dates."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("month")
    )


def spine_between(bounds: DataFrame, first: str, last: str, unit: str, name: str) -> DataFrame:
    """Gap-free spine from a frame holding the first and the last date per series."""
    keep = [c for c in bounds.columns if c not in (first, last)]
    return bounds.select(
        *keep, F.explode(F.sequence(F.col(first), F.col(last), F.expr(f"interval 1 {unit}"))).alias(name)
    )
