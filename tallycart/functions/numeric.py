"""Division and rounding. Every rounded number in the library goes through ``rnd``.

A double is first cut to six decimals as DECIMAL and then rounded half up, so that the last bits of a
floating-point quotient never decide which way a cent falls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def big(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")


def rnd(value: Column | str, digits: int = 2) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("decimal(38,6)"), digits).cast("double")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom as double; NULL when bottom is zero or NULL."""
    return F.try_divide(dbl(top), dbl(bottom))


def pct(top: Column | str, bottom: Column | str, digits: int = 2) -> Column:
    return rnd(F.try_divide(F.lit(100.0) * dbl(top), dbl(bottom)), digits)


def growth_pct(now: Column, before: Column, digits: int = 2) -> Column:
    return pct(now - before, before, digits)


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_if(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value))
