"""Tail probabilities of Student's t and Fisher's F through the regularised incomplete beta function.

The continued fraction is evaluated with the modified Lentz method. The functions see one row per test, never data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):  # the fraction converges fast only on the other side
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 2000):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * total / a


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    if math.isinf(f):
        return 0.0
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def t_quantile(level: float, df: float) -> float:
    """Value that |t| stays below with probability ``level``."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > 1.0 - level:
        high *= 2.0
    for _ in range(200):
        middle = (low + high) / 2.0
        low, high = (middle, high) if t_two_sided(middle, df) > 1.0 - level else (low, middle)
    return (low + high) / 2.0


def _safe(function, *values: pd.Series) -> pd.Series:
    return pd.Series(
        [None if any(v is None or v != v for v in row) else function(*row) for row in zip(*values)], dtype="float64"
    )


def t_p_value(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series) -> pd.Series:
        return _safe(t_two_sided, a, b)

    return tail(t, df.cast("double"))


def f_p_value(f: Column, d1: Column, d2: Column) -> Column:
    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return _safe(f_upper, a, b, c)

    return tail(f, d1.cast("double"), d2.cast("double"))


def t_bound(level: float, df: Column) -> Column:
    @F.pandas_udf("double")
    def bound(a: pd.Series) -> pd.Series:
        return _safe(lambda v: t_quantile(level, v), a)

    return bound(df.cast("double"))
