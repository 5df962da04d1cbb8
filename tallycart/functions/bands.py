"""Banding rules shared by reports, measures and insights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that reports must show.
DISCOUNT_LABELS = ("0% (no discount)", "1-10%", "11-25%", "26%+")
TIER_LABELS = ("Platinum", "Gold", "Silver", "Bronze")
SPEND_LABELS = ("High Value", "Mid Value", "Low Value", "No Purchases")
RFM_LABELS = ("Champion", "Loyal", "At Risk", "Lost")
RATING_BANDS = (("4.5", "4.5-5.0"), ("4.0", "4.0-4.49"), ("3.5", "3.5-3.99"), ("3.0", "3.0-3.49"))
RATING_REST = "Below 3.0"


def at_least(value: Column, cuts: Sequence[tuple[Column, str]], rest: str) -> Column:
    """First label whose cut the value reaches; NULL values fall to ``rest``."""
    out = None
    for cut, label in cuts:
        out = F.when(value >= cut, label) if out is None else out.when(value >= cut, label)
    return out.otherwise(rest)


def discount_band(discount: Column, light: str, deep: str) -> Column:
    none, low, middle, high = DISCOUNT_LABELS
    return (
        F.when(discount == 0, none)
        .when(discount <= F.lit(light).cast("decimal(5,3)"), low)
        .when(discount <= F.lit(deep).cast("decimal(5,3)"), middle)
        .otherwise(high)
    )


def rating_band(rating: Column) -> Column:
    cuts = [(F.lit(cut).cast("decimal(3,1)"), label) for cut, label in RATING_BANDS]
    return at_least(rating, cuts, RATING_REST)


def abc_class(running: Column, total: Column, a_share: int = 80, b_share: int = 95) -> Column:
    """Class from exact decimals: the cut is tested by cross-multiplication, not by a rounded quotient."""
    return F.when(running * 100 <= total * a_share, "A").when(running * 100 <= total * b_share, "B").otherwise("C")
