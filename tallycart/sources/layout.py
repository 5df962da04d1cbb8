"""How sales lie in files. Month folders, and inside a month along a Z-curve over customer, product, store and day, so that a
filter on any of these keys skips most row groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of

CURVE = ("customer_id", "product_id", "store_id")  # the day of the month is the fourth key
BITS = 5  # per key: 32 parts
SAMPLE = 8192  # rows whose keys set the limits of the parts; they steer the layout only


def limits(df: DataFrame, columns: tuple[str, ...] = CURVE) -> dict[str, list]:
    """Values that cut each column into 2 ** BITS parts of about equal size, from the rows with the smallest hashes."""
    drawn = df.select(*columns).orderBy(F.xxhash64(*columns), *columns).limit(SAMPLE).collect()
    out = {}
    for k, name in enumerate(columns):
        values = sorted(row[k] for row in drawn if row[k] is not None)
        cuts = [values[len(values) * j // (1 << BITS)] for j in range(1, 1 << BITS)] if values else []
        out[name] = sorted(set(cuts))
    return out


def part(value: Column, cuts: list, first: int = 0) -> Column:
    """The number of the part that a value falls into, by comparing it BITS times."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value < F.lit(cuts[middle]), part(value, cuts[:middle], first)).otherwise(part(value, cuts[middle + 1 :], first + middle + 1))


def interleaved(parts: list[Column]) -> Column:
    """The bits of the parts in turn, highest first."""
    bits = [F.shiftleft(F.shiftright(p, b).bitwiseAND(1), b * len(parts) + k) for b in range(BITS) for k, p in enumerate(reversed(parts))]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def curved(df: DataFrame, finished: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Sales with order_month, ranged over tasks and sorted along the curve; a heavy month is cut into several files. The
    frame is read three times (limits, ranges, rows), so it should be a stored one. ``finished`` makes the sales of rows that
    have the keys and the day so far, once they are ranged; it keeps order_month and _z."""
    cuts = limits(df)
    parts = {f"_{c}": part(F.col(c), cuts[c]) for c in CURVE} | {"_day": F.dayofmonth("order_date")}
    rows = df.withColumn("order_month", month_of("order_date")).withColumns(parts)
    rows = rows.withColumn("_z", interleaved([F.col(name) for name in parts])).drop(*parts)
    return finished(rows.repartitionByRange("order_month", "_z").sortWithinPartitions("order_month", "_z")).drop("_z")
