"""Joins back to a per-key aggregate when one key may own a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.session import staged

TASK_ROWS = 1 << 20  # rows of one key that a task takes before the key is split
MOST_SPLIT = 10_000  # no more keys than this can be split, whatever the data size; their list is broadcast


def salted_join(many: DataFrame, one: DataFrame, key: str, spread: str, rows: str, how: str = "inner") -> DataFrame:
    """Join fact rows to a frame with one row per key; a key is spread over as many parts as its own row count asks for.

    ``one`` tells the number of fact rows of each key in its column ``rows``; ``spread`` is a fact column that varies
    within a key. Keys above TASK_ROWS rows (or a MOST_SPLIT-th of all rows, if that is more: so there are at most
    MOST_SPLIT of them) are split, on the per-key side by copying their one row. Exact: every fact row meets one copy.
    """
    one = staged(one, "per-key")
    total = one.agg(F.sum(rows)).first()[0] or 0
    size = max(TASK_ROWS, -(-total // MOST_SPLIT))
    parts = F.ceil(F.col(rows) / size).cast("int")
    heavy = one.where(F.col(rows) > size).select(key, parts.alias("_parts"))
    left = many.join(F.broadcast(heavy), key, "left")
    left = left.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")
