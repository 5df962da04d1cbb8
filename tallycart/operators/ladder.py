"""Global orderings without a single-task sort.

``ROW_NUMBER``, ``NTILE``, ``RANK``, ``PERCENT_RANK``, running shares and exact percentiles over a whole
table need, for each row, what lies ahead of it. A window without PARTITION BY would move every entity into
one task. Here the values are first collapsed to one row per distinct value (map-side combined, so a value
held by a third of all rows is one row), then cut into rungs: log-spaced intervals of the value. The rung is a
pure function of the value, so retries and re-reads agree without sampling. There are at most
2 * STEPS * log2(largest value) rungs whatever the data size; their totals are the only thing that is ordered
in one task and broadcast. Inside a rung an ordinary partitioned window finishes the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.session import staged

STEPS = 512  # rungs per factor of two
SLICES = 64  # parts that the rows of one value are spread over; a power of two


def rung_of(value: Column, descending: bool) -> Column:
    size = F.floor(F.log2(F.abs(value.cast("double")) + 1.0) * STEPS)
    signed = F.when(value < 0, -size).otherwise(size)
    # a negative value is rounded towards zero like a positive one: still monotone, and never splits a value
    return (-signed if descending else signed).cast("int")


def ladder(
    df: DataFrame, value: str, descending: bool = False, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """One row per distinct non-NULL value with its standing in the whole table (per ``by`` group).

    Adds: n (rows with the value), ahead (rows strictly before it), level (dense rank), running (sum of the value
    up to and including its peers, as a RANGE frame gives), rows_total, value_total. ``by`` must be a short list
    of constants such as metric names, because rung totals are kept per group.
    """
    by = list(by)
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    steps = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(counted.cast("bigint").alias("n"))
        .withColumn("_rung", rung_of(F.col(value), descending))
        .withColumn("_part", F.col(value) * F.col("n"))
    )
    along = Window.partitionBy(*by).orderBy("_rung")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    zero = F.lit(0)
    rungs = (
        steps.groupBy(*by, "_rung")
        .agg(F.sum("n").alias("rn"), F.sum("_part").alias("rs"), F.count(F.lit(1)).alias("rv"))
        .select(
            *by,
            "_rung",
            F.coalesce(F.sum("rn").over(before), zero).alias("_n0"),
            F.coalesce(F.sum("rs").over(before), zero).alias("_s0"),
            F.coalesce(F.sum("rv").over(before), zero).alias("_v0"),
            F.sum("rn").over(whole).alias("rows_total"),
            F.sum("rs").over(whole).alias("value_total"),
        )
    )
    inside = Window.partitionBy(*by, "_rung").orderBy(F.col(value).desc() if descending else F.col(value).asc())
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.join(F.broadcast(rungs), [*by, "_rung"]).select(
        *by,
        value,
        "n",
        (F.col("_n0") + F.sum("n").over(upto) - F.col("n")).alias("ahead"),
        (F.col("_v0") + F.row_number().over(inside)).alias("level"),
        (F.col("_s0") + F.sum("_part").over(upto)).alias("running"),
        "rows_total",
        "value_total",
    )


def quantiles(df: DataFrame, value: str, points: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolated percentiles as a one-row frame; distributed, unlike a percentile aggregate.

    Rows are first only counted per rung. The one or two rungs that hold each wanted position are then read again, so
    only their values are ever shuffled.
    """
    numbers = df.select(F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    numbers = numbers.withColumn("_rung", rung_of(F.col("_v"), False))
    before = Window.orderBy("_rung").rowsBetween(Window.unboundedPreceding, -1)
    spots = [(F.col("rows_total") - 1).cast("double") * F.lit(share) for share in points.values()]
    edges = [edge for spot in spots for edge in (F.floor(spot), F.ceil(spot))]
    holds = [(F.col("_n0") <= edge) & (edge < F.col("_n0") + F.col("rn")) for edge in edges]
    wanted = (
        numbers.groupBy("_rung")
        .agg(F.count(F.lit(1)).alias("rn"))
        .select(
            "_rung",
            "rn",
            F.coalesce(F.sum("rn").over(before), F.lit(0)).alias("_n0"),
            F.sum("rn").over(Window.partitionBy()).alias("rows_total"),
        )
        .where(reduce(lambda a, b: a | b, holds))
        .select("_rung", "_n0", "rows_total")
    )
    upto = Window.partitionBy("_rung").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = (
        numbers.join(F.broadcast(wanted), "_rung")
        .groupBy("_rung", "_v", "_n0", "rows_total")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("ahead", F.col("_n0") + F.sum("n").over(upto) - F.col("n"))
    )
    picks = []
    for name, spot in zip(points, spots):
        for end, edge in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            hit = (F.col("ahead") <= edge) & (edge < F.col("ahead") + F.col("n"))
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"{name}_{end}"))
        picks.append(F.max(spot - F.floor(spot)).alias(f"{name}_part"))
    row = steps.agg(*picks)
    return row.select(
        *[
            (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_part")).alias(n)
            for n in points
        ]
    )


def ranked(df: DataFrame, key: str, value: str, descending: bool = True) -> DataFrame:
    """Every row with the ladder columns of its value.

    Rows meet their value's standing on (value, slice of the key), so a value shared by very many rows is served by
    SLICES tasks instead of one.
    """
    sliced = df.withColumn("_slice", F.xxhash64(key).bitwiseAND(SLICES - 1))
    groups = sliced.groupBy(value, "_slice").agg(F.count(F.lit(1)).alias("in_slice"))
    # the filter keeps in_slice alive in both uses of ``groups``, so that Spark computes and shuffles them once
    standing = groups.where("in_slice > 0").join(ladder(groups, value, descending, weight="in_slice"), value)
    return sliced.join(standing, [value, "_slice"]).drop("_slice", "in_slice")


def tile_of(position: Column, total: Column, tiles: int) -> Column:
    """NTILE bucket of a 1-based row position: the first ``total % tiles`` buckets hold one row more."""
    size, extra = F.floor(total / tiles), total % tiles
    edge = extra * (size + 1)
    return (
        F.when(position <= edge, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor(F.try_divide((position - edge - 1), size)) + 1)
        .cast("bigint")
    )


def tile_scores(
    df: DataFrame, key: str, scores: Mapping[str, tuple[str, bool]], tiles: int, block: Column | None = None
) -> DataFrame:
    """NTILE over the whole table for several columns at once: ``scores`` maps output -> (column, descending).

    Rows with equal values are told apart by ascending ``key``. ``block`` is any expression that grows with the key
    and holds a bounded number of keys; it splits a value that very many rows share. By default blocks are ranges of
    the keys as they are distributed, one per shuffle partition: the rows are range-partitioned by key and written
    once with their range's number, so any kind of key gives as many blocks as tasks. All scores travel in one long
    frame, so the input is read once.
    """
    if block is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        columns = dict.fromkeys([key, *(column for column, _ in scores.values())])
        placed = df.select(*columns).repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id())
        df = staged(placed, "key-ranges")
        block = F.col("_range")
    entries = [
        F.struct(
            F.lit(name).alias("score"),
            (F.col(column) * (-1 if descending else 1)).cast("decimal(28,2)").alias("value"),
        )
        for name, (column, descending) in scores.items()
    ]
    long = df.select(key, block.alias("_block"), F.explode(F.array(*entries)).alias("e")).select(
        key, "_block", "e.score", "e.value"
    )
    groups = long.groupBy("score", "value", "_block").agg(F.count(F.lit(1)).alias("in_block"))
    within = Window.partitionBy("score", "value").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    standing = ladder(groups, "value", by=["score"], weight="in_block")
    offsets = (
        groups.withColumn("_tied", F.coalesce(F.sum("in_block").over(within), F.lit(0)))
        .join(standing.select("score", "value", "ahead", "rows_total"), ["score", "value"])
        .select("score", "value", "_block", (F.col("ahead") + F.col("_tied")).alias("_offset"), "rows_total")
    )
    own = Window.partitionBy("score", "value", "_block").orderBy(key)
    placed = long.withColumn("_own", F.row_number().over(own)).join(offsets, ["score", "value", "_block"])
    return (
        placed.withColumn("_tile", tile_of(F.col("_offset") + F.col("_own"), F.col("rows_total"), tiles))
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("score") == name, F.col("_tile"))).alias(name) for name in scores])
    )
