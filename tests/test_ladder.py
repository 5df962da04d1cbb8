"""The distributed orderings against plain Python on skewed and tied values."""

from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycart.operators import ladder as L
from tallycart.operators import skew
from tallycart.operators.skew import salted_join


def skewed(seed: int, n: int = 400):
    rng = random.Random(seed)
    # a third of all entities share one value
    return [(k, Decimal("7.50") if rng.random() < 0.34 else Decimal(rng.randint(-500, 90000)) / 100) for k in range(n)]


@pytest.mark.parametrize("descending", [False, True])
def test_ladder_matches_sorted_list(spark, descending):
    data = skewed(1)
    df = spark.createDataFrame(data, "k bigint, v decimal(12,2)")
    got = {r.v: r for r in L.ladder(df, "v", descending).collect()}
    values = [v for _, v in data]
    distinct = sorted(set(values), reverse=descending)
    total = sum(values)
    for level, v in enumerate(distinct, 1):
        ahead = sum(1 for w in values if (w > v if descending else w < v))
        upto = sum(w for w in values if (w >= v if descending else w <= v))
        r = got[v]
        assert (r.ahead, r.level, r.running) == (ahead, level, upto)
        assert (r.rows_total, r.value_total, r.n) == (len(values), total, values.count(v))


def test_ranked_keeps_every_row_once(spark):
    data = skewed(2)
    df = spark.createDataFrame(data, "k bigint, v decimal(12,2)")
    out = L.ranked(df, "k", "v").collect()
    assert sorted(r.k for r in out) == [k for k, _ in data]
    for r in out:
        assert r.ahead == sum(1 for _, w in data if w > r.v)


@pytest.mark.parametrize("block", [None, 16])
def test_tiles_match_ntile_with_key_as_tie_breaker(spark, block):
    data = [(k, v, k % 3) for k, v in skewed(3, 203)]
    df = spark.createDataFrame(data, "k bigint, v decimal(12,2), f bigint")
    column = None if block is None else F.floor(F.col("k") / block)
    got = {r.k: (r.a, r.b) for r in L.tile_scores(df, "k", {"a": ("v", True), "b": ("f", False)}, 5, column).collect()}
    df.createOrReplaceTempView("t")
    want = spark.sql("SELECT k, ntile(5) OVER (ORDER BY v DESC, k) a, ntile(5) OVER (ORDER BY f, k) b FROM t").collect()
    assert got == {r.k: (r.a, r.b) for r in want}


def test_tiles_with_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k bigint, v bigint")
    assert {r.k: r.t for r in L.tile_scores(df, "k", {"t": ("v", False)}, 5).collect()} == {1: 1, 2: 2, 3: 3}


def test_quantiles_are_linear_interpolation(spark):
    values = [float(v) for _, v in skewed(4, 101)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = L.quantiles(df, "v", {"a": 0.4, "b": 0.9, "c": 0.5, "d": 0.0, "e": 1.0}).first()
    for name, share in (("a", 0.4), ("b", 0.9), ("c", 0.5), ("d", 0.0), ("e", 1.0)):
        assert row[name] == pytest.approx(np.quantile(values, share), rel=1e-12)


def test_quantiles_skip_nulls_and_survive_empty_input(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert L.quantiles(df, "v", {"m": 0.5}).first().m == 2.0
    assert L.quantiles(df.where("v > 10"), "v", {"m": 0.5}).first().m is None


def test_rung_never_breaks_the_order(spark):
    values = [Decimal(k) / 100 for k in list(range(-3000, 3000, 7)) + [10**9, 10**9 + 1, 10**13]]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,2)")
    rungs = [r.r for r in df.orderBy("v").select(L.rung_of(F.col("v"), False).alias("r")).collect()]
    assert rungs == sorted(rungs)


def test_salted_join_is_exact(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    many = spark.createDataFrame([(k, 1 if k % 3 else k) for k in range(300)], "id bigint, key bigint")
    one = many.groupBy("key").agg(F.count("*").alias("n"))
    out = salted_join(many, one, "key", "id", "n")
    assert out.count() == 300
    plain = {(r.id, r.n) for r in many.join(one, "key").collect()}
    assert {(r.id, r.n) for r in out.collect()} == plain


@pytest.mark.parametrize("kind", ["hex", "sparse"])
def test_one_value_held_by_many_random_keys_stays_in_few_blocks(spark, kind):
    """200,000 random ids that share one value: as many tie blocks as shuffle partitions, none much above its share."""
    n = 200_000
    key = F.md5(F.col("id").cast("string")) if kind == "hex" else F.xxhash64("id")
    df = spark.range(n).select(key.alias("k"), F.lit(1).cast("decimal(12,2)").alias("v"))
    out = L.tile_scores(df, "k", {"t": ("v", False)}, 5)
    got = out.groupBy("t").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).orderBy("t").collect()
    assert [r.n for r in got] == [n // 5] * 5
    assert all(a.high < b.low for a, b in zip(got, got[1:]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(parts, "k").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) <= parts and max(r["count"] for r in ranges) < 2 * n / parts
