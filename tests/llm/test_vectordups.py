"""Near-duplicate vectors against all pairs, hot groups cut into packs, and the hashing itself."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tallycart.llm import registry, vectordups
from tallycart.llm.vectordups import Hashing, Settings

COLUMNS = ["vec_id", "n_links", "component_id", "kept"]
SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, limit=0.95):
    """vec_id -> (links, component, kept) from all pairs."""
    good = {k: np.asarray(v, dtype=np.float64) for k, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    lengths = sorted({len(v) for v in good.values()}, key=lambda d: (-sum(len(v) == d for v in good.values()), d))
    ids = sorted(k for k in good if len(good[k]) == lengths[0]) if good else []
    out = {k: (0, k, True) for k, _ in rows}
    if ids:
        m = np.array([good[k] / np.linalg.norm(good[k]) for k in ids])
        linked = m @ m.T >= limit
        np.fill_diagonal(linked, False)
        label = np.arange(len(ids))
        while True:
            least = np.minimum(label, np.where(linked, label, len(ids)).min(axis=1))
            if (least == label).all():
                break
            label = least
        out |= {k: (int(linked[i].sum()), ids[label[i]], bool(label[i] == i)) for i, k in enumerate(ids)}
    return out


def found(frame, **named):
    got = vectordups.linked_vectors(frame, **named)
    assert got.columns == COLUMNS
    return {r.vec_id: tuple(r)[1:] for r in got.collect()}


def groups(seed, sizes, spread, d=32, extra=200):
    """Groups of vectors around common ones, apart by about ``spread``, among unrelated vectors."""
    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal((extra, d))]
    for n in sizes:
        centre = rng.standard_normal(d)
        parts.append(centre + rng.standard_normal((n, d)) * spread * np.linalg.norm(centre) / math.sqrt(d))
    vectors = np.concatenate(parts).astype(np.float32)
    return list(enumerate(vectors[rng.permutation(len(vectors))].tolist()))


@pytest.mark.parametrize("spread", [0.02, 0.16, 0.23])
def test_equals_all_pairs(spark, spread):
    rows = groups(3, [2, 3, 5, 40, 120], spread)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_hot_groups_in_packs_over_several_partitions(spark):
    """Packs of 16: buckets are cut, lie in several partitions, and their packs meet in a grid of tasks."""
    rows = groups(4, [400, 90], 0.15)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in names}
    try:
        spark.conf.set(names[0], "7")
        spark.conf.set(names[1], "false")
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(5), settings=Settings(pack=16, grid=4)) == plain(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_chain_is_one_component(spark):
    turn = [[math.cos(a), math.sin(a), 0.0] for a in np.arange(12) * 0.3]
    rows = list(enumerate([*turn, [0.0, 0.0, 5.0]]))
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows) and got[11] == (1, 0, False) and got[12] == (0, 12, True)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [3.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]),  # of one direction, two of them equal
        (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [nan, 1.0, 0.0]), (8, [inf, 0.0, 0.0]), (9, [1.0, 0.0]), (10, []),
        (11, [0.0, 1e-30, 0.0]), (12, [0.0, 1e30, 0.0]), (-5, [0.0, 0.0, 2.0]),
    ]
    frame = spark.createDataFrame([(*r, 1, "x", True) for r in rows], SCHEMA + ", n_links int, code string, kept boolean")
    got = found(frame)
    assert got == plain(rows) and got[3] == (2, 1, False) and got[12] == (1, 11, False) and got[4] == (0, 4, True)


def test_repeated_ids_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, None), (3, [0.0, 2.0]), (3, [1.0, 0.1]), (None, [1.0, 0.0]), (None, None)]
    got = sorted(map(tuple, vectordups.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False), (None, 0, None, True), (None, 0, None, True)], key=str)


@pytest.mark.parametrize("rows", [[], [(4, None)], [(4, [1.0, 2.0])], [(4, [1.0, 2.0]), (9, [1.0, 2.0])]])
def test_next_to_nothing(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_a_cosine_at_the_limit_is_a_link(spark):
    rows = [(1, [3.0, 4.0]), (2, [4.0, 3.0])]  # 24 / 25
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), settings=Settings(limit=0.96)) == {1: (1, 1, True), 2: (1, 1, False)}
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), settings=Settings(limit=0.9600001))[2] == (0, 2, True)


def test_tables_miss_a_pair_at_the_limit_as_seldom_as_stated():
    s = Settings(miss=0.02)
    hashing = Hashing.of(5000, 32, s)
    rng = np.random.default_rng(9)
    a = vectordups.unit(rng.standard_normal((3000, 32)))
    off = rng.standard_normal((3000, 32))
    off = vectordups.unit(off - (off * a).sum(axis=1, keepdims=True) * a)
    b = s.limit * a + math.sqrt(1 - s.limit**2) * off
    keys, sketches = hashing.functions()
    met = (keys(a) == keys(b)).any(axis=1).mean()
    assert 0.97 < met < 1 and (keys(a)[:1500] == keys(off)[:1500]).mean() < 3 * s.mates / 5000
    apart = np.unpackbits(sketches(a) ^ sketches(b), axis=1).sum(axis=1)
    assert (apart > s.most_apart).mean() < 1e-3


def test_keys_do_not_depend_on_the_batch():
    hashing = Hashing.of(10_000, 48, Settings())
    keys, sketches = hashing.functions()
    x = vectordups.unit(np.random.default_rng(2).standard_normal((200, 48)))
    assert all((keys(x[i : i + 1]) == keys(x)[i]).all() and (sketches(x[i : i + 1]) == sketches(x)[i]).all() for i in range(0, 200, 17))


def test_tables_grow_slowly():
    plans = [Hashing.of(n, 64, Settings()) for n in (100, 10_000, 10**6, 10**9)]
    assert [h.k for h in plans] == sorted(h.k for h in plans) and plans[-1].tables < 400


def test_query_covers_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {r.vec_id: tuple(r)[1:] for r in registry.QUERIES["op12_vectordups"](spark, "/root/testdata/sf0.01").collect()}
    assert got == plain([(r.vec_id, r.embedding) for r in table.collect()])
