"""The forest against the same trees grown row by row, its draws, and its independence of how rows lie."""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycart import Warehouse
from tallycart.plans import forest, statistics
from tallycart.session import passing, staged
from tests.conftest import sale


def grown(x, y, w, level, depth, gains):
    """Predictions of a tree grown row by row on binned inputs; the lowered squares are added to ``gains``."""
    mean = (w * y).sum() / w.sum() if w.sum() else 0.0
    best = (0.0, None)
    if level < depth:
        for k in range(x.shape[1]):
            for cut in range(forest.BINS - 1):
                left = x[:, k] <= cut
                if not (w[left].sum() and w[~left].sum()):
                    continue
                sides = [(w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)]
                gain = sum(sides) - (w * y).sum() ** 2 / w.sum()
                if gain > max(best[0], 1e-9):
                    best = (gain, (k, cut))
    if best[1] is None:
        return lambda rows: np.full(len(rows), mean)
    k, cut = best[1]
    gains[k] += best[0]
    left = x[:, k] <= cut
    a, b = (grown(x[s], y[s], w[s], level + 1, depth, gains) for s in (left, ~left))
    return lambda rows: np.where(rows[:, k] <= cut, a(rows), b(rows))


def test_forest_equals_trees_grown_row_by_row(spark):
    rng = np.random.default_rng(5)
    n, trees, depth = 900, 4, 4
    x = np.stack([rng.integers(0, 8, n), rng.integers(0, 300, n), np.zeros(n, int)], axis=1)
    y = 3.0 * x[:, 0] + np.where(x[:, 1] > 140, 11.0, 0.0) + rng.integers(0, 9, n)
    keys = rng.integers(0, 400, n)  # some come again
    rows = spark.createDataFrame([(*map(float, r), float(t), int(k)) for r, t, k in zip(x, y, keys)], "a double, b double, c double, y double, k bigint").withColumn("out", F.col("k") % 4 == 0)
    with passing(spark):
        weights, score = forest.fitted(staged(rows, "rows"), ["a", "b", "c"], "y", "k", "out", trees, depth, 7)
    train = keys % 4 != 0
    cuts = [forest.cuts_of(x[train][:, j].astype(float)) for j in range(3)]
    bins = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(3)], axis=1)
    cells = (bins * forest.BINS ** np.arange(3)).sum(axis=1)
    order = np.lexsort((y[train], keys[train], cells[train]))
    bx, by, hashes = bins[train][order], y[train][order], forest.apart(cells[train][order], keys[train][order].astype(np.int64))
    assert len(set(zip(cells[train][order], hashes))) == train.sum()  # no two rows of a cell draw alike
    share, guess = np.zeros(3), np.zeros((~train).sum())
    for w in forest.weights(hashes, trees, 7):
        gains = np.zeros(3)
        guess += grown(bx, by, w.astype(float), 0, depth, gains)(bins[~train]) / trees
        share += gains / gains.sum() / trees
    rest = y[~train]
    assert weights == pytest.approx(share, abs=1e-9) and weights[2] == 0
    assert score == pytest.approx(1 - ((rest - guess) ** 2).sum() / ((rest - rest.mean()) ** 2).sum(), abs=1e-9)


def test_draws_are_poisson_and_differ_by_tree():
    hashes = np.arange(200_000, dtype=np.int64)
    draws = list(forest.weights(hashes, 3, 42))
    for w in draws:
        for k in range(6):
            chance = math.exp(-1) / math.factorial(k)
            assert abs((w == k).mean() - chance) < 5 * math.sqrt(chance / len(w))
    for a, b in ((0, 1), (0, 2), (1, 2)):
        assert abs(np.corrcoef(draws[a], draws[b])[0, 1]) < 0.01
    assert all((a == b).all() for a, b in zip(draws, forest.weights(hashes, 3, 42)))
    edges = np.array([0, *(int(t) + d for t in forest.POISSON[:6] for d in (-1, 0)), 2**32 - 1], np.uint32)
    assert forest.drawn(edges).tolist() == np.searchsorted(forest.POISSON, edges, side="right").tolist()


def test_importance_does_not_depend_on_how_rows_lie(make):
    """Draws followed partitions before, so the same sales in other files had another forest."""
    rng = np.random.default_rng(3)
    sales = [sale(round(float(rng.uniform(10, 90)), 2), customer=k % 40, quantity=int(q), profit=Decimal(int(rng.integers(0, 50)) + int(q))) for k, q in enumerate(rng.integers(1, 10, 500))]
    people = [dict(customer_id=c, age=20 + c, income=Decimal(1000 * (c % 7 + 1))) for c in range(40)]
    wh = make(fact_sales=sales, dim_customers=people)
    other = Warehouse.of(wh.spark, {"fact_sales": wh.sales.orderBy(F.desc("order_id")).repartition(7), "dim_customers": wh.customers})
    a, b = ([(r.feature, pytest.approx(r.importance), pytest.approx(r.test_r_squared)) for r in statistics.importance(w, trees=8, depth=4).collect()] for w in (wh, other))
    assert [(n, i.expected, s.expected) for n, i, s in a] == b


def test_no_rows_and_one_value(make):
    with pytest.raises(ValueError, match="no rows"):
        statistics.importance(make(fact_sales=[]), trees=2, depth=2)
    same = [sale(5, customer=1, profit=Decimal(3)) for _ in range(40)]
    got = statistics.importance(make(fact_sales=same), trees=2, depth=2).collect()
    assert len(got) == 5 and all(r.importance == 0 for r in got)
