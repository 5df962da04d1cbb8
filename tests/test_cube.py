"""Totals from cuboids against totals from facts, and the choice of cuboids."""

from __future__ import annotations

from itertools import combinations

import pytest

from tallycart import Warehouse
from tallycart.plans import cube, feeds, measures
from tests.conftest import sale

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def built(spark):
    wh = Warehouse.open(spark, SF)
    return wh, cube.Cube(wh, cuboids=5)


@pytest.mark.parametrize(
    ("by", "slices"),
    [
        ([], {}),
        (["month"], {}),
        (["region"], {"category": ["ECONOMY", "PROMO"]}),
        (["category", "sales_channel"], {"segment": ["Premium"], "region": ["ASIA"]}),
        (["loyalty_tier"], {"country": ["EUROPE"], "sales_channel": ["Online"]}),
        ([], {"category": ["no such category"]}),
    ],
)
def test_answers_equal_those_from_facts(built, by, slices):
    wh, made = built
    names = {"sales_channel": "channel", "loyalty_tier": "tier"}
    got = made.answer(by, **slices)
    want = measures.base(feeds.sliced(wh, **{names.get(k, k): v for k, v in slices.items()}), by)
    assert got.columns == want.columns
    if by or not slices.get("category") == ["no such category"]:
        assert rows(got) == rows(want)
    else:
        assert got.first().total_revenue is None
    assert got.inputFiles() and all("/cube/" in f for f in got.inputFiles())  # no fact is read


def test_the_smallest_covering_cuboid_answers(built):
    _, made = built
    assert len(made.held) == 6 and made.held[0] == frozenset(cube.SLICERS)
    for k in (1, 2, 3):
        for names in combinations(cube.SLICERS, k):
            best = made.smallest(names)
            assert set(names) <= best and all(made.sizes[best] <= made.sizes[s] for s in made.held if set(names) <= s)
    with pytest.raises(ValueError, match="brand"):
        made.smallest(["brand"])


def test_greedy_choice_saves_most_rows():
    size = {"a": 10, "b": 100, "c": 5}
    sizes = {s: 1 for s in cube.subsets("abc")}
    for s in sizes:
        for x in s:
            sizes[s] *= size[x]
    held = cube.chosen(sizes, frozenset("abc"), 2)
    cost = lambda held: sum(min(sizes[h] for h in held if q <= h) for q in sizes)
    assert cost(held[:2]) == min(cost([frozenset("abc"), s]) for s in sizes)
    assert cube.chosen(sizes, frozenset("abc"), 50)[-1] is not None and len(cube.chosen(sizes, frozenset("abc"), 50)) <= 8


def test_text_ids_are_refused(make):
    from pyspark.sql import functions as F

    wh = make()
    tables = {t: wh.table(t) for t in ("dim_customers", "dim_products", "dim_stores", "fact_returns")}
    tables["fact_sales"] = wh.sales.withColumn("customer_id", F.lit("K1"))
    with pytest.raises(ValueError, match="numeric"):
        cube.Cube(Warehouse.of(wh.spark, tables))


def test_customers_of_sparse_combinations_take_little_room(make, spark):
    """Two customers far apart in each of many combinations: 4 KB for each of them before."""
    people = [dict(customer_id=k * 40_000, loyalty_tier=t) for k, t in zip(range(-20, 20), ["Gold", "Silver"] * 20)]
    sales = [sale(5, f"2024-{k % 12 + 1:02d}-03", customer=k % 40 * 40_000 - 800_000, product=k % 3 + 1, sale_region="North") for k in range(600)]
    wh = make(dim_customers=people, dim_products=[dict(product_id=k, category=f"C{k}") for k in (1, 2, 3)], fact_sales=sales)
    made = cube.Cube(wh, cuboids=4)
    for by in ([], ["month"], ["loyalty_tier"], ["category", "month"]):
        assert rows(made.answer(by)) == rows(measures.base(wh, by))
    paths = [path for _, path in made.buyers.values()]
    stored = spark.read.parquet(paths[0])
    assert {kind for _, kind in stored.dtypes} <= {"string", "date", "bigint"}  # words, no binaries
    assert stored.count() == wh.sales.select("customer_id", "product_id", "order_date").distinct().count()
    assert len(set(paths)) <= len(made.held)
