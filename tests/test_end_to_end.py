"""CSV extracts with text ids through cleaning and loading to the reports, as a user would run them."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycart.operators import cleaning
from tallycart.operators.ladder import tile_scores
from tallycart.plans import customers, feeds, insights, kpis, measures, places, products, returns, sequences, stock, views
from tallycart.session import scratch, staged
from tallycart.sources import extracts, loading
from tallycart.sources.schemas import raw_schema
from tallycart.sources.warehouse import Warehouse
from tests.conftest import day, rows


@pytest.fixture(scope="module")
def wh(spark):
    people = [
        (f"CUST-{c:04d}", 20 + c, "Female", "c", "s", "Xland", ("Premium", "New")[c % 2], Decimal(1000 * c), day("2023-01-05"), None, None)
        for c in range(1, 31)
    ]
    goods = [
        (f"PROD-{p}", "AB"[p % 2], f"sub{p % 3}", f"brand{p % 4}", f"good {p}", Decimal("6.00"), Decimal("10.00"), "sup", day("2023-06-01"))
        for p in range(1, 11)
    ]
    sold = [
        (f"ORD-{k:05d}", day(f"2024-{k % 12 + 1:02d}-{k % 27 + 1:02d}"), f"CUST-{k % 30 + 1:04d}", f"PROD-{k % 10 + 1}", k % 3 + 1,
         Decimal("0.100"), Decimal(9 * (k % 3 + 1)), Decimal("0.00"), f"STORE-{k % 4}", "NS"[k % 2], "UPI", ("Online", "Offline")[k % 2])
        for k in range(300)
    ]
    held = [(f"PROD-{p}", f"WH-{w}", 20, 5, 8, 1, 16, 20, 4, Decimal("4.5")) for p in range(1, 11) for w in (1, 2)]
    back = [(f"RET-{k}", f"ORD-{k:05d}", "Late Delivery", Decimal("9.00"), day("2025-01-02"), "Refunded", 5) for k in range(0, 300, 7)]
    folder = scratch(spark, "extracts")
    for entity, data in dict(customers=people, products=goods, sales=sold, inventory=held, returns=back).items():
        extracts.write_csv(spark.createDataFrame(data, raw_schema(entity)), f"{folder}/{entity}.csv")
    store = scratch(spark, "store")
    loading.load_all(cleaning.clean_all(extracts.read_extracts(spark, folder)), store)
    return loading.stored_warehouse(spark, store)


@pytest.fixture(scope="module")
def numbered(wh):
    """The same warehouse with numbers for keys: text keys are numbered in their own order."""
    tables = {t: wh.table(t) for t in loading.ORDER}
    for key, home in (("customer_id", "dim_customers"), ("product_id", "dim_products"), ("store_id", "dim_stores"), ("warehouse_id", "dim_warehouses")):
        number = F.row_number().over(Window.orderBy(key)).cast("bigint")
        numbers = staged(tables[home].select(key, number.alias("_n")), "numbers")
        for t in loading.ORDER:
            if key in tables[t].columns:
                names = tables[t].columns
                tables[t] = tables[t].join(numbers, key).drop(key).withColumnRenamed("_n", key).select(*names)
    return Warehouse.of(wh.spark, {t: staged(df, t) for t, df in tables.items()})


def values(df):
    """Rows without keys and names, rounded, in any order."""
    kept = [c for c, kind in df.dtypes if not c.endswith("_id") and kind in ("double", "bigint", "int", "date")]
    return sorted(repr([round(v, 2) if isinstance(v, float) else v for v in r]) for r in df.select(*kept).collect())


def test_reports_give_the_same_values_on_text_and_number_keys(wh, numbered):
    for module, names in (
        (kpis, "q01 q03 q05 q08 q11 q14"), (sequences, "q18 q20 q23"), (customers, "q24 q26 q28 q30 q34"), (products, "q36 q39 q42 q45"),
        (stock, "q47 q49 q51"), (returns, "q54 q57 q59"), (places, "q60 q62 q65 q66"),
    ):
        for name in names.split():
            got, want = (values(getattr(module, name)(w)) for w in (wh, numbered))
            assert got == want, name
    for name in ("v1", "v3", "r5", "g1"):
        got, want = (values(getattr(views, name)(w)) for w in (wh, numbered))
        assert got == want, name
    assert len(insights.report(wh)) == 10


def test_key_reports_run(wh):
    assert customers.q24(wh).count() == 30
    assert products.q36(wh).count() == 10
    assert kpis.q01(wh).first().total_revenue == sum(9.0 * (k % 3 + 1) for k in range(300))
    assert returns.q54(wh).first().total_returns == 43
    assert stock.q47(wh).count() == 20
    assert measures.product_rank(wh).count() == 10
    part = feeds.sliced(wh, category=["A"], channel=["Offline"], first=day("2024-03-01"))
    assert measures.base(part).first().total_orders == len([k for k in range(1, 300, 2) if k % 12 >= 2])
    assert rows(places.q60(wh), "region")[0] == ("N",)


def test_sql_names_work_on_text_ids(wh):
    views.register_sql(wh, day("2024-12-31"))
    got = wh.spark.sql("SELECT product_id FROM top_products_by_category('A')").collect()
    assert len(got) == 5 and all(r.product_id.startswith("PROD-") for r in got)
    assert wh.spark.sql("SELECT count(*) n FROM vw_customer_rfm").first().n == 30


def test_tiles_of_text_keys_match_ntile(spark):
    data = [(f"ID{k:07d}" if k % 2 else f"ID{k}", k % 4) for k in range(150)]
    df = spark.createDataFrame(data, "k string, v bigint")
    df.createOrReplaceTempView("texts")
    want = spark.sql("SELECT k, ntile(5) OVER (ORDER BY v, k) t FROM texts").collect()
    assert {r.k: r.t for r in tile_scores(df, "k", {"t": ("v", False)}, 5).collect()} == {r.k: r.t for r in want}
