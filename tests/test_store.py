"""The stored star schema: key lookups, compaction, refreshed views, layout."""

from __future__ import annotations

import datetime as dt
import glob
import random
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallycart import Warehouse
from tallycart.operators import integrity
from tallycart.plans import views
from tallycart.plans.refreshed import Views
from tallycart.session import LEAN, scratch, shared_dir
from tallycart.sources import keyindex, layout, loading
from tests.conftest import sale


def batch(make, orders, customers=range(1, 6), months=(1, 2), text=False):
    """A star with the given order numbers."""
    name = (lambda k: f"K{k}") if text else (lambda k: k)
    wh = make(
        dim_customers=[dict(customer_id=k) for k in customers],
        dim_products=[dict(product_id=k) for k in (1, 2, 3)],
        fact_sales=[sale(k % 7 + 1, f"2024-{months[k % len(months)]:02d}-{k % 28 + 1:02d}", customer=customers[k % len(customers)], product=k % 3 + 1, order_id=f"o{k:06d}") for k in orders],
        fact_inventory=[dict(product_id=k, closing_stock=6) for k in (1, 2, 3)],
        fact_returns=[dict(order_id=f"o{k:06d}", return_id=f"r{k:06d}") for k in list(orders)[:3]],
    )
    tables = {t: wh.table(t) for t in loading.ORDER}
    if text:
        for t in ("dim_customers", "fact_sales"):
            tables[t] = tables[t].withColumn("customer_id", F.concat(F.lit("K"), F.col("customer_id")))
    return tables


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_filters_pass_all_stored_keys_and_few_others(spark):
    path = scratch(spark, "filter")
    keys = spark.range(0, 20_000).withColumnRenamed("id", "k")
    keyindex.write_filter(keys, ["k"], 20_000, path)
    held = [keyindex.Held("a", 20_000, "0", "19999")]
    asked = spark.range(10_000, 120_000).withColumnRenamed("id", "k")
    got = keyindex.candidates(spark, asked, ["k"], held, lambda load: path)
    assert got.where("k < 20000").count() == 10_000 and got.where("k >= 20000").count() < 5
    assert keyindex.candidates(spark, spark.range(20_000, 30_000).withColumnRenamed("id", "k"), ["k"], held, lambda load: path).count() == 0


def test_ranges_compare_numbers_as_numbers():
    assert keyindex.Held("a", 3, "9", "11").meets(10, 10) and not keyindex.Held("a", 3, "9", "11").meets(12, 20)
    assert keyindex.Held("a", 3, "b", "d").meets("c", "c") and not keyindex.Held("a", 3, "b", "d").meets("e", "f")
    assert not keyindex.Held("a", 0, None, None).meets(1, 2) and not keyindex.Held("a", 3, "1", "2").meets(None, None)


def test_a_load_reads_only_loads_that_hold_its_keys(make, spark, monkeypatch):
    folder = scratch(spark, "store")
    ids = [loading.load_all(batch(make, range(k * 100, k * 100 + 60)), folder) for k in (1, 2, 3)]
    read = []
    plain = loading.read_loads

    def recorded(spark_, folder_, table, loads):
        read.append((table, tuple(loads)))
        return plain(spark_, folder_, table, loads)

    monkeypatch.setattr(loading, "read_loads", recorded)
    monkeypatch.setattr(keyindex, "DIRECT", 0)
    new = loading.load_all(batch(make, range(5000, 5060)), folder)
    assert [x for x in read if x[0] == "fact_sales"] == []  # nothing in common: no stored sale is read
    read.clear()
    loading.load_all(batch(make, range(250, 330)), folder)  # orders of two loads come again
    assert ("fact_sales", tuple(sorted(ids[1:]))) in read and {i for t, x in read if t == "fact_sales" for i in x} == set(ids[1:])
    monkeypatch.undo()
    stored = loading.stored_warehouse(spark, folder)
    want = {f"o{k:06d}" for k in [*(k * 100 + j for k in (1, 2, 3) for j in range(60)), *range(5000, 5060), *range(250, 330)]}
    assert sorted(r.order_id for r in stored.sales.collect()) == sorted(want)
    assert stored.customers.count() == 5 and stored.inventory.count() == 3 and new in loading.finished_loads(spark, folder)


def test_a_foreign_key_may_be_met_by_an_earlier_load(make, spark):
    folder = scratch(spark, "store")
    loading.load_all(batch(make, range(50)), folder)
    later = batch(make, range(100, 120))
    back = make(fact_returns=[dict(order_id="o000007", return_id="late")]).table("fact_returns")
    loading.load_all(dict(later, fact_returns=back), folder)
    assert loading.stored_warehouse(spark, folder).returns.where("return_id = 'late'").count() == 1
    lost = make(fact_returns=[dict(order_id="o999999", return_id="lost")]).table("fact_returns")
    with pytest.raises(integrity.RuleViolation, match="fact_returns.foreign_order_id_in_fact_sales: 1"):
        loading.load_all(dict(later, fact_returns=lost), folder)
    nobody = dict(later, fact_sales=batch(make, range(200, 210), customers=[99])["fact_sales"])
    with pytest.raises(integrity.RuleViolation, match="fact_sales.foreign_customer_id_in_dim_customers: 10"):
        loading.load_all(nobody, folder)
    broken = dict(later, fact_sales=batch(make, range(300, 303))["fact_sales"].withColumn("quantity", F.lit(0)))
    with pytest.raises(integrity.RuleViolation, match="fact_sales.quantity_positive: 3"):
        loading.load_all(broken, folder)
    loading.load_all(broken, folder, strict=False)
    assert loading.stored_warehouse(spark, folder).sales.where("quantity = 0").count() == 3


@pytest.mark.parametrize("text", [False, True])
def test_views_after_loads_equal_views_over_all_rows(make, spark, text):
    folder = scratch(spark, "store")
    for k, people in enumerate(([1, 2, 3], [2, 4, 5])):
        loading.load_all(batch(make, range(k * 50, k * 50 + 70), people, months=(1, 2, 3 + k), text=text), folder)
    as_of = dt.date(2024, 12, 31)
    for _ in range(2):
        whole = loading.stored_warehouse(spark, folder)
        fresh = Views(spark, f"{folder}/_states", loading.finished_loads(spark, folder))
        assert same(fresh.v1(), views.v1(whole)) and same(fresh.v2(as_of), views.v2(whole, as_of))
        assert same(fresh.v3(), views.v3(whole)) and same(fresh.v4(), views.v4(whole))
        assert all("fact_" not in f for frame in fresh.all().values() for f in frame.inputFiles())
        loading.compact(spark, folder)
    assert len(loading.finished_loads(spark, folder)) == 1


def test_compaction_keeps_rows_and_a_crash_changes_nothing(make, spark, monkeypatch):
    folder = scratch(spark, "store")
    for k in range(2):
        loading.load_all(batch(make, range(k * 40, k * 40 + 50)), folder)
    before = {t: sorted(map(str, loading.read_table(spark, folder, t).collect())) for t in loading.ORDER}
    loads = loading.finished_loads(spark, folder)

    def dies(*_):
        raise OSError("the driver died")

    for step, work in (("_list", lambda: loading.compact(spark, folder)), ("write_filter", lambda: loading.load_all(batch(make, range(900, 910)), folder))):
        monkeypatch.setattr(loading, step, dies)
        with pytest.raises(OSError):
            work()
        monkeypatch.undo()
        assert loading.finished_loads(spark, folder) == loads
    new = loading.compact(spark, folder)
    assert loading.finished_loads(spark, folder) == [new] and loading.compact(spark, folder) is None
    assert {t: sorted(map(str, loading.read_table(spark, folder, t).collect())) for t in loading.ORDER} == before
    assert loading.stored_warehouse(spark, folder).sales.count() == 90


def test_interleaved_bits_and_parts(spark):
    rng = random.Random(3)
    cuts = sorted(rng.sample(range(1000), 31))
    frame = spark.createDataFrame([(k, rng.randrange(32), rng.randrange(32)) for k in range(1000)], "x int, a int, b int")
    for r in frame.select("*", layout.part(F.col("x"), cuts).alias("p"), layout.interleaved([F.col("a"), F.col("b")]).alias("z")).collect():
        assert r.p == sum(r.x >= c for c in cuts)
        want = 0
        for bit in range(layout.BITS):
            want |= ((r.b >> bit) & 1) << (2 * bit) | ((r.a >> bit) & 1) << (2 * bit + 1)
        assert r.z == want


def skipped(files, column, value):
    """Row groups that a filter on one key must read, of how many."""
    met = total = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            met += stats.min <= value <= stats.max
    return met, total


def test_filters_on_every_key_skip_most_row_groups(spark, make):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in names}
    try:
        spark.conf.set(names[0], "160")  # many files, as a large table has
        spark.conf.set(names[1], "false")
        sales = Warehouse.open(spark, "/root/testdata/sf0.01").sales.drop("order_month").where("order_date >= '1997-01-01' and order_date < '1997-03-01'")
        path = scratch(spark, "curved")
        loading.write_table(sales, "fact_sales", path)
        assert same(spark.read.parquet(path).drop("order_month"), sales)
        files = glob.glob(f"{path}/*/*.parquet")
        row = sales.orderBy("order_id").first()
        for key in layout.CURVE:
            met, total = skipped(files, key, row[key])
            assert total > 60 and met < 0.55 * total, (key, met, total)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_limits_of_few_or_no_rows(spark, make):
    wh = make(fact_sales=[sale(5)])
    assert loading.write_table(wh.sales, "fact_sales", scratch(spark, "one"))[0].rows == 1
    none, counts = loading.write_table(wh.sales.where(F.lit(False)), "fact_sales", scratch(spark, "none"))
    assert (none.rows, none.low) == (0, None) and set(counts.values()) == {0}


def shuffle_files(spark):
    """Shuffle files that the session holds."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}


def staged_names(spark):
    return {f for f in glob.glob(f"{shared_dir(spark).removeprefix('file://')}/scratch/*/*")}


def test_loads_leave_neither_shuffle_files_nor_staged_frames(make, spark, monkeypatch):
    monkeypatch.setattr(keyindex, "DIRECT", 0)
    folder, settings = scratch(spark, "store"), {k: spark.conf.get(k, None) for k in LEAN}
    tables = [batch(make, range(60)), batch(make, [*range(30, 90), 70])]
    files, names = shuffle_files(spark), staged_names(spark)
    for some in tables:
        loading.load_all(some, folder)
    for _ in range(40):  # files go beside the main thread
        if not (left := shuffle_files(spark) - files):
            break
        time.sleep(0.25)
    assert not left and not {f for f in staged_names(spark) - names if not f.endswith("/store")}
    assert {k: spark.conf.get(k, None) for k in LEAN} == settings
    assert sorted(r.order_id for r in loading.stored_warehouse(spark, folder).sales.collect()) == [f"o{k:06d}" for k in range(90)]


def test_order_lines_go_once_both_facts_are_written(spark, tmp_path):
    for name in ("region", "part", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    wh = Warehouse.open(spark, str(tmp_path))
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet").count()
    before, files = staged_names(spark), shuffle_files(spark)
    sales = wh.sales
    assert any(f.endswith("/lines") for f in staged_names(spark) - before)
    returns = wh.returns
    assert not [f for f in staged_names(spark) - before if f.endswith("/lines")]
    for _ in range(40):
        if not (left := shuffle_files(spark) - files):
            break
        time.sleep(0.25)
    assert not left
    assert sales.count() == lines and returns.count() > 0 and wh.sales.count() == lines
