"""Streams against their batch results."""

from __future__ import annotations

from decimal import Decimal

import numpy as np

from tallycart.operators.integrity import stock_mismatches
from tallycart.session import scratch
from tallycart.streaming import streams
from tests.conftest import day, rows, sale


def test_duplicates_late_rows_and_unknown_keys(make, spark):
    wh = make(
        fact_sales=[
            sale(10, "2024-01-10", quantity=1, profit=Decimal("0.00")),
            sale(10, "2024-01-10", quantity=1, order_id="o1"),
            sale(5, "2024-01-11", customer=99),
            sale(5, "2024-01-12", quantity=0),
            sale(8, "2024-03-01", order_id="newest"),
        ]
    )
    later = make(
        fact_sales=[
            sale(8, "2024-03-01", order_id="newest"),  # already seen
            sale(9, "2024-01-02", order_id="late"),  # behind the watermark
            sale(7, "2024-02-20", order_id="in time"),
        ]
    ).sales
    source, sink, state = (scratch(spark, n) for n in ("in", "out", "state"))

    def run():
        arriving = streams.read_files(spark, source, wh.sales.schema)
        streams.append_to(streams.clean_orders(arriving, wh.customers, wh.products), sink, state)

    streams.in_rounds([wh.sales, later], source, run)
    got = spark.read.parquet(sink)
    assert rows(got, "order_id", "profit") == [
        ("in time", Decimal("1.00")), ("newest", Decimal("2.00")), ("o1", Decimal("4.00"))
    ]


def test_nothing_new_changes_nothing(make, spark):
    wh = make(fact_inventory=[dict(closing_stock=5), dict(product_id=2)])
    source, sink, state = (scratch(spark, n) for n in ("in", "out", "state"))

    def run():
        streams.append_to(streams.stock_alerts(streams.read_files(spark, source, wh.inventory.schema)), sink, state)

    streams.in_rounds([wh.inventory], source, run)
    run()
    assert rows(spark.read.parquet(sink), "product_id") == rows(stock_mismatches(wh.inventory), "product_id")


def test_running_value_is_the_latest_batch(make, spark):
    first = make(fact_sales=[sale(5), sale(6), sale(1, customer=2)]).sales
    second = make(fact_sales=[sale(10, order_id="z"), sale(3, customer=3, order_id="y")]).sales
    source, sink, state = (scratch(spark, n) for n in ("in", "out", "state"))

    def run():
        streams.upsert_to(streams.spend_per_customer(streams.read_files(spark, source, first.schema)), sink, state, "customer_id")

    streams.in_rounds([first, second], source, run)
    got = streams.latest(spark, sink, "customer_id")
    assert rows(got, "customer_id", "lifetime_value", "orders") == [
        (1, Decimal("21.00"), 3), (2, Decimal("1.00"), 1), (3, Decimal("3.00"), 1)
    ]


def test_windows_close_with_the_watermark(make, spark):
    sales = make(fact_sales=[sale(d, f"2024-01-{d:02d}") for d in range(1, 11)]).sales
    for length, slide, want in (
        ("1 day", None, [(day(f"2024-01-{d:02d}"), Decimal(d)) for d in range(1, 7)]),
        ("7 days", "1 day", None),
    ):
        source, sink, state = (scratch(spark, n) for n in ("in", "out", "state"))

        def run(length=length, slide=slide, source=source, sink=sink, state=state):
            arriving = streams.read_files(spark, source, sales.schema)
            streams.append_to(streams.windowed_revenue(arriving, length, slide), sink, state)

        streams.in_rounds([sales], source, run)
        got = rows(spark.read.parquet(sink), "from_day", "revenue")
        if want:
            assert got == want
        else:
            assert (day("2023-12-31"), Decimal(21)) in got and max(got)[0] == day("2023-12-31")


def spent(spark, **values):
    return spark.createDataFrame([(k, v) for k, v in values.items()], "k string, v long")


def test_upserts_touch_their_buckets_only_and_survive_a_crash(spark, monkeypatch):
    store = streams.Buckets(spark, scratch(spark, "store"), "k", count=8)
    store.upsert(spent(spark, **{f"k{i}": i for i in range(100)}), 0)
    files = len(store.read().inputFiles())
    for batch in range(1, 6):
        store.upsert(spent(spark, k7=1000 + batch, **{f"new{batch}": batch}), batch)
    assert len(store.read().inputFiles()) == files == 8  # a file per bucket, whatever the number of batches
    want = {f"k{i}": i for i in range(100)} | {"k7": 1005} | {f"new{b}": b for b in range(1, 6)}
    assert {r.k: r.v for r in store.read().collect()} == want
    last, holders = store.newest()
    assert last == 5 and holders.count(0) >= 4  # most buckets still lie where the first batch wrote them
    store.upsert(spent(spark, k7=0), 5)  # a listed batch comes again
    assert {r.k: r.v for r in store.read().collect()} == want

    plain = type(spark).createDataFrame

    def dies(self, data, schema=None, **more):
        if schema == streams.Buckets.LISTED:
            raise OSError("the driver died between files and list")
        return plain(self, data, schema, **more)

    monkeypatch.setattr(type(spark), "createDataFrame", dies)
    with __import__("pytest").raises(OSError):
        store.upsert(spent(spark, k1=-1), 6)
    monkeypatch.undo()
    assert {r.k: r.v for r in store.read().collect()} == want
    store.upsert(spent(spark, k1=-1), 6)
    assert {r.k: r.v for r in store.read().collect()} == want | {"k1": -1}
    store.upsert(spent(spark).limit(0), 7)
    assert store.newest()[0] == 6


def test_final_days_are_judged_once_by_the_days_before_them(make, spark):
    amounts = [100, 104, 96, 300, 100, 98, 103, 99, 250, 101]
    days = [sale(a, f"2024-01-{d:02d}", order_id=f"d{d}") for d, a in enumerate(amounts, 1)]
    ends = [sale(1, date, order_id=date) for date in ("2024-01-09", "2024-02-20", "2024-03-20")]  # later days move the watermark
    first, second, third = (make(fact_sales=x).sales for x in (days[:6] + ends[:1], days[6:] + ends[1:2], ends[2:]))
    source, sink, state = (scratch(spark, n) for n in ("in", "out", "state"))

    def run():
        arriving = streams.read_files(spark, source, first.schema)
        streams.judge_to(streams.windowed_revenue(arriving, "1 day"), sink, state)

    streams.in_rounds([first, second, third], source, run)
    run()
    got = {r.from_day: r for r in spark.read.parquet(f"{sink}/days").collect()}
    seen = dict(enumerate(amounts, 1))
    seen[9] += 1
    known = []
    for d, value in sorted(seen.items()):
        row = got[day(f"2024-01-{d:02d}")]
        spread = np.std(known) if len(known) >= 2 else 0
        z = (value - np.mean(known)) / spread if spread else None
        assert row.revenue == value and (row.z is None if z is None else abs(row.z - z) < 6e-4) and row.alert == (z is not None and abs(z) > 2)
        known.append(value)
    assert got[day("2024-01-04")].alert and len(got) == 11


def test_a_repeated_batch_changes_nothing(spark):
    folder = scratch(spark, "judged")
    rows = [(day(f"2024-01-{d:02d}"), float(100 + d % 3), 1) for d in range(1, 11)]
    frame = lambda part: spark.createDataFrame(part, "from_day date, revenue double, orders bigint")
    one = streams.judged(frame(rows[:6]), streams.earlier_moments(spark, folder, 0), 2.0)
    one.orderBy("from_day", ascending=False).limit(1).select(*streams.MOMENTS).write.parquet(f"{folder}/moments/batch=0")
    two = streams.judged(frame(rows[6:]), streams.earlier_moments(spark, folder, 1), 2.0)
    two.orderBy("from_day", ascending=False).limit(1).select(*streams.MOMENTS).write.parquet(f"{folder}/moments/batch=1")
    again = streams.judged(frame(rows[6:]), streams.earlier_moments(spark, folder, 1), 2.0)
    whole = streams.judged(frame(rows), (0.0, 0.0, 0.0), 2.0)
    close = lambda f: sorted((r.from_day, round(r.z or 0, 3), round(r.m2, 6)) for r in f.collect())
    assert close(two) == close(again) == close(whole)[6:]
