"""Cleaning, validation, CSV and loading."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallycart.operators import cleaning, integrity
from tallycart.plans import places
from tallycart.session import scratch
from tallycart.sources import extracts, fixtures, loading
from tallycart.sources.schemas import RAW, names, raw_schema
from tallycart.sources.warehouse import Warehouse
from tests.conftest import day, rows, sale

VALUES = {
    "customers": ("1", 30, "F", "c", "s", "X", "New", Decimal("100.00"), day("2023-01-01"), Decimal("5.00"), "Gold"),
    "products": ("1", "A", "a", "b", "p", Decimal("6.00"), Decimal("10.00"), "s", day("2020-01-01")),
    "sales": ("o1", day("2024-01-10"), "1", "1", 2, Decimal("0.100"), Decimal("18.00"), Decimal("6.00"), "S1", "North", "UPI", "Online"),
    "inventory": ("1", "W1", 10, 5, 8, 1, 6, 3, 4, Decimal("4.5")),
    "returns": ("r1", "o1", "Late Delivery", Decimal("18.00"), day("2024-01-20"), "Approved", 10),
}


@pytest.fixture
def raw(spark):
    def build(entity: str, *given: dict):
        base = dict(zip(names(RAW[entity]), VALUES[entity]))
        data = [tuple({**base, **g}.values()) for g in given]
        return spark.createDataFrame(data, raw_schema(entity))

    return build


def test_customers_are_deduplicated_clipped_and_filled(raw):
    df = raw(
        "customers",
        dict(CustomerID="1", Age=-5), dict(CustomerID="1", Age=-5), dict(CustomerID="2", Age=140, Income=Decimal("200.00")),
        dict(CustomerID="3", Age=None, Income=None, LifetimeValue=None),
    )
    got = {r.CustomerID: r for r in cleaning.clean_customers(df).collect()}
    assert (got["1"].Age, got["2"].Age, got["3"].Age) == (0, 110, None)
    assert got["3"].Income == Decimal("150.00") and got["3"].LifetimeValue == 0
    assert len(got) == 3


def test_products_with_unknown_or_bad_prices_go(raw):
    df = raw(
        "products",
        dict(ProductID="1"), dict(ProductID="2", CostPrice=Decimal("0.00")), dict(ProductID="3", CostPrice=Decimal("11.00")),
        dict(ProductID="4", SellingPrice=None), dict(ProductID="5", CostPrice=Decimal("10.00")),
    )
    assert rows(cleaning.clean_products(df), "ProductID") == [("1",), ("5",)]


def test_sales_need_known_keys_and_a_quantity(raw):
    df = raw(
        "sales",
        dict(OrderID="a"), dict(OrderID="a"), dict(OrderID="b", CustomerID="9"), dict(OrderID="c", ProductID="9"),
        dict(OrderID="d", Quantity=0), dict(OrderID="e", Discount=Decimal("1.500")), dict(OrderID="f", Discount=Decimal("-0.200")),
    )
    out = cleaning.clean_sales(df, raw("customers", {}), raw("products", {}))
    assert rows(out, "OrderID", "Discount") == [("a", Decimal("0.100")), ("e", Decimal("1.000")), ("f", Decimal("0.000"))]


def test_first_per_key_follows_the_arrival(raw):
    df = raw("sales", dict(Quantity=5, SalesAmount=Decimal("9.00")), dict(Quantity=2, SalesAmount=Decimal("50.00")))
    for column, quantity in (("SalesAmount", 5), ("Quantity", 2)):
        kept = cleaning.first_per_key(df.withColumn(extracts.ARRIVAL, F.col(column)), ["OrderID"])
        assert kept.first().Quantity == quantity and kept.columns == df.columns


def test_inventory_is_clipped_but_keeps_unknown_stock(raw):
    df = raw("inventory", dict(ClosingStock=-3), dict(ClosingStock=None), dict(ProductID="9"))
    out = cleaning.clean_inventory(df, raw("products", {})).collect()
    assert sorted((r.ClosingStock for r in out), key=str) == [0, None]


def test_store_region_is_the_mode_and_the_first_on_a_tie(raw):
    regions = [("S1", "West"), ("S1", "West"), ("S1", "East"), ("S2", "West"), ("S2", "East")]
    df = raw("sales", *[dict(OrderID=str(k), Store=s, Region=r) for k, (s, r) in enumerate(regions)])
    assert rows(cleaning.derive_stores(df), "store_id", "region") == [("S1", "West"), ("S2", "East")]


def test_warehouses_take_regions_in_turn(raw):
    inventory = raw("inventory", *[dict(Warehouse=f"W{k}") for k in (3, 1, 2)])
    sales = raw("sales", dict(Region="West"), dict(Region="East"))
    assert rows(cleaning.derive_warehouses(inventory, sales), "warehouse_id", "region") == [
        ("W1", "East"), ("W2", "West"), ("W3", "East")
    ]


def test_tier_cut_is_inclusive(raw):
    people = raw("customers", *[dict(CustomerID=str(c)) for c in range(1, 12)])
    sales = raw("sales", *[dict(OrderID=str(c), CustomerID=str(c), SalesAmount=Decimal(c)) for c in range(1, 12)])
    got = {r.CustomerID: r.LoyaltyTier for r in cleaning.refresh_ltv(people, sales).collect()}
    # percentiles of 1..11 fall on 10, 8 and 5
    assert (got["10"], got["9"], got["8"], got["7"], got["5"], got["4"]) == (
        "Platinum", "Gold", "Gold", "Silver", "Silver", "Bronze",
    )


def test_cleaning_twice_changes_nothing(raw):
    people = cleaning.clean_customers(raw("customers", dict(Age=200), dict(CustomerID="2", Income=None), dict(CustomerID="2")))
    again = cleaning.clean_customers(people)
    assert sorted(map(str, people.collect())) == sorted(map(str, again.collect()))


def test_pipeline_gives_a_valid_star(make):
    wh = make(
        dim_customers=[dict(customer_id=c) for c in range(1, 120)],
        fact_sales=[sale(5 + k % 7, f"2024-0{k % 6 + 1}-15", customer=k % 119 + 1, order_id=f"{k}-1-1-1-1") for k in range(250)],
        fact_returns=[dict(order_id=f"{k}-1-1-1-1", days_after_purchase=k % 12) for k in range(0, 250, 5)],
    )
    star = cleaning.clean_all(fixtures.raw_extracts(wh))
    clean = Warehouse.of(wh.spark, star)
    assert integrity.rule_report(clean).where("violations > 0").count() == 0
    integrity.require_valid(clean)
    assert star["fact_sales"].count() == len([k for k in range(250) if k % 89 and k % 211])


@pytest.mark.parametrize(
    ("table", "rows_", "rule"),
    [
        ("dim_customers", [dict(age=111)], "age_range"),
        ("dim_customers", [dict(segment="Other")], "segment_domain"),
        ("dim_customers", [dict(), dict()], "unique_customer_id"),
        ("dim_products", [dict(cost_price=Decimal("-1.00"))], "cost_not_negative"),
        ("fact_sales", [sale(1, quantity=0)], "quantity_positive"),
        ("fact_sales", [sale(1, discount=Decimal("1.100"))], "discount_range"),
        ("fact_sales", [sale(1, product=9)], "foreign_product_id_in_dim_products"),
        ("fact_sales", [sale(1, sales_channel="Phone")], "channel_domain"),
        ("fact_inventory", [dict(supplier_rating=Decimal("5.5"))], "rating_range"),
        ("fact_inventory", [dict(), dict()], "unique_product_id_warehouse_id"),
        ("fact_returns", [dict(order_id="none")], "foreign_order_id_in_fact_sales"),
        ("fact_returns", [dict(order_id="o1", days_after_purchase=-1)], "days_not_negative"),
    ],
)
def test_strict_mode_names_the_broken_rule(make, table, rows_, rule):
    given = {"fact_returns": [dict(order_id="o1")], table: rows_}
    with pytest.raises(integrity.RuleViolation, match=f"{table}.{rule}: 1"):
        integrity.require_valid(make(**given))


def test_unknown_values_break_no_check(make):
    wh = make(dim_customers=[dict(age=None, income=None, segment=None)], fact_returns=[dict(order_id="o1")])
    integrity.require_valid(wh)


def test_load_is_idempotent_and_invisible_when_it_fails(make, spark):
    folder = scratch(spark, "store")
    first = make(fact_sales=[sale(5), sale(6)], fact_returns=[dict(order_id="o1")])
    tables = {t: first.table(t) for t in loading.ORDER}
    loading.load_all(tables, folder)
    loading.load_all(tables, folder)
    more = make(fact_sales=[sale(5), sale(6), sale(8, "2024-02-01")], fact_returns=[dict(order_id="o1")])
    loading.load_all({t: more.table(t) for t in loading.ORDER}, folder)
    stored = loading.stored_warehouse(spark, folder)
    assert rows(stored.sales, "order_id") == [("o1",), ("o2",), ("o3",)]
    assert stored.returns.count() == 1

    bad = make(fact_sales=[sale(5, quantity=0, order_id="x")], fact_returns=[dict(order_id="o1")])
    with pytest.raises(integrity.RuleViolation):
        loading.load_all({t: bad.table(t) for t in loading.ORDER}, folder)
    assert loading.stored_warehouse(spark, folder).sales.count() == 3


def test_stored_sales_are_pruned_by_month(make, spark):
    folder = scratch(spark, "store")
    wh = make(fact_sales=[sale(5, "2024-01-10"), sale(6, "2024-02-10"), sale(7, "2024-03-10")], fact_returns=[dict(order_id="o1")])
    loading.load_all({t: wh.table(t) for t in loading.ORDER}, folder)
    stored = loading.stored_warehouse(spark, folder)
    part = stored.sales_between(day("2024-02-05"), day("2024-02-28"))
    assert rows(part, "sales_amount") == [(Decimal("6.00"),)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert places.q62(stored).first().revenue == 18.0


def test_csv_round_trip_and_bad_rows(raw, spark):
    df = raw("sales", dict(OrderID="a"), dict(OrderID="b", Discount=None, Profit=None))
    path = extracts.write_csv(df, scratch(spark, "sales.csv"))
    assert sorted(map(str, extracts.read_extract(spark, path, "sales").collect())) == sorted(map(str, df.collect()))

    bad = scratch(spark, "bad.csv")
    text = df.select(*[F.when(F.col("OrderID") == "b", "?").otherwise(F.col(c).cast("string")).alias(c) for c in df.columns])
    text.write.option("header", True).csv(bad)
    got = {r.OrderID: r for r in extracts.read_tolerant(spark, bad, "sales").collect()}
    assert got["a"][extracts.CORRUPT] is None and got["a"].Quantity == 2
    assert got["?"][extracts.CORRUPT] is not None and got["?"].Quantity is None
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        extracts.read_extract(spark, bad, "sales").collect()


def test_folder_source_tells_the_file(raw, spark):
    folder = scratch(spark, "folder")
    for k in (1, 2):
        extracts.write_csv(raw("returns", dict(ReturnID=f"r{k}")), f"{folder}/part{k}")
    got = extracts.read_folder(spark, folder, "returns")
    assert rows(got, "ReturnID") == [("r1",), ("r2",)]
    assert all(f"part{r.ReturnID[1]}" in r.file_path and r.file_name.endswith(".csv") for r in got.collect())


def test_report_tables_are_written(make, spark):
    folder = scratch(spark, "report")
    wh = make(fact_sales=[sale(5, "2024-01-10"), sale(8, "2024-02-10")], fact_returns=[dict(order_id="o1")])
    from tallycart.plans import insights

    loading.write_report({"executive": insights.executive(wh)}, folder)
    assert spark.read.parquet(f"{folder}/executive").first().total_revenue == 13.0


def csv_file(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part-0.csv").write_text(text)
    return str(folder)


SALES = "OrderID,OrderDate,CustomerID,ProductID,Quantity,Discount,SalesAmount,Profit,Store,Region,PaymentMethod,SalesChannel"
GOODS = "ProductID,Category,Subcategory,Brand,ProductName,SellingPrice,CostPrice,Supplier,LaunchDate"


def test_csv_quotes_column_order_and_line_breaks(spark, tmp_path):
    text = GOODS + '\nP1,A,s,b,"24"" Monitor, black",10.00,6.00,"two\nlines",2020-01-01\n'
    row = extracts.read_extract(spark, csv_file(tmp_path, "p", text), "products", multi_line=True).first()
    assert (row.ProductName, row.Supplier) == ('24" Monitor, black', "two\nlines")
    assert (float(row.CostPrice), float(row.SellingPrice)) == (6.0, 10.0)
    path = extracts.write_csv(spark.createDataFrame([('a "b", c', None)], "x string, y string"), str(tmp_path / "out"))
    assert '"a ""b"", c"' in "".join(f.read_text() for f in (tmp_path / "out").glob("*.csv"))
    assert spark.read.option("header", True).option("escape", '"').csv(path).first().x == 'a "b", c'


def test_bad_values_fail_or_are_kept_and_missing_columns_are_named(spark, tmp_path):
    text = GOODS.replace(",", ";") + '\nP1;A;s;5" b;n;abc;6.00;sup;not-a-date\nP2;A;s;b;n;10.00;6.00;sup;2020-01-01\n'
    path = csv_file(tmp_path, "p", text)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        extracts.read_unquoted(spark, path, "products", ";").collect()
    rows = extracts.read_unquoted(spark, path, "products", ";", tolerant=True).orderBy("ProductID").collect()
    assert rows[0][extracts.CORRUPT].startswith("P1;") and rows[0].SellingPrice is None and rows[1][extracts.CORRUPT] is None
    with pytest.raises(ValueError, match="LaunchDate"):
        extracts.read_extract(spark, csv_file(tmp_path, "q", "ProductID,Category\nP1,A\n"), "products")


def test_the_first_of_several_rows_stays(spark, tmp_path):
    head = "CustomerID,Age,Gender,City,State,Country,Segment,Income,SignupDate,LifetimeValue,LoyaltyTier\n"
    first = "C1,30,F,Zurich,s,x,New,50000,2020-01-01,1,Gold\n"
    second = "C1,30,F,Aarau,s,x,New,,2020-01-01,1,Gold\nC2,40,M,c,s,x,New,90000,2020-01-01,1,Gold\n"
    path = csv_file(tmp_path, "customers", head + first + second)
    df = extracts.read_extract(spark, path, "customers", arrival=True)
    rows = {r.CustomerID: r for r in cleaning.clean_customers(df.repartition(3)).collect()}
    assert (rows["C1"].City, float(rows["C1"].Income)) == ("Zurich", 50000.0)
    assert extracts.ARRIVAL not in cleaning.clean_customers(df).columns


def test_the_sale_keeps_its_own_region(spark, tmp_path, make):
    from tallycart.plans.insights import declining_region

    row = "O1,2024-01-01,C1,P1,1,0.1,10.00,1.00,S1,East,UPI,Online\n"
    sales = extracts.read_extract(spark, csv_file(tmp_path, "sales", SALES + "\n" + row), "sales")
    assert cleaning.to_star({e: sales for e in ("customers", "products", "sales", "inventory", "returns")}, None, None)["fact_sales"].first().sale_region == "East"
    wh = make(
        dim_customers=[dict(customer_id=1, country="X")],
        fact_sales=[sale(100, "2023-02-01", sale_region="East"), sale(60, "2024-02-01", sale_region="East"), sale(5, "2024-02-01", sale_region="West")],
    )
    assert declining_region(wh).first().region == "East"


def test_customers_without_orders_count_with_zero(make):
    from tallycart.plans import customers

    wh = make(dim_customers=[dict(customer_id=1), dict(customer_id=2)], fact_sales=[sale(10, customer=1)])
    assert customers.q24(wh).count() == 1
    raw = wh.customers.selectExpr("CAST(customer_id AS STRING) AS CustomerID", "lifetime_value AS LifetimeValue", "loyalty_tier AS LoyaltyTier")
    sold = wh.sales.selectExpr("CAST(customer_id AS STRING) AS CustomerID", "sales_amount AS SalesAmount")
    assert {r.CustomerID: float(r.LifetimeValue) for r in cleaning.refresh_ltv(raw, sold).collect()} == {"1": 10.0, "2": 0.0}


def test_load_holds_the_types_of_the_star(spark, make, tmp_path):
    wh = make(fact_returns=[dict(order_id="o1")])
    tables = {t: wh.table(t) for t in loading.ORDER}
    text = dict(tables, fact_sales=tables["fact_sales"].withColumn("quantity", F.col("quantity").cast("string")))
    loading.load_all(text, str(tmp_path / "a"))
    assert dict(loading.read_table(spark, str(tmp_path / "a"), "fact_sales").dtypes)["quantity"] == "int"
    odd = dict(tables, dim_stores=tables["dim_stores"].withColumn("store_id", F.lit(1.5)))
    with pytest.raises(ValueError, match="store_id"):
        loading.load_all(odd, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="region"):
        loading.load_all(dict(tables, dim_stores=tables["dim_stores"].drop("region")), str(tmp_path / "c"))
