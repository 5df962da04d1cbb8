"""Checks of sources, sinks and the cleaning pipeline (S1-S6, C1-C11) over the dirty extracts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.functions.numeric import big, dbl, rnd
from tallycart.operators import cleaning
from tallycart.operators.integrity import rule_report
from tallycart.plans import forecasting
from tallycart.plans.refreshed import Views
from tallycart.plans.rollups import monthly
from tallycart.session import scratch, staged
from tallycart.sources import extracts, fixtures, loading
from tallycart.sources.warehouse import Warehouse

# One amount and one date column per extract.
PROFILE = {
    "customers": ("LifetimeValue", "SignupDate"),
    "products": ("SellingPrice", "LaunchDate"),
    "sales": ("SalesAmount", "OrderDate"),
    "inventory": ("ClosingStock", None),
    "returns": ("RefundAmount", "ReturnDate"),
}


def s1(wh: Warehouse) -> DataFrame:
    """S1 the five extracts written as CSV, read back typed and profiled."""
    folder = scratch(wh.spark, "extracts")
    for entity, frame in fixtures.raw_extracts(wh).items():
        if entity == "products":  # quotes and separators in a field, columns in another order
            frame = frame.withColumn("ProductName", F.concat(F.lit('24"" Monitor, "black", '), "ProductName"))
        extracts.write_csv(frame.select(*sorted(cleaning.plain(frame))), f"{folder}/{entity}.csv")
    out = None
    for entity, frame in extracts.read_extracts(wh.spark, folder).items():
        amount, day = PROFILE[entity]
        dates = F.col(day) if day else F.lit(None).cast("date")
        row = frame.agg(
            F.lit(entity).alias("entity"),
            F.count(F.lit(1)).alias("rows_read"),
            dbl(F.sum(amount)).alias("amount"),
            F.min(dates).alias("first_date"),
            F.max(dates).alias("last_date"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def s2(wh: Warehouse) -> DataFrame:
    """S2 sales lines with an unreadable date or quantity end up as corrupt records, the others stay typed."""
    k = "CAST(split_part(OrderID, '-', 1) AS BIGINT)"
    spoiled = fixtures.raw_sales(wh).selectExpr(
        "* EXCEPT (Region)",
        """concat(Region, ' "upper", east') AS Region""",
        f"CASE WHEN {k} % 103 = 0 THEN 'soon' ELSE CAST(OrderDate AS STRING) END AS d",
        f"CASE WHEN {k} % 107 = 0 THEN 'many' ELSE CAST(Quantity AS STRING) END AS q",
    )
    raw = cleaning.plain(fixtures.raw_sales(wh))
    text = spoiled.select(*[F.col({"OrderDate": "d", "Quantity": "q"}.get(c, c)).alias(c) for c in raw])
    path = extracts.write_csv(text, scratch(wh.spark, "sales.csv"))
    bad = F.col(extracts.CORRUPT).isNotNull()
    return (
        extracts.read_tolerant(wh.spark, path, "sales")
        .groupBy(bad.alias("corrupt"))
        .agg(
            F.count(F.lit(1)).alias("rows_read"),
            big(F.sum(F.when(~bad, F.col("Quantity")))).alias("good_units"),
            F.min(F.when(~bad, F.col("OrderDate"))).alias("good_from"),
        )
    )


def s3(wh: Warehouse) -> DataFrame:
    """S3 semicolon-separated text without quoting: a quote in a product name survives as data; unreadable prices are kept
    as corrupt records."""
    named = fixtures.raw_products(wh).withColumn("ProductName", F.concat(F.lit('5" '), "ProductName"))
    spoiled = F.when(F.col("ProductID").cast("bigint") % 103 == 0, F.lit("abc")).otherwise(F.col("SellingPrice").cast("string"))
    path = scratch(wh.spark, "products.csv")
    named.withColumn("SellingPrice", spoiled).select(*sorted(cleaning.plain(named))).write.option("header", True).option("sep", ";").option("quote", "").csv(path)
    return (
        extracts.read_unquoted(wh.spark, path, "products", sep=";", tolerant=True)
        .groupBy("Category")
        .agg(
            F.count(F.lit(1)).alias("rows_read"),
            big(F.sum(F.when(F.col("ProductName").startswith('5" '), 1).otherwise(0))).alias("with_quote"),
            dbl(F.sum("SellingPrice")).alias("price"),
            F.count(extracts.CORRUPT).alias("unreadable"),
        )
        .withColumnRenamed("Category", "category")
    )


def s4(wh: Warehouse) -> DataFrame:
    """S4 a folder with one subfolder per year, read as a whole; the path tells where a row came from."""
    folder = scratch(wh.spark, "by_year")
    sales = fixtures.raw_sales(wh)
    order = F.split_part("OrderID", F.lit("-"), F.lit(1)).cast("bigint")
    spoiled = F.when(order % 109 == 0, F.lit("n/a")).otherwise(F.col("SalesAmount").cast("string"))
    sales = sales.withColumn("SalesAmount", spoiled).select(*sorted(cleaning.plain(sales)), F.year("OrderDate").alias("y"))
    sales.write.partitionBy("y").option("header", True).csv(folder)
    year = F.regexp_extract("file_path", r"/y=(\d+)/", 1)
    return (
        extracts.read_folder(wh.spark, folder, "sales", tolerant=True)
        .groupBy(year.cast("bigint").alias("folder_year"))
        .agg(F.count(F.lit(1)).alias("rows_read"), dbl(F.sum("SalesAmount")).alias("amount"), F.count(extracts.CORRUPT).alias("unreadable"))
    )


def two_loads(wh: Warehouse) -> str:
    """A store with half of the orders loaded first, then everything: the half that is already stored is skipped."""
    folder = scratch(wh.spark, "loaded")
    tables = {t: wh.table(t) for t in loading.ORDER}
    tables["fact_sales"] = tables["fact_sales"].drop("order_month")
    half = dict(tables)
    half["fact_sales"] = tables["fact_sales"].where("CAST(split_part(order_id, '-', 1) AS BIGINT) % 2 = 0")
    half["fact_returns"] = tables["fact_returns"].join(half["fact_sales"].select("order_id"), "order_id", "left_semi")
    half["fact_returns"] = half["fact_returns"].select(*tables["fact_returns"].columns)
    loading.load_all(half, folder)
    loading.load_all(tables, folder)
    return folder


_stores: dict[tuple[str, str], str] = {}


def refreshed(wh: Warehouse) -> Views:
    """The views that two loads have kept up to date; one store per application and source."""
    key = (wh.spark.sparkContext.applicationId, wh.source or uuid.uuid4().hex)
    if key not in _stores:
        _stores[key] = two_loads(wh)
    return Views(wh.spark, f"{_stores[key]}/_states", loading.finished_loads(wh.spark, _stores[key]))


def s5(wh: Warehouse) -> DataFrame:
    """S5 rows that a store holds after two loads with common rows."""
    folder, out = two_loads(wh), None
    for table in loading.ORDER:
        row = loading.read_table(wh.spark, folder, table).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows_stored")
        )
        out = row if out is None else out.unionByName(row)
    return out


def s6(wh: Warehouse) -> DataFrame:
    """S6 monthly revenue written as CSV and read back."""
    path = extracts.write_csv(monthly(wh).select("month", "revenue"), scratch(wh.spark, "monthly.csv"))
    back = wh.spark.read.schema("month date, revenue decimal(18,2)").option("header", True).csv(path)
    return back.select("month", dbl("revenue").alias("revenue"))


def s10(wh: Warehouse, last) -> DataFrame:
    """S10 a forecast table written as the forecast file and imported again with its fixed types."""
    table = forecasting.total_outlook(wh, last)
    numbers = ("Forecasted_Revenue", "Lower_95CI", "Upper_95CI")
    path = extracts.write_csv(table.select("Month", *[rnd(c).alias(c) for c in numbers]), scratch(wh.spark, "forecast.csv"))
    return extracts.read_extract(wh.spark, path, "forecast")


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as double and small integers as bigint, for comparison with other engines."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        column = F.col(field.name)
        out.append(column.cast("double") if kind.startswith("decimal") else column.cast("bigint") if kind == "int" else column)
    return df.select(*[c.alias(n) for c, n in zip(out, df.columns)])


_cleaned: dict[tuple[str, str | None], dict[str, DataFrame]] = {}


def cleaned(wh: Warehouse) -> dict[str, DataFrame]:
    """The cleaned star schema, written once per application and source and read by all checks."""
    key = (wh.spark.sparkContext.applicationId, wh.source)
    if wh.source is None or key not in _cleaned:
        made = {name: staged(df, name) for name, df in cleaning.clean_all(fixtures.raw_extracts(wh)).items()}
        if wh.source is None:
            return made
        _cleaned[key] = made
    return _cleaned[key]


def _as_given(wh: Warehouse) -> Warehouse:
    """The dirty extracts under star-schema names, without any cleaning."""
    raw = fixtures.raw_extracts(wh)
    stores, places = cleaning.derive_stores(raw["sales"]), cleaning.derive_warehouses(raw["inventory"], raw["sales"])
    tables = cleaning.to_star(raw, stores, places)
    return Warehouse.of(wh.spark, {name: staged(df, name) for name, df in tables.items()})


def c1(wh: Warehouse) -> DataFrame:
    """C1 cleaned customers."""
    return _doubles(cleaning.clean_customers(fixtures.raw_customers(wh)))


def c2(wh: Warehouse) -> DataFrame:
    """C2 cleaned products."""
    return _doubles(cleaning.clean_products(fixtures.raw_products(wh)))


def c3(wh: Warehouse) -> DataFrame:
    """C3 cleaned sales."""
    customers = fixtures.raw_customers(wh).select("CustomerID").distinct()  # cleaning drops no customer
    products = cleaning.clean_products(fixtures.raw_products(wh))
    return _doubles(cleaning.clean_sales(fixtures.raw_sales(wh), customers, products))


def c4(wh: Warehouse) -> DataFrame:
    """C4 cleaned inventory."""
    products = cleaning.clean_products(fixtures.raw_products(wh))
    return _doubles(cleaning.clean_inventory(fixtures.raw_inventory(wh), products))


def c5(wh: Warehouse) -> DataFrame:
    """C5 cleaned returns."""
    return _doubles(cleaned(wh)["fact_returns"])


def c6(wh: Warehouse) -> DataFrame:
    """C6 stores with their modal region."""
    return cleaned(wh)["dim_stores"]


def c7(wh: Warehouse) -> DataFrame:
    """C7 warehouses with their region in turn."""
    return cleaned(wh)["dim_warehouses"]


def c8(wh: Warehouse) -> DataFrame:
    """C8 customers with refreshed value and tier."""
    return _doubles(cleaned(wh)["dim_customers"].select("customer_id", "lifetime_value", "loyalty_tier"))


def c10(wh: Warehouse) -> DataFrame:
    """C10 rule violations of the uncleaned extracts."""
    return rule_report(_as_given(wh))


def c10_clean(wh: Warehouse) -> DataFrame:
    """C10 rule violations after cleaning: none."""
    return rule_report(Warehouse.of(wh.spark, cleaned(wh)))


def c11(wh: Warehouse) -> DataFrame:
    """C11 sanity figures."""
    return cleaning.sanity(wh.sales, wh.returns)
