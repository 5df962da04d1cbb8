"""The star schema every report reads.

``Warehouse.open`` derives it from the driver's parquet tables (FIXTURES.md section 3), one table at a time and only
when a report asks for it. A derived table is written once per application as Parquet in the shared folder
(fact_sales partitioned by order month) and read from there afterwards: the derivation joins are paid once,
reports get pruned columnar scans, and lineage ends at files that outlive an executor.
``Warehouse.of`` wraps frames the caller already has, ``Warehouse.stored`` a loaded folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.functions.bands import TIER_LABELS, at_least
from tallycart.operators.ladder import quantiles
from tallycart.session import delete, lean, scratch, shared_dir
from tallycart.sources.layout import curved
from tallycart.sources.schemas import STAR, names, struct

_written: dict[tuple[str, str, str], DataFrame] = {}
_lines_at: dict[tuple[str, str], str] = {}

# Code lists of the fixture derivation.
PAYMENT = {"1-URGENT": "Credit Card", "2-HIGH": "Debit Card", "3-MEDIUM": "UPI", "4-NOT SPECIFIED": "Wallet"}
SEGMENT = {"AUTOMOBILE": "Premium", "FURNITURE": "Budget", "MACHINERY": "New"}
REASONS = (
    "Defective Product", "Wrong Item Delivered", "Size/Fit Issue", "Changed Mind", "Better Price Found Elsewhere",
    "Late Delivery", "Quality Not as Expected", "Damaged in Transit",
)

# What the facts need of an order line, its order and its part.
LINE = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
    "l_linestatus", "o_custkey", "o_orderdate", "o_orderpriority", "p_partkey", "p_retailprice",
)

PRICE = "CAST(p_retailprice AS DECIMAL(10,2))"
COST = (
    f"CAST(round({PRICE} * CAST(60 + 5 * (p_partkey % 8) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)), 2)"
    " AS DECIMAL(10,2))"
)
AMOUNT = (
    f"CAST(round({PRICE} * CAST(l_quantity AS INT) * (1 - CAST(l_discount AS DECIMAL(5,3))), 2) AS DECIMAL(12,2))"
)


def _mapped(column: str, codes: Mapping[str, str], rest: str):
    out = F
    for code, label in codes.items():
        out = out.when(F.col(column) == code, label)
    return out.otherwise(rest)


class Warehouse:
    """Seven star-schema tables as DataFrames: sales, products, customers, stores, warehouses, inventory, returns."""

    def __init__(self, spark: SparkSession, supply: Callable[[str], DataFrame], source: str | None = None):
        self.spark = spark
        self.source = source
        self._supply = supply

    @classmethod
    def open(cls, spark: SparkSession, source_dir: str) -> Warehouse:
        return cls(spark, Derivation(spark, source_dir).table, source_dir)

    @classmethod
    def of(cls, spark: SparkSession, tables: Mapping[str, DataFrame]) -> Warehouse:
        return cls(spark, lambda name: tables[name])

    @classmethod
    def stored(cls, spark: SparkSession, folder: str) -> Warehouse:
        return cls(spark, lambda name: spark.read.parquet(f"{folder}/{name}"))

    def table(self, name: str) -> DataFrame:
        return self._supply(name)

    sales = property(lambda self: self.table("fact_sales"))
    products = property(lambda self: self.table("dim_products"))
    customers = property(lambda self: self.table("dim_customers"))
    stores = property(lambda self: self.table("dim_stores"))
    warehouses = property(lambda self: self.table("dim_warehouses"))
    inventory = property(lambda self: self.table("fact_inventory"))
    returns = property(lambda self: self.table("fact_returns"))

    def sales_between(self, first=None, last=None) -> DataFrame:
        """Sales of a date range. A stored fact is partitioned by order_month, so the range also prunes folders."""
        out = self.sales
        for bound, low in ((first, True), (last, False)):
            if bound is None:
                continue
            day = F.col("order_date")
            out = out.where(day >= F.lit(bound) if low else day <= F.lit(bound))
            if "order_month" in out.columns:
                month = F.lit(bound.replace(day=1))
                out = out.where(F.col("order_month") >= month if low else F.col("order_month") <= month)
        return out


class Derivation:
    """Driver tables to star schema; each table is written once per application."""

    def __init__(self, spark: SparkSession, source_dir: str):
        self.spark = spark
        self.source_dir = source_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.source_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.source_dir, name)
        if key not in _written:
            folder = f"{shared_dir(self.spark)}/star/{uuid.uuid4().hex}/{name}"
            with lean(self.spark):
                frame = getattr(self, name)()
                if name == "fact_sales":
                    frame.select(*names(STAR[name]), "order_month").write.partitionBy("order_month").parquet(folder)
                else:
                    frame.select(*names(STAR[name])).write.parquet(folder)
            stored = struct(STAR[name])
            if name == "fact_sales":
                stored = stored.add("order_month", "date")
            _written[key] = self.spark.read.schema(stored).parquet(folder)
            if all((*key[:2], fact) in _written for fact in ("fact_sales", "fact_returns")) and (*key[:2], "lines") in _written:
                delete(self.spark, _lines_at.pop(key[:2]))
                del _written[(*key[:2], "lines")]
        return _written[key]

    def _lines(self) -> DataFrame:
        """All order lines with their order and part, joined and written once for sales and returns, and deleted after both."""
        key = (self.spark.sparkContext.applicationId, self.source_dir, "lines")
        if key not in _written:
            lines, orders, parts = self.read("lineitem"), self.read("orders"), self.read("part")
            joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
                parts, F.col("l_partkey") == F.col("p_partkey")
            )
            rows, path = joined.select(*LINE), scratch(self.spark, "lines")
            rows.write.parquet(path)
            _written[key], _lines_at[key[:2]] = self.spark.read.schema(rows.schema).parquet(path), path
        return _written[key]

    def _regions(self) -> DataFrame:
        """One row with the sorted region names, a fixed handful."""
        return self.read("region").agg(F.sort_array(F.collect_set("r_name")).alias("all_regions"))

    ORDER_ID = (
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))"
    )

    def fact_sales(self) -> DataFrame:
        """Along the curve, with order_month. Lines are ranged over tasks as they are read; amounts and texts are made after that."""
        keys = {"customer_id": "o_custkey", "product_id": "l_partkey", "store_id": "l_suppkey"}
        lines = self._lines().select(
            *[F.col(c).alias(name) for name, c in keys.items()],
            F.col("o_orderdate").cast("date").alias("order_date"),
            *[c for c in LINE if c not in (*keys.values(), "p_partkey", "o_orderdate", "l_returnflag")],
        )
        return curved(lines, self._priced)

    def _priced(self, lines: DataFrame) -> DataFrame:
        lines = lines.withColumns({c: F.col("product_id") for c in ("l_partkey", "p_partkey")} | {"l_suppkey": F.col("store_id")})
        priced = lines.crossJoin(F.broadcast(self._regions())).select(
            F.expr(self.ORDER_ID).alias("order_id"),
            "order_date",
            "customer_id",
            "product_id",
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_discount").cast("decimal(5,3)").alias("discount"),
            F.expr(AMOUNT).alias("sales_amount"),
            F.expr(COST).alias("cost_price"),
            "store_id",
            _mapped("o_orderpriority", PAYMENT, "Cash on Delivery").alias("payment_method"),
            F.when(F.col("l_linestatus") == "O", "Online").otherwise("Offline").alias("sales_channel"),
            F.element_at("all_regions", (F.col("l_orderkey") % 5 + 1).cast("int")).alias("sale_region"),
            "order_month",
            "_z",
        )
        profit = F.col("sales_amount") - F.col("cost_price") * F.col("quantity")
        return priced.withColumn("profit", profit.cast("decimal(12,2)"))

    def fact_returns(self) -> DataFrame:
        mix = (F.col("l_partkey") * 7 + F.col("l_suppkey")) % 100
        days = (1 + (F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber")) % 30).cast("int")
        reason = F.element_at(
            F.array(*[F.lit(r) for r in REASONS]), ((F.col("l_partkey") + F.col("l_suppkey")) % 8 + 1).cast("int")
        )
        return self._lines().where(F.col("l_returnflag") == "R").select(
            F.expr(f"concat('RET-', {self.ORDER_ID})").alias("return_id"),
            F.expr(self.ORDER_ID).alias("order_id"),
            reason.alias("reason"),
            F.when((mix >= 30) & (mix < 50), F.lit(0).cast("decimal(12,2)")).otherwise(F.expr(AMOUNT)).alias("refund_amount"),
            F.date_add(F.col("o_orderdate").cast("date"), days).alias("return_date"),
            F.when(mix < 30, "Approved").when(mix < 38, "Rejected").when(mix < 50, "Pending").otherwise("Refunded")
            .alias("return_status"),
            days.alias("days_after_purchase"),
        )

    def dim_products(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey AS product_id",
            "p_type AS category",
            "split_part(p_name, ' ', 1) AS subcategory",
            "p_brand AS brand",
            "concat(p_name, ' ', CAST(p_partkey AS STRING)) AS product_name",
            f"{COST} AS cost_price",
            f"{PRICE} AS selling_price",
            "concat('Supplier_', lpad(CAST(p_partkey % 60 + 1 AS STRING), 3, '0')) AS supplier",
            "date_add(DATE '1994-01-01', CAST(p_partkey * 53 % 2700 AS INT)) AS launch_date",
        )

    def _places(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    def dim_customers(self) -> DataFrame:
        spend = self.table("fact_sales").groupBy("customer_id").agg(F.sum("sales_amount").alias("spend"))
        key = F.col("c_custkey")
        people = (
            self.read("customer")
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(spend, key == F.col("customer_id"), "left")
            .select(
                key.alias("customer_id"),
                (18 + key * 7 % 63).cast("int").alias("age"),
                F.when(key % 33 == 0, "Other").when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
                F.col("n_name").alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
                _mapped("c_mktsegment", SEGMENT, "Regular").alias("segment"),
                F.expr(
                    "CASE WHEN c_custkey % 37 = 0 THEN NULL"
                    " ELSE CAST(30000 + 5 * CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(12,2)) END"
                ).alias("income"),
                F.expr("date_add(DATE '1994-06-01', CAST(c_custkey * 37 % 1800 AS INT))").alias("signup_date"),
                F.coalesce("spend", F.lit(0)).cast("decimal(14,2)").alias("lifetime_value"),
            )
        )
        return with_tiers(people)

    def dim_stores(self) -> DataFrame:
        return (
            self.read("supplier")
            .join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("store_id"), F.col("r_name").alias("region"))
        )

    def _stock(self) -> DataFrame:
        return (
            self.read("lineitem")
            .groupBy(F.col("l_partkey").alias("p"), (F.col("l_suppkey") % 20).alias("w"))
            .agg(F.sum(F.col("l_quantity").cast("int")).alias("sold"))
        )

    def dim_warehouses(self) -> DataFrame:
        # the sorted position of a region picks it for a warehouse
        places = self.table("fact_inventory").select("warehouse_id").distinct()
        return places.crossJoin(F.broadcast(self._regions())).select(
            "warehouse_id",
            F.element_at("all_regions", (F.col("warehouse_id") % 5 + 1).cast("int")).alias("region"),
        )

    def fact_inventory(self) -> DataFrame:
        empty = "(p * 3 + w) % 17 = 0"
        moved = self._stock().selectExpr(
            "p AS product_id",
            "w AS warehouse_id",
            f"CASE WHEN {empty} THEN sold ELSE sold + 10 + (p * 7 + w * 13) % 90 END AS opening_stock",
            f"CASE WHEN {empty} THEN 0 ELSE (p + w) % 50 END AS received_stock",
            "CASE WHEN p % 41 = 0 THEN 0 ELSE sold END AS sold_stock",
            f"CASE WHEN {empty} THEN 1 ELSE (p * 5 + w) % 4 END AS damaged_stock",
            "CAST(2 + (p + w * 3) % 19 AS INT) AS lead_time_days",
            "CAST(2.5 + CAST((p * 11 + w * 7) % 26 AS DECIMAL(4,1)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(3,1))"
            " AS supplier_rating",
        )
        left = "opening_stock + received_stock - sold_stock - damaged_stock"
        return moved.withColumn("closing_stock", F.expr(f"greatest({left}, 0)")).withColumn(
            "reorder_level", F.expr("CAST(floor(opening_stock * 2 / 10.0) AS BIGINT) + 10")
        )


def with_tiers(customers: DataFrame) -> DataFrame:
    """Loyalty tier by the 90th, 70th and 40th percentile of lifetime value, inclusive at each cut."""
    cuts = quantiles(customers, "lifetime_value", {"q90": 0.9, "q70": 0.7, "q40": 0.4})
    worth = F.col("lifetime_value").cast("double")
    tier = at_least(worth, list(zip((F.col("q90"), F.col("q70"), F.col("q40")), TIER_LABELS)), TIER_LABELS[-1])
    rest = [c for c in customers.columns if c != "loyalty_tier"]
    return customers.crossJoin(F.broadcast(cuts)).select(*rest, tier.alias("loyalty_tier"))
