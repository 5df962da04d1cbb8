"""Views V1 to V4 kept up to date by loads: each load stores a small state of its own rows, and a view merges the states of the
visible loads. A load's refresh reads its new rows only; a view reads no fact.

States add up: sums, counts, last dates, and the distinct customers of a month as bitmaps of 32,768 ids (text ids, which have no
place in a bitmap, as distinct pairs). ``loads`` are those that the store lists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of
from tallycart.plans.customers import AS_OF, rfm_of
from tallycart.plans.products import abc_of
from tallycart.plans.rollups import product_revenue, resum, totals
from tallycart.plans.stock import health_of, stock_rates, stock_sums
from tallycart.plans.views import monthly_kpis
from tallycart.session import side_by_side
from tallycart.sources.warehouse import Warehouse


def _numeric(sales: DataFrame) -> bool:
    return dict(sales.dtypes)["customer_id"] == "bigint"


def states(wh: Warehouse) -> dict[str, DataFrame]:
    """The state of some rows, by name."""
    sales, month = wh.sales, month_of("order_date").alias("month")
    buyers = sales.where(F.col("customer_id").isNotNull())
    if _numeric(sales):
        place = F.bitmap_bit_position("customer_id")
        active = buyers.groupBy(month, F.bitmap_bucket_number("customer_id").alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))
    else:
        active = buyers.select(month, "customer_id").distinct()
    spent = buyers.groupBy("customer_id").agg(
        F.max("order_date").alias("last"), F.count(F.lit(1)).alias("frequency"), F.sum("sales_amount").alias("monetary")
    )
    return {"months": totals(sales, month), "active": active, "buyers": spent, "products": product_revenue(wh), "stock": stock_sums(wh)}


def write_states(wh: Warehouse, folder: str, load: str) -> None:
    made = states(wh)
    side_by_side(wh.spark, lambda name: made[name].write.parquet(f"{folder}/{name}/load={load}"), made)


class Views:
    """The views of the visible loads, from their states."""

    def __init__(self, spark: SparkSession, folder: str, loads: Sequence[str]):
        self.spark, self.folder, self.loads = spark, folder, list(loads)

    def state(self, name: str) -> DataFrame:
        base = f"{self.folder}/{name}"
        return self.spark.read.option("basePath", base).parquet(*(f"{base}/load={i}" for i in self.loads)).drop("load")

    def v1(self) -> DataFrame:
        """Monthly KPIs."""
        months, active = self.state("months").groupBy("month").agg(*resum()), self.state("active")
        if "bits" in active.columns:
            whole = active.groupBy("month", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            counts = whole.groupBy("month").agg(F.sum(F.bitmap_count("bits")).alias("active_customers"))
        else:
            counts = active.distinct().groupBy("month").agg(F.count(F.lit(1)).alias("active_customers"))
        counted = months.join(counts, "month", "left").withColumn("active_customers", F.coalesce("active_customers", F.lit(0)))
        return monthly_kpis(counted)

    def v2(self, as_of: dt.date = AS_OF) -> DataFrame:
        """RFM scores of every customer."""
        whole = self.state("buyers").groupBy("customer_id").agg(F.max("last").alias("last"), F.sum("frequency").alias("frequency"), F.sum("monetary").alias("monetary"))
        return rfm_of(whole.select("customer_id", F.datediff(F.lit(as_of), "last").alias("recency_days"), "frequency", "monetary"))

    def v3(self) -> DataFrame:
        """ABC class of every product."""
        return abc_of(self.state("products").groupBy("product_id").agg(F.sum("revenue").alias("revenue")))

    def v4(self) -> DataFrame:
        """Inventory health of every product."""
        stock = self.state("stock")
        return health_of(stock_rates(stock.groupBy("product_id").agg(*(F.sum(c).alias(c) for c in stock.columns if c != "product_id"))))

    def all(self, as_of: dt.date = AS_OF) -> dict[str, DataFrame]:
        """By their SQL names."""
        return {"vw_monthly_kpis": self.v1(), "vw_customer_rfm": self.v2(as_of), "vw_product_abc": self.v3(), "vw_inventory_health": self.v4()}
