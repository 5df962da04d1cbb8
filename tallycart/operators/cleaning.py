"""Cleaning of the raw extracts (C1-C8), their sanity figures (C11) and the whole pipeline to a star schema.

Columns keep the extracts' names until ``to_star``. Of duplicate keys the first row stays: the one with the least
``_arrival``, which the CSV reader adds (file, place in the file); any orderable column of that name will do. A frame
without it has no order to fall back on and keeps the smallest row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.numeric import dbl, pct, ratio, rnd
from tallycart.operators.ladder import quantiles
from tallycart.session import staged
from tallycart.sources.extracts import ARRIVAL
from tallycart.sources.warehouse import with_tiers


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row per key as an aggregate: copies of a hot key collapse where they are read."""
    order = [c for c in df.columns if c == ARRIVAL]
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns if c != ARRIVAL])


def plain(df: DataFrame) -> list[str]:
    """Columns without the reader's arrival order."""
    return [c for c in df.columns if c != ARRIVAL]


def clipped(name: str, low: Column | int | None = None, high: Column | int | None = None) -> Column:
    """Value pulled into [low, high]; NULL stays NULL."""
    out = F.col(name)
    if low is not None:
        out = F.when(F.col(name) < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(F.col(name) > high, F.lit(high)).otherwise(out)
    return out


def _cast_like(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value.cast(df.schema[name].dataType))


def clean_customers(df: DataFrame) -> DataFrame:
    """One row per customer, age in 0-110, unknown income replaced by the median, unknown value by 0."""
    single = first_per_key(df, ["CustomerID"])
    middle = quantiles(single, "Income", {"_median": 0.5})
    out = _cast_like(single, "Age", clipped("Age", 0, 110)).crossJoin(F.broadcast(middle))
    out = _cast_like(out, "Income", rnd(F.coalesce(dbl("Income"), F.col("_median"))))
    return _cast_like(out, "LifetimeValue", F.coalesce("LifetimeValue", F.lit(0))).drop("_median")


def clean_products(df: DataFrame) -> DataFrame:
    """One row per product; rows without a positive cost or sold below cost are dropped, unknown prices too."""
    single = first_per_key(df, ["ProductID"])
    return single.where((F.col("CostPrice") > 0) & (F.col("SellingPrice") >= F.col("CostPrice")))


def clean_sales(df: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order, known customer and product, positive quantity, discount in 0-1."""
    kept = (
        first_per_key(df, ["OrderID"])
        .where(F.col("Quantity") > 0)
        .join(customers.select("CustomerID"), "CustomerID", "left_semi")
        .join(products.select("ProductID"), "ProductID", "left_semi")
    )
    return _cast_like(kept, "Discount", clipped("Discount", 0, 1)).select(*plain(df))


STOCKS = ("OpeningStock", "ReceivedStock", "SoldStock", "DamagedStock", "ClosingStock")


def clean_inventory(df: DataFrame, products: DataFrame) -> DataFrame:
    """C4: lines of known products with stocks cut off at zero; no deduplication."""
    out = df.join(products.select("ProductID"), "ProductID", "left_semi")
    for name in STOCKS:
        out = _cast_like(out, name, clipped(name, 0))
    return out.select(*plain(df))


def clean_returns(df: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per return of a surviving order."""
    return first_per_key(df, ["ReturnID"]).join(sales.select("OrderID"), "OrderID", "left_semi").select(*plain(df))


def derive_stores(sales: DataFrame) -> DataFrame:
    """Each store's most frequent region, the alphabetically first on a tie."""
    seen = sales.where(F.col("Region").isNotNull()).groupBy("Store", "Region").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus"), "Region"))
    return seen.groupBy("Store").agg(best.getField("Region").alias("region")).withColumnRenamed("Store", "store_id")


def derive_warehouses(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Warehouses in sorted order take the sorted regions in turn. Both lists are dimension-sized."""
    regions = sales.groupBy("Region").agg(F.lit(1)).agg(F.sort_array(F.collect_set("Region")).alias("all"))
    places = inventory.select(F.col("Warehouse").alias("warehouse_id")).distinct()
    turn = (F.row_number().over(Window.orderBy("warehouse_id")) - 1) % F.size("all") + 1
    return places.crossJoin(F.broadcast(regions)).select("warehouse_id", F.element_at("all", turn).alias("region"))


def refresh_ltv(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Lifetime value from sales (0 without any) and tier by its percentiles."""
    spend = sales.groupBy("CustomerID").agg(F.sum("SalesAmount").alias("_spend"))
    value = F.round(F.coalesce("_spend", F.lit(0)), 2).cast("decimal(14,2)")
    out = customers.join(spend, "CustomerID", "left").withColumn("lifetime_value", value)
    tiers = with_tiers(out.drop("_spend", "LifetimeValue", "LoyaltyTier"))
    renamed = tiers.withColumnRenamed("lifetime_value", "LifetimeValue").withColumnRenamed("loyalty_tier", "LoyaltyTier")
    return renamed.select(*customers.columns)


# Extract column -> star column where they differ by more than case style.
RENAMED = {"Store": "store_id", "Warehouse": "warehouse_id", "Region": "sale_region"}


def _snake(name: str) -> str:
    out = "".join(("_" + c.lower()) if c.isupper() and k and not name[k - 1].isupper() else c.lower() for k, c in enumerate(name))
    return RENAMED.get(name, out)


def to_star(raw: Mapping[str, DataFrame], stores: DataFrame, warehouses: DataFrame) -> dict[str, DataFrame]:
    """Extract-named frames to star-schema tables."""
    tables = {"dim_stores": stores, "dim_warehouses": warehouses}
    targets = {
        "customers": "dim_customers", "products": "dim_products", "sales": "fact_sales",
        "inventory": "fact_inventory", "returns": "fact_returns",
    }
    for entity, table in targets.items():
        df = raw[entity]
        tables[table] = df.select(*[F.col(c).alias(_snake(c)) for c in plain(df)])
    return tables


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The pipeline in dependency order: valid keys flow from customers and products to sales to returns.

    Every table that later steps read again is staged once, so no cleaning step runs twice.
    """
    customers = staged(clean_customers(raw["customers"]), "customers")
    products = staged(clean_products(raw["products"]), "products")
    sales = staged(clean_sales(raw["sales"], customers, products), "sales")
    inventory = staged(clean_inventory(raw["inventory"], products), "inventory")
    returns = clean_returns(raw["returns"], sales)
    clean = {
        "customers": refresh_ltv(customers, sales),
        "products": products,
        "sales": sales,
        "inventory": inventory,
        "returns": returns,
    }
    return to_star(clean, derive_stores(sales), derive_warehouses(inventory, sales))


def sanity(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """C11: revenue, profit, average order value, return rate and online share of orders."""
    sold = sales.agg(
        F.sum("sales_amount").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.count(F.lit(1)).alias("orders"),
        F.count(F.when(F.col("sales_channel") == "Online", 1)).alias("online"),
    )
    back = returns.agg(F.count(F.lit(1)).alias("returned"))
    return sold.crossJoin(F.broadcast(back)).select(
        dbl("revenue").alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        rnd(ratio("revenue", "orders")).alias("avg_order_value"),
        pct("returned", "orders").alias("return_rate_pct"),
        pct("online", "orders").alias("online_share_pct"),
    )
