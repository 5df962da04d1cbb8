"""Inventory reports Q46-Q53."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.functions.bands import rating_band
from tallycart.functions.numeric import big, count_if, pct, ratio, rnd
from tallycart.operators.ladder import quantiles
from tallycart.sources.warehouse import Warehouse


def stock_metrics(wh: Warehouse) -> DataFrame:
    """Per product: total_sold, avg_stock (mean of opening and closing), turnover, damage_rate, stockout_rate."""
    return stock_rates(stock_sums(wh))


def stock_sums(wh: Warehouse) -> DataFrame:
    """Sums per product that add up over loads."""
    return wh.inventory.groupBy("product_id").agg(
        F.sum("sold_stock").alias("total_sold"),
        F.sum(F.col("opening_stock") + F.col("closing_stock")).alias("both"),
        F.count(F.col("opening_stock") + F.col("closing_stock")).alias("lines_known"),
        F.sum("damaged_stock").alias("damaged"),
        F.sum("received_stock").alias("received"),
        F.sum("closing_stock").alias("closing"),
        count_if(F.col("closing_stock") == 0).alias("empty"),
        F.count(F.lit(1)).alias("lines"),
    )


def stock_rates(summed: DataFrame) -> DataFrame:
    return (
        summed.withColumn("avg_stock", ratio(F.col("both").cast("double") / 2.0, F.col("lines_known")))
        .withColumn("turnover", ratio("total_sold", "avg_stock"))
        .withColumn("damage_rate", ratio("damaged", "received"))
        .withColumn("stockout_rate", ratio("empty", "lines"))
    )


def q46(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q46 stock turnover per product; products without stock sort first."""
    return (
        stock_metrics(wh)
        .select(
            "product_id",
            big("total_sold").alias("total_sold"),
            rnd("avg_stock", 1).alias("avg_stock"),
            rnd("turnover").alias("turnover_ratio"),
        )
        .orderBy(F.desc_nulls_first("turnover_ratio"), "product_id")
        .limit(limit)
    )


def reorder_lines(wh: Warehouse) -> DataFrame:
    return (
        wh.inventory.where(F.col("closing_stock") <= F.col("reorder_level"))
        .join(wh.products.select("product_id", "product_name", "category"), "product_id")
        .join(wh.warehouses, "warehouse_id")
    )


def q47(wh: Warehouse, limit: int = 30) -> DataFrame:
    """Q47 lines at or below their reorder level, widest gap first."""
    return (
        reorder_lines(wh)
        .orderBy(F.desc(F.col("reorder_level") - F.col("closing_stock")), "product_id", "warehouse_id")
        .limit(limit)
        .select(
            "product_id", "product_name", "warehouse_id", "region",
            big("closing_stock").alias("closing_stock"), big("reorder_level").alias("reorder_level"),
            big("lead_time_days").alias("lead_time_days"),
        )
    )


def stock_and_sales(wh: Warehouse) -> DataFrame:
    """Per product: stock on hand and inventory lines, units sold and sale lines, both reduced before they meet."""
    held = wh.inventory.groupBy("product_id").agg(F.sum("closing_stock").alias("stock"), F.count(F.lit(1)).alias("lines"))
    sold = wh.sales.groupBy("product_id").agg(F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("sale_lines"))
    return (
        held.join(wh.products.select("product_id", "product_name", "category"), "product_id")
        .join(sold, "product_id", "left")
        .withColumn("units", F.coalesce("units", F.lit(0)))
    )


def _dead(df: DataFrame, stock: Column, units: Column, limit: int) -> DataFrame:
    return (
        df.select(
            "product_id", "product_name", "category",
            big(stock).alias("total_stock_on_hand"), big(units).alias("units_sold_lifetime"),
        )
        .where(F.col("total_stock_on_hand") > 0)
        .orderBy("units_sold_lifetime", F.desc("total_stock_on_hand"), "product_id")
        .limit(limit)
    )


def q48(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q48 dead stock with the multiplied sums of the published query.

    Joining every inventory line to every sale of the product repeats stock per sale and units per line; the same
    numbers come from products of the reduced counts, so the pairs are never built.
    """
    repeats = F.greatest(F.coalesce("sale_lines", F.lit(0)), F.lit(1))
    return _dead(stock_and_sales(wh), F.col("stock") * repeats, F.col("units") * F.col("lines"), limit)


def q48_single(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q48 corrected: each stock line and each sale counted once."""
    return _dead(stock_and_sales(wh), F.col("stock"), F.col("units"), limit)


def q49(wh: Warehouse, share: float = 0.9, limit: int = 20) -> DataFrame:
    """Q49 products at or above the 90th percentile of turnover."""
    moving = stock_metrics(wh).select("product_id", "total_sold", "turnover")
    cut = quantiles(moving, "turnover", {"cut": share})
    return (
        moving.crossJoin(F.broadcast(cut))
        .where(F.col("turnover") >= F.col("cut"))
        .select("product_id", big("total_sold").alias("total_sold"), rnd("turnover").alias("turnover_ratio"))
        .orderBy(F.desc("turnover_ratio"), "product_id")
        .limit(limit)
    )


def stockouts(wh: Warehouse) -> DataFrame:
    return (
        wh.inventory.groupBy("warehouse_id")
        .agg(count_if(F.col("closing_stock") == 0).alias("stockout_events"), F.count(F.lit(1)).alias("total_product_lines"))
        .join(wh.warehouses, "warehouse_id")
        .withColumn("stockout_rate_pct", pct("stockout_events", "total_product_lines"))
    )


def q50(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q50 stockout rate per warehouse."""
    return (
        stockouts(wh)
        .select("warehouse_id", "region", "stockout_events", "total_product_lines", "stockout_rate_pct")
        .orderBy(F.desc("stockout_rate_pct"), "warehouse_id")
        .limit(limit)
    )


def health(wh: Warehouse) -> DataFrame:
    """Turnover, damage, stockout and the 0-100 score. Unknown damage makes the score 0: GREATEST skips NULL."""
    return health_of(stock_metrics(wh))


def health_of(metrics: DataFrame) -> DataFrame:
    slow = F.when(F.col("turnover") < 0.5, F.lit(20.0)).otherwise(F.lit(0.0))
    points = F.lit(100.0) - F.col("stockout_rate") * 50 - F.col("damage_rate") * 30 - slow
    return metrics.select(
        "product_id",
        rnd("turnover").alias("turnover_ratio"),
        rnd(F.col("damage_rate") * 100).alias("damage_rate_pct"),
        rnd(F.col("stockout_rate") * 100).alias("stockout_rate_pct"),
        rnd(F.greatest(F.lit(0.0), points), 1).alias("inventory_health_score"),
    )


def q51(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q51 lowest inventory health scores."""
    return health(wh).orderBy("inventory_health_score", "product_id").limit(limit)


def q52(wh: Warehouse) -> DataFrame:
    """Q52 mean damage rate per supplier-rating band."""
    lines = wh.inventory.select(
        rating_band(F.col("supplier_rating")).alias("rating_band"),
        ratio("damaged_stock", "received_stock").alias("rate"),
    )
    return (
        lines.groupBy("rating_band")
        .agg(F.count(F.lit(1)).alias("records"), rnd(F.avg("rate") * 100, 3).alias("avg_damage_rate_pct"))
        .orderBy(F.desc("rating_band"))
    )


def q53(wh: Warehouse) -> DataFrame:
    """Q53 mean lead time per warehouse region."""
    return (
        wh.inventory.groupBy("warehouse_id")
        .agg(F.sum("lead_time_days").alias("days"), F.count("lead_time_days").alias("known"))
        .join(wh.warehouses, "warehouse_id")
        .groupBy("region")
        .agg(
            rnd(ratio(F.sum("days"), F.sum("known")), 1).alias("avg_lead_time_days"),
            F.count(F.lit(1)).alias("warehouses"),
        )
        .orderBy(F.desc("avg_lead_time_days"), "region")
    )
