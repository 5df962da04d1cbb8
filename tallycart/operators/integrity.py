"""Integrity transforms: profit recomputation (R4), stock reconciliation (R5) and rule checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.sources.schemas import CHECKS, FOREIGN, KEYS, required
from tallycart.sources.warehouse import Warehouse


class RuleViolation(ValueError):
    """Raised by strict validation; carries the (table, rule, violations) rows that failed."""


def recompute_profit(sales: DataFrame, products: DataFrame) -> DataFrame:
    """profit = round(amount - cost * quantity, 2) where the product's cost is known. Also usable on a stream."""
    costs = products.select("product_id", F.col("cost_price").alias("_cost"))
    fresh = F.round(F.col("sales_amount") - F.col("_cost") * F.col("quantity"), 2).cast("decimal(12,2)")
    columns = sales.columns
    return (
        sales.join(costs, "product_id", "left")
        .withColumn("profit", F.when(F.col("_cost").isNotNull(), fresh).otherwise(F.col("profit")))
        .select(*columns)
    )


def stock_mismatches(inventory: DataFrame) -> DataFrame:
    """Lines where closing differs from opening + received - sold - damaged; unknown stocks raise nothing."""
    expected = F.col("opening_stock") + F.col("received_stock") - F.col("sold_stock") - F.col("damaged_stock")
    return inventory.where(F.col("closing_stock") != expected).select(
        "product_id",
        "warehouse_id",
        expected.cast("bigint").alias("expected_stock"),
        F.col("closing_stock").cast("bigint").alias("closing_stock"),
    )


def row_rules(table: str) -> list[tuple[str, Column]]:
    """NOT NULL and CHECK rules of a table with the condition that a violating row meets."""
    rules = [(f"not_null_{c}", F.col(c).isNull()) for c in required(table)]
    return rules + [(name, ~F.expr(condition)) for name, condition in CHECKS.get(table, [])]


def _row_rules(df: DataFrame, table: str) -> DataFrame:
    """All row rules of a table in one pass."""
    rules = row_rules(table)
    counted = df.agg(*[F.count(F.when(broken, F.lit(1))).alias(name) for name, broken in rules])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name, _ in rules])
    return counted.select(F.lit(table).alias("table_name"), F.explode(rows).alias("r")).select(
        "table_name", "r.rule", "r.violations"
    )


def _unique(df: DataFrame, table: str) -> DataFrame:
    """Surplus rows per key."""
    key = KEYS[table]
    surplus = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return surplus.agg(
        F.lit(table).alias("table_name"),
        F.lit("unique_" + "_".join(key)).alias("rule"),
        F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("violations"),
    )


def _orphans(df: DataFrame, table: str, column: str, parent: DataFrame, parent_name: str) -> DataFrame:
    """Rows whose foreign key has no parent. The child is reduced to key counts first, so a hot key is one row."""
    keys = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(column), column, "left_anti").agg(
        F.lit(table).alias("table_name"),
        F.lit(f"foreign_{column}_in_{parent_name}").alias("rule"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("violations"),
    )


def rule_report(wh: Warehouse, tables: Iterable[str] = tuple(KEYS), parents: Warehouse | None = None, unique: bool = True) -> DataFrame:
    """One row per table and rule with the number of violating rows (0 when the rule holds).

    ``parents`` holds the tables that foreign keys point to when ``wh`` is only a batch of new rows; such a batch has
    already been made unique, so ``unique`` can be left out.
    """
    parents = parents or wh
    report = None
    for table in tables:
        df = wh.table(table)
        parts = [_row_rules(df, table), *([_unique(df, table)] if unique else [])]
        parts += [_orphans(df, table, c, parents.table(parent), parent) for c, parent in FOREIGN.get(table, [])]
        for part in parts:
            report = part if report is None else report.unionByName(part)
    return report


def require_valid(wh: Warehouse, parents: Warehouse | None = None) -> None:
    """Strict mode: raise on any violation, as a load inside one transaction would abort. The report is short."""
    broken = rule_report(wh, parents=parents, unique=parents is None).where(F.col("violations") > 0).collect()
    if broken:
        raise RuleViolation("; ".join(f"{r.table_name}.{r.rule}: {r.violations}" for r in broken))
