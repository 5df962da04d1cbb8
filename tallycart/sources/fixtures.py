"""Raw, deliberately dirty extracts derived from the star schema (FIXTURES.md section 4) for the cleaning pipeline.

Copies of a key arrive after the first row and differ from it, in a way that would let them win if the smallest row stayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.sources.extracts import ARRIVAL
from tallycart.sources.warehouse import Warehouse


def with_copies(once: DataFrame, copied: str, **changed: str) -> DataFrame:
    """The rows, and after them those that ``copied`` selects again with some columns changed."""
    again = once.where(copied).selectExpr(*[f"CAST({changed[c]} AS {k}) AS {c}" if c in changed else c for c, k in once.dtypes])
    return once.withColumn(ARRIVAL, F.lit(1)).unionByName(again.withColumn(ARRIVAL, F.lit(2)))


def raw_customers(wh: Warehouse) -> DataFrame:
    once = wh.customers.selectExpr(
        "CAST(customer_id AS STRING) AS CustomerID",
        "CASE WHEN customer_id % 43 = 0 THEN -5 WHEN customer_id % 47 = 0 THEN 140 ELSE age END AS Age",
        "gender AS Gender", "city AS City", "state AS State", "country AS Country", "segment AS Segment",
        "income AS Income", "signup_date AS SignupDate",
        "CASE WHEN customer_id % 29 = 0 THEN NULL ELSE lifetime_value END AS LifetimeValue",
        "loyalty_tier AS LoyaltyTier",
    )
    return with_copies(once, "CAST(CustomerID AS BIGINT) % 101 = 0", City="' copy'", Income="NULL")


def raw_products(wh: Warehouse) -> DataFrame:
    once = wh.products.selectExpr(
        "CAST(product_id AS STRING) AS ProductID", "category AS Category", "subcategory AS Subcategory",
        "brand AS Brand", "product_name AS ProductName",
        "CAST(CASE WHEN product_id % 71 = 0 THEN -cost_price ELSE cost_price END AS DECIMAL(10,2)) AS CostPrice",
        "CAST(CASE WHEN product_id % 73 = 0 THEN cost_price - 1 ELSE selling_price END AS DECIMAL(10,2)) AS SellingPrice",
        "supplier AS Supplier", "launch_date AS LaunchDate",
    )
    return with_copies(once, "CAST(ProductID AS BIGINT) % 101 = 0", Brand="' copy'")


def raw_sales(wh: Warehouse) -> DataFrame:
    once = wh.sales.selectExpr("*", "CAST(split_part(order_id, '-', 1) AS BIGINT) AS k").selectExpr(
        "order_id AS OrderID", "order_date AS OrderDate",
        "CAST(CASE WHEN k % 211 = 0 THEN customer_id + 10000000 ELSE customer_id END AS STRING) AS CustomerID",
        "CAST(product_id AS STRING) AS ProductID",
        "CASE WHEN k % 89 = 0 THEN 0 ELSE quantity END AS Quantity",
        "CAST(CASE WHEN k % 97 = 0 THEN 1.5 ELSE discount END AS DECIMAL(5,3)) AS Discount",
        "sales_amount AS SalesAmount", "profit AS Profit", "CAST(store_id AS STRING) AS Store", "sale_region AS Region",
        "payment_method AS PaymentMethod", "sales_channel AS SalesChannel",
    )
    return with_copies(once, "CAST(split_part(OrderID, '-', 1) AS BIGINT) % 101 = 0", PaymentMethod="' copy'", Region="' copy'")


def raw_inventory(wh: Warehouse) -> DataFrame:
    return wh.inventory.selectExpr(
        "CAST(product_id AS STRING) AS ProductID", "concat('WH', lpad(CAST(warehouse_id AS STRING), 3, '0')) AS Warehouse",
        "opening_stock AS OpeningStock", "received_stock AS ReceivedStock", "sold_stock AS SoldStock",
        "damaged_stock AS DamagedStock",
        "CASE WHEN product_id % 29 = 0 THEN -closing_stock - 1 ELSE closing_stock END AS ClosingStock",
        "reorder_level AS ReorderLevel", "lead_time_days AS LeadTimeDays", "supplier_rating AS SupplierRating",
    )


def raw_returns(wh: Warehouse) -> DataFrame:
    once = wh.returns.selectExpr(
        "return_id AS ReturnID", "order_id AS OrderID", "reason AS Reason", "refund_amount AS RefundAmount",
        "return_date AS ReturnDate", "return_status AS ReturnStatus", "days_after_purchase AS DaysAfterPurchase",
    )
    unknown = once.where("DaysAfterPurchase = 7").selectExpr(
        "concat('BAD-', ReturnID) AS ReturnID", "concat('NONE-', OrderID) AS OrderID", "Reason", "RefundAmount",
        "ReturnDate", "ReturnStatus", "DaysAfterPurchase",
    )
    return with_copies(once, "DaysAfterPurchase = 11", Reason="' copy'").unionByName(unknown.withColumn(ARRIVAL, F.lit(1)))


def raw_extracts(wh: Warehouse) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(wh),
        "products": raw_products(wh),
        "sales": raw_sales(wh),
        "inventory": raw_inventory(wh),
        "returns": raw_returns(wh),
    }
