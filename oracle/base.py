"""DuckDB side of the correctness check: the fixture derivation (FIXTURES.md section 3) and SQL text helpers.

The SQL in this package is written from the meaning of each report, independently of the Spark plans.
"""

from __future__ import annotations

STAR = """
fact_sales0 AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice*100) AS BIGINT)) AS order_id,
    CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id, l_partkey AS product_id,
    CAST(l_quantity AS INT) AS quantity, CAST(l_discount AS DECIMAL(5,3)) AS discount,
    CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INT) * (1 - CAST(l_discount AS DECIMAL(5,3))), 2) AS DECIMAL(12,2)) AS sales_amount,
    CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(60 + 5*(p_partkey % 8) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS cost_price,
    l_suppkey AS store_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Debit Card' WHEN '3-MEDIUM' THEN 'UPI'
      WHEN '4-NOT SPECIFIED' THEN 'Wallet' ELSE 'Cash on Delivery' END AS payment_method,
    CASE l_linestatus WHEN 'O' THEN 'Online' ELSE 'Offline' END AS sales_channel,
    sale_region, l_returnflag, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN (SELECT r_name AS sale_region, row_number() OVER (ORDER BY r_name) - 1 AS turn FROM region) ON l_orderkey % 5 = turn
),
fact_sales AS (
  SELECT order_id, order_date, customer_id, product_id, quantity, discount, sales_amount,
    CAST(sales_amount - cost_price * quantity AS DECIMAL(12,2)) AS profit, store_id, payment_method, sales_channel, sale_region
  FROM fact_sales0
),
dim_products AS (
  SELECT p_partkey AS product_id, p_type AS category, split_part(p_name, ' ', 1) AS subcategory, p_brand AS brand,
    concat(p_name, ' ', CAST(p_partkey AS VARCHAR(20))) AS product_name,
    CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(60 + 5*(p_partkey % 8) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS cost_price,
    CAST(p_retailprice AS DECIMAL(10,2)) AS selling_price,
    concat('Supplier_', lpad(CAST(p_partkey % 60 + 1 AS VARCHAR(20)), 3, '0')) AS supplier,
    DATE '1994-01-01' + CAST(p_partkey * 53 % 2700 AS INT) AS launch_date
  FROM part
),
customer_ltv AS (SELECT customer_id, SUM(sales_amount) AS ltv FROM fact_sales GROUP BY customer_id),
dim_customers0 AS (
  SELECT c_custkey AS customer_id, CAST(18 + c_custkey * 7 % 63 AS INT) AS age,
    CASE WHEN c_custkey % 33 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    n_name AS city, n_name AS state, r_name AS country,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Premium' WHEN 'FURNITURE' THEN 'Budget' WHEN 'MACHINERY' THEN 'New' ELSE 'Regular' END AS segment,
    CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(30000 + 5 * CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(12,2)) END AS income,
    DATE '1994-06-01' + CAST(c_custkey * 37 % 1800 AS INT) AS signup_date,
    CAST(coalesce(ltv, 0) AS DECIMAL(14,2)) AS lifetime_value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN customer_ltv ON customer_id = c_custkey
),
tier_cuts AS (
  SELECT percentile_cont(0.9) WITHIN GROUP (ORDER BY CAST(lifetime_value AS DOUBLE)) AS q90,
         percentile_cont(0.7) WITHIN GROUP (ORDER BY CAST(lifetime_value AS DOUBLE)) AS q70,
         percentile_cont(0.4) WITHIN GROUP (ORDER BY CAST(lifetime_value AS DOUBLE)) AS q40 FROM dim_customers0
),
dim_customers AS (
  SELECT d.*, CASE WHEN CAST(lifetime_value AS DOUBLE) >= q90 THEN 'Platinum' WHEN CAST(lifetime_value AS DOUBLE) >= q70 THEN 'Gold'
    WHEN CAST(lifetime_value AS DOUBLE) >= q40 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier
  FROM dim_customers0 d CROSS JOIN tier_cuts
),
dim_stores AS (
  SELECT s_suppkey AS store_id, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
sorted_regions AS (SELECT r_name AS region, row_number() OVER (ORDER BY r_name) - 1 AS i FROM region),
inv0 AS (
  SELECT l_partkey AS product_id, l_suppkey % 20 AS warehouse_id, CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS sold
  FROM lineitem GROUP BY l_partkey, l_suppkey % 20
),
dim_warehouses AS (
  SELECT w.warehouse_id, r.region FROM (SELECT DISTINCT warehouse_id FROM inv0) w JOIN sorted_regions r ON w.warehouse_id % 5 = r.i
),
inv1 AS (
  SELECT product_id, warehouse_id,
    CASE WHEN (product_id*3 + warehouse_id) % 17 = 0 THEN sold ELSE sold + 10 + (product_id*7 + warehouse_id*13) % 90 END AS opening_stock,
    CASE WHEN (product_id*3 + warehouse_id) % 17 = 0 THEN 0 ELSE (product_id + warehouse_id) % 50 END AS received_stock,
    CASE WHEN product_id % 41 = 0 THEN 0 ELSE sold END AS sold_stock,
    CASE WHEN (product_id*3 + warehouse_id) % 17 = 0 THEN 1 ELSE (product_id*5 + warehouse_id) % 4 END AS damaged_stock,
    CAST(2 + (product_id + warehouse_id*3) % 19 AS INT) AS lead_time_days,
    CAST(2.5 + CAST((product_id*11 + warehouse_id*7) % 26 AS DECIMAL(4,1)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(3,1)) AS supplier_rating
  FROM inv0
),
fact_inventory AS (
  SELECT product_id, warehouse_id, opening_stock, received_stock, sold_stock, damaged_stock,
    greatest(opening_stock + received_stock - sold_stock - damaged_stock, 0) AS closing_stock,
    CAST(floor(opening_stock * 2 / 10.0) AS BIGINT) + 10 AS reorder_level, lead_time_days, supplier_rating
  FROM inv1
),
fact_returns AS (
  SELECT concat('RET-', order_id) AS return_id, order_id,
    CASE (product_id + store_id) % 8 WHEN 0 THEN 'Defective Product' WHEN 1 THEN 'Wrong Item Delivered' WHEN 2 THEN 'Size/Fit Issue' WHEN 3 THEN 'Changed Mind'
      WHEN 4 THEN 'Better Price Found Elsewhere' WHEN 5 THEN 'Late Delivery' WHEN 6 THEN 'Quality Not as Expected' ELSE 'Damaged in Transit' END AS reason,
    CASE WHEN (product_id*7 + store_id) % 100 < 38 AND (product_id*7 + store_id) % 100 >= 30 THEN CAST(0 AS DECIMAL(12,2))
         WHEN (product_id*7 + store_id) % 100 < 50 AND (product_id*7 + store_id) % 100 >= 38 THEN CAST(0 AS DECIMAL(12,2)) ELSE sales_amount END AS refund_amount,
    order_date + CAST(1 + (product_id + store_id + l_linenumber) % 30 AS INT) AS return_date,
    CASE WHEN (product_id*7 + store_id) % 100 < 30 THEN 'Approved' WHEN (product_id*7 + store_id) % 100 < 38 THEN 'Rejected'
         WHEN (product_id*7 + store_id) % 100 < 50 THEN 'Pending' ELSE 'Refunded' END AS return_status,
    CAST(1 + (product_id + store_id + l_linenumber) % 30 AS INT) AS days_after_purchase
  FROM fact_sales0 WHERE l_returnflag = 'R'
)
"""


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def i(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def r(x: str, n: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"({d(a)} / nullif({d(b)}, 0))"


def pct(a: str, b: str, n: int = 2) -> str:
    return r(f"100.0 * {d(a)} / nullif({d(b)}, 0)", n)


def star(body: str, **ctes: str) -> str:
    """Statement over the derived star schema, with further common table expressions."""
    more = "".join(f",\n{name} AS ({text})" for name, text in ctes.items())
    return f"WITH RECURSIVE {STAR.strip()}{more}\n{body.strip()}"
