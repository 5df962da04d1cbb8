"""Oracle SQL of the streams: what their batch counterparts give."""

from __future__ import annotations

from oracle.base import d, i, r, star
from oracle.loading import K
from oracle.reports import SQL as REPORTS

SQL: dict[str, str] = {}
SQL["x1_clean_orders"] = star(
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS orders, {i('sum(quantity)')} AS units,
    {d(f'sum(CASE WHEN {K} % 97 = 0 THEN 1 ELSE discount END)')} AS discounts, {d('sum(profit)')} AS profit
    FROM fact_sales WHERE {K} % 89 <> 0 AND {K} % 211 <> 0 GROUP BY month"""
)
SQL["x2_stock_alerts"] = REPORTS["r5_stock_mismatches"]
SQL["x3_customer_value"] = star(
    f"SELECT customer_id, {d('sum(sales_amount)')} AS lifetime_value, count(*) AS orders FROM fact_sales GROUP BY ALL"
)
# windows end at or before the watermark: three days before the newest order
FINAL = "(SELECT max(order_date) FROM fact_sales) - 3"
SQL["x4_daily_revenue"] = star(
    f"""SELECT from_day, v AS revenue, orders, {r('z', 3)} AS z, coalesce(abs(z) > 2, false) AS alert
    FROM (SELECT *, CASE WHEN count(*) OVER w >= 2 THEN (v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0) END AS z
    FROM (SELECT order_date AS from_day, {d('sum(sales_amount)')} AS v, count(*) AS orders FROM fact_sales
          WHERE order_date + 1 <= {FINAL} GROUP BY ALL)
    WINDOW w AS (ORDER BY from_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
)
SQL["x5_sliding_revenue"] = star(
    f"""SELECT from_day, {d('sum(sales_amount)')} AS revenue, count(*) AS orders
    FROM (SELECT CAST(order_date - CAST(back AS INT) AS DATE) AS from_day, sales_amount FROM fact_sales, range(7) t(back))
    WHERE from_day + 7 <= {FINAL} GROUP BY ALL"""
)
