"""Oracle SQL of the insight tables."""

from __future__ import annotations

from oracle.base import d, div, pct, r, star
from oracle.reports import LINES, band

SQL: dict[str, str] = {}
SQL["i1_sales_movement"] = star(
    f"""SELECT DATE '2001-07-01' AS last_month, DATE '2001-06-01' AS previous_month, {d('sum(a)')} AS last_revenue,
    {d('sum(b)')} AS previous_revenue, {pct('(sum(a) - sum(b))', 'sum(b)')} AS change_pct,
    arg_min(category, a - b) AS biggest_drag, {d('min(a - b)')} AS drag_change, arg_max(category, a - b) AS biggest_lift,
    {d('max(a - b)')} AS lift_change
    FROM (SELECT category, coalesce(sum(sales_amount) FILTER (month(order_date) = 7), 0) AS a,
            coalesce(sum(sales_amount) FILTER (month(order_date) = 6), 0) AS b
          FROM lines WHERE order_date BETWEEN DATE '2001-06-01' AND DATE '2001-07-31' GROUP BY ALL)""",
    lines=LINES,
)
SQL["i2_profitable_segment"] = star(
    f"""SELECT criterion, segment, {d('p')} AS profit, c AS customers, {r(div('p', 'c'))} AS profit_per_customer FROM
    (SELECT *, 'total profit' AS criterion, p AS worth FROM s UNION ALL SELECT *, 'profit per customer', p / c FROM s)
    QUALIFY row_number() OVER (PARTITION BY criterion ORDER BY worth DESC, segment) = 1""",
    s="""SELECT segment, sum(profit) AS p, count(DISTINCT customer_id) AS c
      FROM fact_sales JOIN dim_customers USING (customer_id) GROUP BY ALL""",
)
SQL["i3_declining_region"] = star(
    f"""SELECT region, yr, {d('v')} AS revenue, {d('before')} AS previous_revenue, {d('v - before')} AS yoy_change,
    {pct('(v - before)', 'before')} AS yoy_change_pct
    FROM (SELECT *, lag(v) OVER (PARTITION BY region ORDER BY yr) AS before FROM y)
    WHERE yr = (SELECT max(yr) FROM y) AND v < before ORDER BY v - before, region LIMIT 1""",
    y="SELECT sale_region AS region, year(order_date) AS yr, sum(sales_amount) AS v FROM fact_sales GROUP BY ALL",
)
SQL["i4_discontinue"] = star(
    f"""SELECT product_id, product_name, category, n AS orders, {d('p')} AS profit
    FROM (SELECT product_id, product_name, category, count(*) AS n, sum(profit) AS p FROM lines GROUP BY ALL)
    WHERE n >= 5 AND p < 0 ORDER BY p, product_id LIMIT 10""",
    lines=LINES,
)
SQL["i5_replenishment"] = star(
    f"""SELECT warehouse_id, lines_below, all_below, all_lines, {pct('all_below', 'all_lines')} AS below_pct
    FROM (SELECT warehouse_id, count(*) AS lines_below FROM fact_inventory WHERE closing_stock <= reorder_level GROUP BY ALL),
    (SELECT count(*) FILTER (closing_stock <= reorder_level) AS all_below, count(*) AS all_lines FROM fact_inventory)
    ORDER BY lines_below DESC, warehouse_id LIMIT 5"""
)
SQL["i6_discount_damage"] = star(
    f"""SELECT category, {d('sum(sales_amount)')} AS revenue, {pct('sum(profit)', 'sum(sales_amount)')} AS margin_pct
    FROM lines WHERE {band('0.03', '0.07')} = '26%+' GROUP BY ALL ORDER BY margin_pct, category LIMIT 3""",
    lines=LINES,
)
SEEN = """SELECT customer_id, max(order_date) AS last_order,
  date_diff('day', max(order_date), (SELECT max(order_date) FROM fact_sales)) AS days_since_last_order
  FROM fact_sales GROUP BY ALL"""
SQL["i7_churn_list"] = star("SELECT * FROM seen WHERE days_since_last_order >= 180", seen=SEEN)
SQL["i7_churn_rate"] = star(
    f"""SELECT count(*) FILTER (days_since_last_order >= 180) AS at_risk, count(*) AS customers,
    {pct('count(*) FILTER (days_since_last_order >= 180)', 'count(*)')} AS at_risk_pct FROM seen""",
    seen=SEEN,
)
SQL["i8_inventory_advice"] = star(
    f"""SELECT (SELECT count(*) FROM (SELECT product_id FROM fact_inventory GROUP BY ALL
      HAVING sum(closing_stock) > 0 AND sum(sold_stock) = 0)) AS dead_stock_products,
    {pct('sum(damaged_stock)', 'sum(received_stock)')} AS damage_rate_pct FROM fact_inventory"""
)
ON = "sales_channel = 'Online'"
SQL["i9_marketing"] = star(
    f"""SELECT {pct(f'count(*) FILTER ({ON})', 'count(*)')} AS online_share_of_orders_pct,
    {pct(f'sum(sales_amount) FILTER ({ON})', 'sum(sales_amount)')} AS online_share_of_revenue_pct,
    (SELECT {pct('count(*) FILTER (n > 1)', 'count(*)')} FROM (SELECT count(*) AS n FROM fact_sales GROUP BY customer_id))
      AS repeat_rate_pct FROM fact_sales"""
)
SQL["i10_executive"] = star(
    f"""SELECT {d('sum(sales_amount)')} AS total_revenue, {d('sum(profit)')} AS total_profit,
    {pct('sum(profit)', 'sum(sales_amount)')} AS margin_pct,
    {pct('(SELECT count(*) FROM fact_returns)', 'count(*)')} AS return_rate_pct FROM fact_sales"""
)
