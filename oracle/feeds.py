"""Oracle SQL of the dashboard feeds."""

from __future__ import annotations

from oracle.base import d, div, i, pct, r, star
from oracle.measures import PAID, TARGETS, TIMES, YTD, based, grow
from oracle.measures import SQL as MEASURES
from oracle.reports import ABC, HEALTH, MONTH, RFM, SHARES, SOLD, STOCK, TILES, TURN
from oracle.reports import SQL as REPORTS
from oracle.statistics import PARTS

SQL: dict[str, str] = {}
JULY = "month = DATE '2001-07-01'"
GROWTH = f"""SELECT month, {grow('revenue', 1)} AS mom, {grow('revenue', 3)} AS qoq, {grow('revenue', 12)} AS yoy FROM y"""
SQL["b1_cards"] = star(
    f"""SELECT {d('sum(sales_amount)')} AS total_revenue, {d('sum(profit)')} AS total_profit,
    {r(div('sum(profit)', 'sum(sales_amount)'), 4)} AS gross_margin,
    {r(div('sum(sales_amount)', 'count(*)'))} AS average_order_value, (SELECT mom FROM g WHERE {JULY}) AS mom_growth FROM fact_sales""",
    **TIMES, y=YTD, g=GROWTH,
)
SQL["b1_trend"] = star(
    f"SELECT month, {d('revenue')} AS total_revenue, {d('profit')} AS total_profit, {d('ytd')} AS revenue_ytd FROM y", **TIMES, y=YTD
)
SQL["b1_category_share"] = REPORTS["q38"]
SQL["b1_growth_strip"] = star(
    """SELECT measure, growth, CASE WHEN growth > 0.02 THEN '▲' WHEN growth < -0.02 THEN '▼' ELSE '▬' END AS icon
    FROM (SELECT 'mom_growth' AS measure, mom AS growth FROM g WHERE """ + JULY + """ UNION ALL
      SELECT 'qoq_growth', qoq FROM g WHERE """ + JULY + """ UNION ALL SELECT 'yoy_growth', yoy FROM g WHERE """ + JULY + ")",
    **TIMES, y=YTD, g=GROWTH,
)
SQL["b2_region_target"] = star(
    f"""SELECT region, {d('v')} AS total_revenue, {r(f"({d('v')} - goal) / goal", 4)} AS revenue_variance_pct_vs_target
    FROM (SELECT region, sum(sales_amount) AS v FROM fact_sales JOIN dim_stores USING (store_id) GROUP BY ALL),
    (SELECT sum(target) AS goal FROM targets)""",
    targets=TARGETS,
)


def by(attribute: str) -> str:
    return star(
        f"""SELECT {attribute}, {d('sum(sales_amount)')} AS total_revenue,
        {r(div('sum(profit)', 'count(DISTINCT customer_id)'))} AS profit_per_customer
        FROM fact_sales JOIN dim_customers USING (customer_id) GROUP BY ALL"""
    )


SQL["b2_country"] = by("country")
SQL["b2_top_stores"] = star(
    f"""SELECT store_id, {d('v')} AS total_revenue, dense_rank() OVER (ORDER BY v DESC) AS store_revenue_rank,
    {r(div('(a - b)', 'b'), 4)} AS mom_growth
    FROM (SELECT store_id, sum(sales_amount) AS v, sum(sales_amount) FILTER ({MONTH} = DATE '2001-07-01') AS a,
      sum(sales_amount) FILTER ({MONTH} = DATE '2001-06-01') AS b FROM fact_sales GROUP BY ALL)
    ORDER BY v DESC, store_id LIMIT 10"""
)
NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
SQL["b2_heatmap"] = star(
    "SELECT category, "
    + ", ".join(f"{d(f'sum(sales_amount) FILTER (month(order_date) = {k + 1})')} AS {n}" for k, n in enumerate(NAMES))
    + " FROM fact_sales JOIN dim_products USING (product_id) GROUP BY ALL"
)
SQL["b2_channel_trend"] = star(
    f"""SELECT {MONTH} AS month, sales_channel, {d('sum(sales_amount)')} AS total_revenue,
    {r(div('sum(sales_amount)', 'count(*)'))} AS average_order_value FROM fact_sales GROUP BY ALL"""
)
SQL["b3_rfm_points"] = star(
    """SELECT customer_id, recency_days, frequency, monetary, CASE WHEN s >= 13 THEN 'Champion' WHEN s >= 10 THEN 'Loyal'
    WHEN s >= 7 THEN 'At Risk' ELSE 'Lost' END AS rfm_segment FROM (SELECT *, r_score + f_score + m_score AS s FROM tiles)""",
    rfm=RFM,
    tiles=TILES,
)
SQL["b3_tier_mix"] = star(
    """SELECT loyalty_tier, count(DISTINCT customer_id) AS distinct_customers
    FROM fact_sales JOIN dim_customers USING (customer_id) GROUP BY ALL"""
)
SQL["b3_cards"] = star(
    f"""SELECT (SELECT {r(div('sum(lifetime_value)', 'count(*)'))} FROM dim_customers) AS average_customer_lifetime_value,
    {r(div('count(*) FILTER (n > 1)', 'count(*)'), 4)} AS repeat_purchase_rate,
    count(*) FILTER (seen < DATE '2001-08-01' - INTERVAL 180 DAY) AS churn_risk_customers
    FROM (SELECT count(*) AS n, max(order_date) AS seen FROM fact_sales GROUP BY customer_id)"""
)
SQL["b3_cohorts"] = REPORTS["q28"]
SQL["b3_top_customers"] = REPORTS["q35"]
SQL["b3_segments"] = by("segment")
SQL["b4_cards"] = star(
    f"""SELECT {r(div('sum(sold_stock)', div('sum(closing_stock)', 'count(*)')))} AS turnover_ratio_closing,
    {r(div('count(*) FILTER (closing_stock = 0)', 'count(*)'), 4)} AS stockout_rate,
    (SELECT count(*) FROM (SELECT product_id FROM fact_inventory GROUP BY ALL
      HAVING sum(closing_stock) > 0 AND sum(sold_stock) = 0)) AS dead_stock_products,
    (SELECT {r('avg(inventory_health_score)', 1)} FROM health) AS avg_health_score FROM fact_inventory""",
    stock=STOCK,
    health=HEALTH,
)
SQL["b4_reorder"] = star(
    f"""SELECT product_id, product_name, warehouse_id, region, {i('f.closing_stock')} AS closing_stock,
    {i('f.reorder_level')} AS reorder_level, {i('f.lead_time_days')} AS lead_time_days FROM fact_inventory f
    JOIN dim_products USING (product_id) JOIN dim_warehouses USING (warehouse_id) WHERE f.closing_stock <= f.reorder_level"""
)
SQL["b4_stockouts"] = REPORTS["q50"]
SQL["b4_abc_turnover"] = star(
    f"""SELECT product_id, {ABC} AS abc_class, {pct('reached', 'whole')} AS cumulative_pct, {r(TURN)} AS turnover_ratio
    FROM shares JOIN stock USING (product_id)""",
    sold=SOLD,
    shares=SHARES,
    stock=STOCK,
)
SQL["b4_dead_stock"] = star(
    f"""SELECT product_id, product_name, category, {i('s')} AS stock_on_hand, {d('s * cost_price')} AS stock_value
    FROM (SELECT product_id, sum(closing_stock) AS s FROM fact_inventory GROUP BY ALL HAVING s > 0 AND sum(sold_stock) = 0)
    JOIN dim_products USING (product_id)"""
)
SQL["b5_cards"] = star(
    f"""SELECT {r(div('(SELECT count(*) FROM fact_returns)', 'count(*)'), 4)} AS return_rate,
    (SELECT {d('sum(refund_amount)')} FROM fact_returns WHERE {PAID}) AS total_refunds,
    {r(div(f'(SELECT sum(refund_amount) FROM fact_returns WHERE {PAID})', 'sum(sales_amount)'), 4)} AS refund_cost_ratio
    FROM fact_sales"""
)
SQL["b5_refunds_by_reason"] = star(
    f"SELECT reason, {d('sum(fact_returns.refund_amount)')} AS total_refunds FROM fact_returns WHERE {PAID} GROUP BY ALL"
)
SQL["b5_return_rates"] = REPORTS["q56"]
SQL["b5_problem_products"] = REPORTS["q57"]
SQL["b5_status_funnel"] = REPORTS["q58"]
SQL["b5_days_to_return"] = star(
    f"""SELECT reason, from_day, n AS returns, {pct('n', 'sum(n) OVER (PARTITION BY reason)')} AS share_pct
    FROM (SELECT reason, {i('floor((days_after_purchase - 1) / 7.0) * 7 + 1')} AS from_day, count(*) AS n
          FROM fact_returns GROUP BY ALL)"""
)
SQL["b6_seasonal_index"] = star(
    f"""SELECT series, month(month) AS month_number, {r('avg(seasonal)')} AS seasonal_index FROM parts GROUP BY ALL""", **PARTS
)


def filtered(condition: str, keys: str = "", group: str = "") -> str:
    return based(keys, group).replace("FROM wide", f"FROM wide WHERE {condition}")


SQL["b7_sliced_sales"] = filtered(
    """region IN ('ASIA', 'EUROPE') AND category = 'ECONOMY' AND sales_channel = 'Online' AND segment IN ('Premium', 'New')
    AND order_date BETWEEN DATE '1998-01-15' AND DATE '2000-06-30'"""
)
SQL["b7_sliced_inventory"] = star(
    """SELECT warehouse_id, region, count(*) FILTER (closing_stock = 0) AS stockout_events, count(*) AS total_product_lines, """
    + pct("count(*) FILTER (closing_stock = 0)", "count(*)")
    + """ AS stockout_rate_pct FROM fact_inventory JOIN dim_warehouses USING (warehouse_id) JOIN dim_products USING (product_id)
    WHERE warehouse_id IN (3, 7, 11) AND category = 'ECONOMY' GROUP BY ALL"""
)
SQL["b7_sliced_returns"] = star(
    f"""SELECT return_status, count(*) AS "count", {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM fact_returns
    JOIN fact_sales USING (order_id) JOIN dim_products USING (product_id)
    WHERE reason IN ('Late Delivery', 'Changed Mind') AND category = 'ECONOMY' GROUP BY return_status"""
)
SQL["b7_product_detail"] = filtered("product_id = 17", "month", "month")
SQL["b7_customer_detail"] = filtered("customer_id = 101", "month", "month")
SQL["b7_store_detail"] = filtered("store_id = 9", "month", "month")
SQL["b7_cube_total"] = based("")
SQL["b7_cube_region_category"] = based("region, category", "region, category")
SQL["b7_cube_segment_channel"] = based("segment, sales_channel", "segment, sales_channel")
SQL["b7_cube_sliced_months"] = filtered(
    "region IN ('ASIA', 'EUROPE') AND category = 'ECONOMY' AND sales_channel = 'Online' AND segment IN ('Premium', 'New')", "month", "month"
)
SQL["b7_cube_tiers"] = filtered("country IN ('ASIA', 'AFRICA')", "loyalty_tier, category", "loyalty_tier, category").replace(
    "region, segment,", "region, segment, loyalty_tier, country,"
)
