"""Oracle SQL of the reports Q01-Q69, the views, routines and plan examples."""

from __future__ import annotations

from oracle.base import d, div, i, pct, r, star

REV, PRO, N = "sum(sales_amount)", "sum(profit)", "count(*)"
MONTH = "CAST(date_trunc('month', order_date) AS DATE)"
BY_MONTH = f"SELECT {MONTH} AS month, {REV} AS revenue FROM fact_sales GROUP BY ALL"
BY_DAY = f"SELECT order_date, {REV} AS revenue FROM fact_sales GROUP BY ALL"
CUST_MONTH = f"SELECT customer_id, {MONTH} AS month, {REV} AS revenue FROM fact_sales GROUP BY ALL"
SOLD = f"""SELECT product_id, {REV} AS revenue, {PRO} AS profit, {N} AS orders, sum(quantity) AS units
  FROM fact_sales GROUP BY ALL"""
LINES = "SELECT * FROM fact_sales JOIN dim_products USING (product_id)"
SHARES = """SELECT product_id, revenue, sum(revenue) OVER (ORDER BY revenue DESC) AS reached, sum(revenue) OVER () AS whole
  FROM sold"""
ABC = """CASE WHEN reached * 100 <= whole * 80 THEN 'A' WHEN reached * 100 <= whole * 95 THEN 'B' ELSE 'C' END"""
RFM = """SELECT customer_id, date_diff('day', max(order_date), DATE '2001-08-01') AS recency_days, count(*) AS frequency,
  sum(sales_amount) AS monetary FROM fact_sales GROUP BY ALL"""
TILES = f"""SELECT customer_id, {i('recency_days')} AS recency_days, {i('frequency')} AS frequency, {d('monetary')} AS monetary,
  {i('ntile(5) OVER (ORDER BY recency_days DESC, customer_id)')} AS r_score,
  {i('ntile(5) OVER (ORDER BY frequency, customer_id)')} AS f_score,
  {i('ntile(5) OVER (ORDER BY monetary, customer_id)')} AS m_score FROM rfm"""
STOCK = f"""SELECT product_id, sum(sold_stock) AS total_sold, {div('sum(opening_stock + closing_stock) / 2.0', 'count(*)')} AS avg_stock,
  {div('sum(damaged_stock)', 'sum(received_stock)')} AS damage_rate,
  {div('count(*) FILTER (closing_stock = 0)', 'count(*)')} AS stockout_rate, sum(closing_stock) AS closing
  FROM fact_inventory GROUP BY ALL"""
TURN = div("total_sold", "avg_stock")
HEALTH = f"""SELECT product_id, {r(TURN)} AS turnover_ratio, {r('damage_rate * 100')} AS damage_rate_pct,
  {r('stockout_rate * 100')} AS stockout_rate_pct,
  {r(f"greatest(0.0, 100.0 - stockout_rate * 50 - damage_rate * 30 - CASE WHEN {TURN} < 0.5 THEN 20.0 ELSE 0.0 END)", 1)}
    AS inventory_health_score
  FROM stock"""


def band(light: str, deep: str, value: str = "discount") -> str:
    return f"""CASE WHEN {value} = 0 THEN '0% (no discount)' WHEN {value} <= {light} THEN '1-10%'
      WHEN {value} <= {deep} THEN '11-25%' ELSE '26%+' END"""


def growth(now: str, before: str) -> str:
    return pct(f"({now} - {before})", before)


def lagged(back: int = 1, part: str = "", order: str = "month") -> str:
    return f"lag(revenue, {back}) OVER ({part} ORDER BY {order})"


SQL: dict[str, str] = {}

SQL["q01"] = star(
    f"SELECT {d(REV)} AS total_revenue, {d(PRO)} AS total_profit, {pct(PRO, REV)} AS gross_margin_pct FROM fact_sales"
)
SQL["q02"] = star(
    f"""SELECT {d('p')} AS gross_profit, {d('refunds')} AS total_refunds, {d('p - refunds')} AS net_profit,
    {pct('(p - refunds)', 'a')} AS net_margin_pct FROM sums, paid""",
    sums=f"SELECT {PRO} AS p, {REV} AS a FROM fact_sales",
    paid="""SELECT coalesce(sum(refund_amount), 0) AS refunds FROM fact_returns
      WHERE return_status IN ('Approved', 'Refunded') AND order_id IN (SELECT order_id FROM fact_sales)""",
)
SQL["q03"] = star(
    f"SELECT sales_channel, {N} AS orders, {r(div(REV, N))} AS avg_order_value FROM fact_sales GROUP BY ALL"
)
SQL["q04"] = star(
    f"""SELECT category, {r(div('sum(discount)', N) + ' * 100')} AS avg_discount_pct, {pct(PRO, REV)} AS margin_pct
    FROM lines GROUP BY ALL""",
    lines=LINES,
)
SQL["q05"] = star(
    f"""SELECT {r(div('sum(quantity)', N))} AS avg_basket_size, {r(div(REV, 'sum(quantity)'))} AS revenue_per_unit
    FROM fact_sales"""
)
SQL["q06"] = star(
    f"""SELECT payment_method, {N} AS orders, {d(REV)} AS revenue, {pct(PRO, REV)} AS margin_pct
    FROM fact_sales GROUP BY ALL"""
)
SQL["q07"] = star(f"SELECT {MONTH} AS month, {d(REV)} AS revenue, {d(PRO)} AS profit FROM fact_sales GROUP BY ALL")
SQL["q08"] = star(
    f"SELECT {pct('sum(rev) FILTER (place <= 0.10)', 'sum(rev)')} AS pct_revenue_from_top_10pct_customers FROM placed",
    spend=f"SELECT customer_id, {REV} AS rev FROM fact_sales GROUP BY ALL",
    placed="SELECT rev, percent_rank() OVER (ORDER BY rev DESC) AS place FROM spend",
)
SQL["q09"] = star(
    f"""SELECT brand, {d('rv')} AS revenue, {d('pr')} AS profit, {pct('pr', 'rv')} AS margin_pct
    FROM (SELECT brand, {REV} AS rv, {PRO} AS pr FROM lines GROUP BY ALL) ORDER BY pr DESC, brand LIMIT 15""",
    lines=LINES,
)
SQL["q10"] = star(
    f"""SELECT segment, {N} AS orders, {d(REV)} AS revenue, {r(div(REV, N))} AS aov
    FROM fact_sales JOIN dim_customers USING (customer_id) GROUP BY ALL"""
)
SQL["q11"] = star(
    f"SELECT month, {d('revenue')} AS revenue, {growth('revenue', lagged())} AS mom_growth_pct FROM m", m=BY_MONTH
)
SQL["q12"] = star(
    f"SELECT quarter, {d('revenue')} AS revenue, {growth('revenue', lagged(order='quarter'))} AS qoq_growth_pct FROM q",
    q=f"SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS quarter, {REV} AS revenue FROM fact_sales GROUP BY ALL",
)
SQL["q13"] = star(
    f"""SELECT month, {d('revenue')} AS revenue, {d(lagged(12))} AS revenue_same_month_last_year,
    {growth('revenue', lagged(12))} AS yoy_growth_pct FROM m""",
    m=BY_MONTH,
)
SQL["q14"] = star(
    f"""SELECT category, yr, {d('revenue')} AS revenue,
    {growth('revenue', lagged(1, 'PARTITION BY category', 'yr'))} AS yoy_growth_pct FROM cy""",
    lines=LINES,
    cy=f"SELECT category, year(order_date) AS yr, {REV} AS revenue FROM lines GROUP BY ALL",
)
SQL["q15"] = star(
    f"""SELECT region, yr, {d('revenue')} AS revenue, {d('change')} AS delta
    FROM (SELECT *, revenue - {lagged(1, 'PARTITION BY region', 'yr')} AS change FROM ry) WHERE change < 0""",
    ry=f"""SELECT region, year(order_date) AS yr, {REV} AS revenue
      FROM fact_sales JOIN dim_stores USING (store_id) GROUP BY ALL""",
)
SQL["q16"] = star(
    f"""SELECT order_date, {d('revenue')} AS daily_revenue, {d('sum(revenue) OVER (ORDER BY order_date)')}
    AS running_total_revenue FROM t""",
    t=BY_DAY,
)
SEVEN = "OVER (ORDER BY order_date ROWS 6 PRECEDING)"
SQL["q17"] = star(
    f"""SELECT order_date, {d('revenue')} AS revenue,
    {r(div(f'sum(revenue) {SEVEN}', f'count(*) {SEVEN}'))} AS moving_avg_7d FROM t""",
    t=BY_DAY,
)
SQL["q18"] = star(
    f"""SELECT category, product_id, product_name, {d('revenue')} AS revenue,
    dense_rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS rnk
    FROM sold JOIN dim_products USING (product_id) QUALIFY rnk <= 3""",
    sold=SOLD,
)
NEAR = "OVER (PARTITION BY customer_id ORDER BY month)"
SQL["q19"] = star(
    f"""SELECT customer_id, month, {d('revenue')} AS revenue, {d(f'lag(revenue) {NEAR}')} AS prev_month_revenue,
    {d(f'lead(revenue) {NEAR}')} AS next_month_revenue FROM cm ORDER BY customer_id, month LIMIT 200""",
    cm=CUST_MONTH,
)
SQL["q20"] = star(
    f"""SELECT quartile, {N} AS num_products, {d('sum(revenue)')} AS total_revenue
    FROM (SELECT revenue, {i('ntile(4) OVER (ORDER BY revenue DESC, product_id)')} AS quartile FROM sold) GROUP BY ALL""",
    sold=SOLD,
)
SQL["q21"] = star(
    """SELECT customer_id, min(order_date) AS first_purchase, max(order_date) AS last_purchase
    FROM fact_sales GROUP BY ALL ORDER BY customer_id LIMIT 200"""
)
SQL["q22"] = star(
    f"""SELECT customer_id, order_id, order_date, {d('sales_amount')} AS sales_amount FROM fact_sales
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY fact_sales.sales_amount DESC, order_id) = 1
    ORDER BY fact_sales.sales_amount DESC, order_id LIMIT 50"""
)
SQL["q23"] = star(
    f"SELECT product_id, {d('revenue')} AS revenue, {pct('reached', 'whole')} AS cumulative_pct FROM shares",
    sold=SOLD,
    shares=SHARES,
)
SQL["q24"] = star(
    """SELECT *, r_score + f_score + m_score AS rfm_total, CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champion'
    WHEN r_score + f_score + m_score >= 10 THEN 'Loyal' WHEN r_score + f_score + m_score >= 7 THEN 'At Risk'
    ELSE 'Lost' END AS rfm_segment FROM tiles ORDER BY rfm_total DESC, customer_id LIMIT 200""",
    rfm=RFM,
    tiles=TILES,
)
SQL["q25"] = star(
    f"""SELECT loyalty_tier, {N} AS customers, {r(div('sum(lifetime_value)', N))} AS avg_ltv,
    {d('min(lifetime_value)')} AS min_ltv, {d('max(lifetime_value)')} AS max_ltv FROM dim_customers GROUP BY ALL"""
)
SQL["q26"] = star(
    f"""SELECT {pct('count(*) FILTER (n > 1)', N)} AS repeat_purchase_rate_pct
    FROM (SELECT customer_id, {N} AS n FROM fact_sales GROUP BY ALL)"""
)
SQL["q27"] = star(
    f"SELECT CAST(date_trunc('month', signup_date) AS DATE) AS signup_month, {N} AS new_customers FROM dim_customers GROUP BY ALL"
)
SQL["q28"] = star(
    f"""SELECT cohort_month, month_number, active_customers, cohort_customers,
    {pct('active_customers', 'cohort_customers')} AS retention_pct
    FROM (SELECT cohort_month, date_diff('month', cohort_month, {MONTH}) AS month_number,
            count(DISTINCT customer_id) AS active_customers
          FROM fact_sales JOIN cohort USING (customer_id) GROUP BY ALL)
    JOIN (SELECT cohort_month, {N} AS cohort_customers FROM cohort GROUP BY ALL) USING (cohort_month)
    WHERE month_number BETWEEN 0 AND 12""",
    cohort="SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month FROM dim_customers",
)
SQL["q29"] = star(
    f"""SELECT count(*) FILTER (seen < DATE '2001-08-01' - INTERVAL 180 DAY) AS churned_customers,
    {N} AS total_customers_with_orders,
    {pct("count(*) FILTER (seen < DATE '2001-08-01' - INTERVAL 180 DAY)", N)} AS churn_rate_pct
    FROM (SELECT max(order_date) AS seen FROM fact_sales GROUP BY customer_id)"""
)
SQL["q30"] = star(
    f"""SELECT segment, {d(PRO)} AS total_profit, {r(div(PRO, 'count(DISTINCT customer_id)'))} AS profit_per_customer
    FROM fact_sales JOIN dim_customers USING (customer_id) GROUP BY ALL"""
)
SQL["q31"] = star(
    f"""SELECT CASE WHEN lifetime_value >= 1000000 THEN 'High Value' WHEN lifetime_value >= 700000 THEN 'Mid Value'
    WHEN lifetime_value > 0 THEN 'Low Value' ELSE 'No Purchases' END AS spend_tier, {N} AS customers,
    {r(div('sum(lifetime_value)', N))} AS avg_ltv FROM dim_customers GROUP BY ALL"""
)
SQL["q32"] = star(
    f"""SELECT customer_id, {r(div('sum(gap)', 'count(gap)'), 1)} AS avg_days_between_purchases
    FROM (SELECT customer_id, date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date),
            order_date) AS gap FROM fact_sales)
    GROUP BY ALL HAVING count(gap) >= 3 ORDER BY avg_days_between_purchases, customer_id LIMIT 50"""
)


def fading(month: str) -> str:
    prior = "OVER (PARTITION BY customer_id ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
    return star(
        f"""SELECT customer_id, month, {d('revenue')} AS revenue, {r('usual', 4)} AS prior_3mo_avg FROM tr
        WHERE {d('revenue')} < 0.3 * usual AND month = {month} ORDER BY usual DESC, customer_id LIMIT 50""",
        cm=CUST_MONTH,
        tr=f"SELECT *, {div(f'sum(revenue) {prior}', f'count(revenue) {prior}')} AS usual FROM cm",
    )


SQL["q33"] = fading("(SELECT max(month) FROM cm)")
SQL["q33_full_month"] = fading("DATE '2001-07-01'")
SQL["q34"] = star(
    f"""SELECT {MONTH} AS month, {d('sum(sales_amount) FILTER (order_date = opened)')} AS new_customer_revenue,
    {d('sum(sales_amount) FILTER (order_date <> opened)')} AS returning_customer_revenue
    FROM fact_sales JOIN (SELECT customer_id, min(order_date) AS opened FROM fact_sales GROUP BY ALL) USING (customer_id)
    GROUP BY ALL"""
)
FAVOURITE = f"""SELECT customer_id, category FROM
  (SELECT customer_id, category, {REV} AS spent FROM fact_sales JOIN dim_products USING (product_id) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY spent DESC, category) = 1"""
SQL["q35"] = star(
    f"""SELECT customer_id, country, loyalty_tier, {d('dim_customers.lifetime_value')} AS lifetime_value,
    category AS favorite_category FROM dim_customers JOIN favourite USING (customer_id)
    ORDER BY dim_customers.lifetime_value DESC, customer_id LIMIT 20""",
    favourite=FAVOURITE,
)
CLASSED = f"""SELECT product_id, {d('revenue')} AS revenue, {pct('reached', 'whole')} AS cumulative_pct, {ABC} AS abc_class
  FROM shares"""
SQL["q36"] = star(CLASSED, sold=SOLD, shares=SHARES)
SQL["q37"] = star(
    f"""SELECT abc_class, {N} AS num_skus, {pct(N, '(SELECT count(*) FROM shares)')} AS pct_of_skus,
    {d('sum(revenue)')} AS revenue, {pct('sum(revenue)', '(SELECT sum(revenue) FROM shares)')} AS pct_of_revenue
    FROM (SELECT revenue, {ABC} AS abc_class FROM shares) GROUP BY ALL""",
    sold=SOLD,
    shares=SHARES,
)
SQL["q38"] = star(
    f"""SELECT category, {d('rv')} AS revenue, {pct('rv', '(SELECT sum(sales_amount) FROM fact_sales)')}
    AS pct_of_total_revenue FROM (SELECT category, {REV} AS rv FROM lines GROUP BY ALL)""",
    lines=LINES,
)
NAMED = "FROM sold JOIN dim_products USING (product_id)"
SQL["q39"] = star(
    f"""SELECT product_id, product_name, category, {d('sold.revenue')} AS revenue, {i('units')} AS units_sold {NAMED}
    ORDER BY sold.revenue DESC, product_id LIMIT 10""",
    sold=SOLD,
)
SQL["q40"] = star(
    f"""SELECT product_id, product_name, category, {d('sold.revenue')} AS revenue, orders, {d('sold.profit')} AS profit {NAMED}
    WHERE orders >= 5 ORDER BY sold.revenue, product_id LIMIT 10""",
    sold=SOLD,
)
SQL["q41"] = star(
    f"""SELECT product_id, product_name, category, {d('sold.revenue')} AS revenue, {d('sold.profit')} AS profit,
    {pct('sold.profit', 'sold.revenue')} AS margin_pct {NAMED}
    WHERE sold.revenue > 0 ORDER BY margin_pct, product_id LIMIT 15""",
    sold=SOLD,
)
SQL["q42"] = star(
    f"""SELECT category, {band('0.03', '0.07')} AS discount_band, {N} AS orders, {d(REV)} AS revenue,
    {pct(PRO, REV)} AS margin_pct FROM lines GROUP BY ALL""",
    lines=LINES,
)
SQL["q43"] = star(
    f"""SELECT CASE WHEN launch_date >= DATE '2000-01-01' THEN 'Launched 2000' ELSE 'Launched Before 2000' END AS launch_cohort,
    count(DISTINCT product_id) AS num_products, {d(REV)} AS revenue,
    {r(div(REV, 'count(DISTINCT product_id)'))} AS revenue_per_product FROM lines GROUP BY ALL""",
    lines=LINES,
)
SQL["q44"] = star(
    f"""SELECT category, subcategory, {d('rv')} AS revenue, {pct('pr', 'rv')} AS margin_pct,
    rank() OVER (PARTITION BY category ORDER BY pr DESC) AS rnk
    FROM (SELECT category, subcategory, {REV} AS rv, {PRO} AS pr FROM lines GROUP BY ALL) QUALIFY rnk = 1""",
    lines=LINES,
)
SQL["q45"] = star(
    f"""SELECT supplier, n AS num_products, {d('rv')} AS revenue, {pct('pr', 'rv')} AS margin_pct
    FROM (SELECT supplier, count(DISTINCT product_id) AS n, {REV} AS rv, {PRO} AS pr FROM lines GROUP BY ALL)
    ORDER BY rv DESC, supplier LIMIT 15""",
    lines=LINES,
)
SQL["q46"] = star(
    f"""SELECT product_id, {i('total_sold')} AS total_sold, {r('stock.avg_stock', 1)} AS avg_stock, {r(TURN)} AS turnover_ratio
    FROM stock ORDER BY turnover_ratio DESC NULLS FIRST, product_id LIMIT 20""".replace("avg_stock AS DOUBLE", "stock.avg_stock AS DOUBLE"),
    stock=STOCK,
)
SQL["q47"] = star(
    f"""SELECT product_id, product_name, warehouse_id, region, {i('f.closing_stock')} AS closing_stock,
    {i('f.reorder_level')} AS reorder_level, {i('f.lead_time_days')} AS lead_time_days
    FROM fact_inventory f JOIN dim_products USING (product_id) JOIN dim_warehouses USING (warehouse_id)
    WHERE f.closing_stock <= f.reorder_level ORDER BY f.reorder_level - f.closing_stock DESC, product_id, warehouse_id LIMIT 30"""
)
SQL["q48"] = star(
    f"""SELECT f.product_id, product_name, category, {i('sum(f.closing_stock)')} AS total_stock_on_hand,
    {i('coalesce(sum(s.quantity), 0)')} AS units_sold_lifetime
    FROM fact_inventory f JOIN dim_products p ON p.product_id = f.product_id LEFT JOIN fact_sales s ON s.product_id = f.product_id
    GROUP BY ALL HAVING sum(f.closing_stock) > 0
    ORDER BY units_sold_lifetime, total_stock_on_hand DESC, f.product_id LIMIT 20"""
)
SQL["q48_single"] = star(
    f"""SELECT product_id, product_name, category, {i('held')} AS total_stock_on_hand, {i('coalesce(units, 0)')} AS units_sold_lifetime
    FROM (SELECT product_id, sum(closing_stock) AS held FROM fact_inventory GROUP BY ALL)
    JOIN dim_products USING (product_id) LEFT JOIN sold USING (product_id)
    WHERE held > 0 ORDER BY units_sold_lifetime, total_stock_on_hand DESC, product_id LIMIT 20""",
    sold=SOLD,
)
SQL["q49"] = star(
    f"""SELECT product_id, {i('total_sold')} AS total_sold, {r('t')} AS turnover_ratio
    FROM (SELECT product_id, total_sold, {TURN} AS t FROM stock)
    WHERE t >= (SELECT percentile_cont(0.9) WITHIN GROUP (ORDER BY {TURN}) FROM stock)
    ORDER BY turnover_ratio DESC, product_id LIMIT 20""",
    stock=STOCK,
)
SQL["q50"] = star(
    f"""SELECT warehouse_id, region, count(*) FILTER (closing_stock = 0) AS stockout_events, {N} AS total_product_lines,
    {pct('count(*) FILTER (closing_stock = 0)', N)} AS stockout_rate_pct
    FROM fact_inventory JOIN dim_warehouses USING (warehouse_id) GROUP BY ALL
    ORDER BY stockout_rate_pct DESC, warehouse_id LIMIT 20"""
)
SQL["q51"] = star(
    "SELECT * FROM health ORDER BY inventory_health_score, product_id LIMIT 20", stock=STOCK, health=HEALTH
)
SQL["q52"] = star(
    f"""SELECT CASE WHEN supplier_rating >= 4.5 THEN '4.5-5.0' WHEN supplier_rating >= 4 THEN '4.0-4.49'
    WHEN supplier_rating >= 3.5 THEN '3.5-3.99' WHEN supplier_rating >= 3 THEN '3.0-3.49' ELSE 'Below 3.0' END AS rating_band,
    {N} AS records, {r(f"avg({div('damaged_stock', 'received_stock')}) * 100", 3)} AS avg_damage_rate_pct
    FROM fact_inventory GROUP BY ALL"""
)
SQL["q53"] = star(
    f"""SELECT region, {r(div('sum(lead_time_days)', N), 1)} AS avg_lead_time_days, count(DISTINCT warehouse_id) AS warehouses
    FROM fact_inventory JOIN dim_warehouses USING (warehouse_id) GROUP BY ALL"""
)
SQL["q54"] = star(
    f"""SELECT total_orders, total_returns, {pct('total_returns', 'total_orders')} AS return_rate_pct, total_refund_cost
    FROM (SELECT {N} AS total_orders FROM fact_sales),
         (SELECT {N} AS total_returns, {d('sum(refund_amount)')} AS total_refund_cost FROM fact_returns)"""
)
SQL["q55"] = star(
    f"""SELECT reason, {N} AS return_count, {pct(N, '(SELECT count(*) FROM fact_returns)')} AS pct_of_returns,
    {d('sum(refund_amount)')} AS refund_cost FROM fact_returns GROUP BY ALL"""
)
BACK = """SELECT product_id, supplier, product_name, category, s.order_id, return_id
  FROM fact_sales s JOIN dim_products USING (product_id) LEFT JOIN fact_returns r ON r.order_id = s.order_id"""
RATE = "count(DISTINCT order_id) AS orders, count(DISTINCT return_id) AS returns, " + (
    f"{pct('count(DISTINCT return_id)', 'count(DISTINCT order_id)')} AS return_rate_pct"
)
SQL["q56"] = star(f"SELECT category, {RATE} FROM back GROUP BY ALL", back=BACK)
SQL["q57"] = star(
    f"""SELECT product_id, product_name, supplier, {RATE} FROM back GROUP BY ALL HAVING count(DISTINCT order_id) >= 10
    ORDER BY return_rate_pct DESC, product_id LIMIT 20""",
    back=BACK,
)
SQL["q58"] = star(
    f"""SELECT return_status, {N} AS "count", {pct(N, '(SELECT count(*) FROM fact_returns)')} AS pct
    FROM fact_returns GROUP BY return_status"""
)
SQL["q59"] = star(
    f"""SELECT reason, {r(div('sum(days_after_purchase)', N), 1)} AS avg_days_to_return, {N} AS n
    FROM fact_returns GROUP BY ALL"""
)
SQL["q60"] = star(
    f"""SELECT region, {d(REV)} AS revenue, {d(PRO)} AS profit, {pct(PRO, REV)} AS margin_pct
    FROM fact_sales JOIN dim_stores USING (store_id) GROUP BY ALL"""
)
SQL["q61"] = star(
    f"""SELECT store_id, {d('rv')} AS revenue, rank() OVER (ORDER BY rv DESC) AS store_rank
    FROM (SELECT store_id, {REV} AS rv FROM fact_sales GROUP BY ALL) ORDER BY rv DESC, store_id LIMIT 10"""
)
SQL["q62"] = star(
    f"SELECT year(order_date) AS yr, sales_channel, {d(REV)} AS revenue FROM fact_sales GROUP BY ALL"
)
SQL["q63"] = star(
    "SELECT country, "
    + ", ".join(
        f"{d(f'sum(sales_amount) FILTER (segment = {chr(39)}{s}{chr(39)})')} AS {s.lower()}_revenue"
        for s in ("Premium", "Regular", "Budget", "New")
    )
    + " FROM fact_sales JOIN dim_customers USING (customer_id) GROUP BY ALL"
)
SQL["q64"] = star(
    f"""SELECT CAST(g.month AS DATE) AS month, coalesce({d('m.revenue')}, 0) AS revenue
    FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS month) g
    LEFT JOIN m ON m.month = g.month""",
    m=BY_MONTH,
)
SQL["q65"] = star(
    f"""SELECT order_id, customer_id, {d('fact_sales.sales_amount')} AS sales_amount FROM fact_sales
    QUALIFY fact_sales.sales_amount * count(*) OVER (PARTITION BY customer_id)
      > sum(fact_sales.sales_amount) OVER (PARTITION BY customer_id)
    ORDER BY fact_sales.sales_amount DESC, order_id LIMIT 20"""
)
SQL["q66"] = star(
    """SELECT product_id, product_name, category, m AS product_margin_pct, usual AS category_avg_margin_pct
    FROM compared WHERE m > usual ORDER BY m - usual DESC, product_id LIMIT 20""",
    sold=SOLD,
    margins=f"SELECT product_id, product_name, category, {pct('sold.profit', 'sold.revenue')} AS m {NAMED} WHERE sold.revenue <> 0",
    compared=f"""SELECT *, {d('sum(CAST(m AS DECIMAL(18,2))) OVER (PARTITION BY category)')}
      / count(*) OVER (PARTITION BY category) AS usual FROM margins""",
)
SQL["q67"] = star(
    f"""SELECT 'dim_customers' AS table_name, {N} AS total_rows, count(*) FILTER (income IS NULL) AS missing_income,
    count(*) FILTER (loyalty_tier IS NULL) AS missing_loyalty_tier FROM dim_customers
    UNION ALL SELECT 'dim_products', {N}, count(*) FILTER (supplier IS NULL), count(*) FILTER (launch_date IS NULL)
    FROM dim_products"""
)
SQL["q67_long"] = star(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {N} AS total_rows,
        count(*) FILTER ({c} IS NULL) AS missing_rows FROM {t}"""
        for t, c in (
            ("dim_customers", "income"),
            ("dim_customers", "loyalty_tier"),
            ("dim_products", "supplier"),
            ("dim_products", "launch_date"),
        )
    )
)
SQL["q68"] = star(
    f"""SELECT customer_id, country, loyalty_tier, {d('c.lifetime_value')} AS lifetime_value FROM dim_customers c
    WHERE c.lifetime_value > 0 AND customer_id NOT IN
      (SELECT customer_id FROM fact_sales WHERE order_id IN (SELECT order_id FROM fact_returns))
    ORDER BY c.lifetime_value DESC, customer_id LIMIT 20"""
)
THREE = "OVER (ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
SQL["q69"] = star(
    f"""SELECT month, {d('revenue')} AS revenue, {r('usual')} AS trailing_3mo_avg,
    CASE WHEN usual IS NULL THEN 'Insufficient History' WHEN {d('revenue')} >= usual THEN 'Above Trend' ELSE 'Below Trend' END
      AS trend_flag
    FROM (SELECT month, revenue, {div(f'sum(revenue) {THREE}', f'count(*) {THREE}')} AS usual FROM m)""",
    m=BY_MONTH,
)

SQL["v1_monthly_kpis"] = star(
    f"""SELECT {MONTH} AS month, {N} AS orders, count(DISTINCT customer_id) AS active_customers, {d(REV)} AS revenue,
    {d(PRO)} AS profit, {pct(PRO, REV)} AS margin_pct, {r(div(REV, N))} AS avg_order_value FROM fact_sales GROUP BY month"""
)
SQL["v2_customer_rfm"] = star("SELECT * FROM tiles", rfm=RFM, tiles=TILES)
SQL["v3_product_abc"] = SQL["q36"]
SQL["v4_inventory_health"] = star("SELECT * FROM health", stock=STOCK, health=HEALTH)
for view in ("v1_monthly_kpis", "v2_customer_rfm", "v3_product_abc", "v4_inventory_health"):  # loads keep the same views
    SQL[f"{view[:2]}_after_loads"] = SQL[view]
CUSTOMER_OUT = f"""customer_id, {i('age')} AS age, gender, city, state, country, segment, {d('income')} AS income, signup_date,
  {d('lifetime_value')} AS lifetime_value, loyalty_tier"""
# the routine is applied to customers whose stored value and tier were reset; ids divisible by 50 have no sales
SQL["r1_refresh_customer_ltv"] = star(
    f"""SELECT customer_id, {d('now.v')} AS lifetime_value, CASE WHEN now.v >= q90 THEN 'Platinum' WHEN now.v >= q70 THEN 'Gold'
    WHEN now.v >= q40 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier FROM now, cuts""",
    now=f"""SELECT c_custkey AS customer_id, CAST(coalesce(ltv, 1000000) AS DOUBLE) AS v
      FROM customer LEFT JOIN customer_ltv ON customer_id = c_custkey""",
    cuts="""SELECT percentile_cont(0.9) WITHIN GROUP (ORDER BY v) AS q90, percentile_cont(0.7) WITHIN GROUP (ORDER BY v) AS q70,
      percentile_cont(0.4) WITHIN GROUP (ORDER BY v) AS q40 FROM now""",
)
SQL["r2_top_products_by_category"] = star(
    f"""SELECT product_id, product_name, {d('sold.revenue')} AS revenue {NAMED}
    WHERE category = 'ECONOMY' ORDER BY sold.revenue DESC, product_id LIMIT 10""",
    sold=SOLD,
)
SQL["r3_monthly_growth"] = star(
    f"SELECT month, {d('revenue')} AS revenue, {growth('revenue', lagged())} AS growth_pct FROM m", m=BY_MONTH
)
SQL["r4_profit_recomputed"] = star(
    f"""SELECT sales_channel, {N} AS orders, {d('sum(round(sales_amount - cost_price * quantity, 2))')} AS profit,
    {d('min(round(sales_amount - cost_price * quantity, 2))')} AS least,
    {d('max(round(sales_amount - cost_price * quantity, 2))')} AS most FROM lines GROUP BY ALL""",
    lines=LINES,
)
SQL["r5_stock_mismatches"] = star(
    f"""SELECT product_id, warehouse_id, {i('opening_stock + received_stock - sold_stock - damaged_stock')} AS expected_stock,
    {i('f.closing_stock')} AS closing_stock FROM fact_inventory f
    WHERE f.closing_stock <> opening_stock + received_stock - sold_stock - damaged_stock"""
)
SQL["g1_revenue_in_range"] = star(
    f"SELECT {d(REV)} AS revenue FROM fact_sales WHERE order_date BETWEEN DATE '2000-11-01' AND DATE '2000-12-31'"
)
SQL["g2_revenue_of_category"] = star(
    f"SELECT category, {d(REV)} AS revenue FROM lines WHERE category = 'ECONOMY' GROUP BY ALL", lines=LINES
)
SQL["g3_revenue_by_store_since"] = star(
    f"SELECT store_id, {d(REV)} AS revenue FROM fact_sales WHERE order_date >= DATE '2000-01-01' GROUP BY ALL"
)
