"""Oracle SQL of the date tables and the measure library."""

from __future__ import annotations

from oracle.base import d, div, i, r, star

SQL: dict[str, str] = {}

SQL["k1_dim_date"] = star(
    """SELECT day AS date, year(day) AS year, month(day) AS month_number, monthname(day) AS month_name,
    left(monthname(day), 3) AS month_short, 'Q' || quarter(day) AS quarter, strftime(day, '%Y-%m') AS year_month,
    dayname(day) AS day_of_week, isodow(day) > 5 AS is_weekend, year(day) AS fiscal_year,
    (SELECT count(*) FROM fact_sales WHERE order_date = day) AS orders
    FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', (SELECT min(order_date) FROM fact_sales)) AS DATE),
      make_date(year((SELECT max(order_date) FROM fact_sales)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS day)"""
)
TARGETS = """SELECT CAST(m AS DATE) AS month, CAST(900000 + 10000 * month(m) AS DOUBLE) AS target
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS m)"""

PAID = "return_status IN ('Approved', 'Refunded')"
DAYS = """SELECT order_date, sum(sales_amount) AS revenue, sum(profit) AS profit, count(*) AS orders FROM fact_sales GROUP BY ALL"""
MONTHS = """SELECT CAST(s.m AS DATE) AS month, sum(revenue) AS revenue, sum(profit) AS profit, sum(orders) AS orders,
  nullif(count(order_date), 0) AS days_sold
  FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(order_date)) FROM days),
    (SELECT date_trunc('month', max(order_date)) FROM days), INTERVAL 1 MONTH)) AS m) s
  LEFT JOIN days ON date_trunc('month', order_date) = s.m GROUP BY ALL"""
TIMES = {"days": DAYS, "months": MONTHS}


def based(keys: str, group: str = "") -> str:
    """All base measures for a grouping of sales lines joined to their dimensions."""
    by = f"{keys}, " if keys else ""
    tail = f"GROUP BY {group}" if group else ""
    p, v, n, c, f = "sum(profit)", "sum(sales_amount)", "count(*)", "count(DISTINCT customer_id)", "sum(refunds)"
    return star(
        f"""SELECT {by}{d(v)} AS total_revenue, {d(p)} AS total_profit, {n} AS total_orders,
        {i('sum(quantity)')} AS total_units_sold, {c} AS distinct_customers, {r(div(v, n))} AS average_order_value,
        {r(div('sum(discount)', n), 4)} AS average_discount, {d(f)} AS total_refunds, {r(div(p, v), 4)} AS gross_margin,
        {d(f'{p} - coalesce({f}, 0)')} AS net_profit, {r(div(f'({p} - coalesce({f}, 0))', v), 4)} AS net_margin,
        {r(div(p, c))} AS profit_per_customer, {r(div(p, n))} AS profit_per_order FROM wide {tail}""",
        wide=f"""SELECT fact_sales.*, category, region, segment, CAST(date_trunc('month', order_date) AS DATE) AS month, refunds
          FROM fact_sales JOIN dim_products USING (product_id) JOIN dim_stores USING (store_id)
          JOIN dim_customers USING (customer_id) LEFT JOIN
          (SELECT order_id, sum(refund_amount) AS refunds FROM fact_returns WHERE {PAID} GROUP BY ALL) USING (order_id)""",
    )


SQL["d_base_margin"] = based("month", "month")
SQL["d_base_total"] = based("")
SQL["d_base_region_category"] = based("region, category", "region, category")
SQL["d_base_segment_channel"] = based("segment, sales_channel", "segment, sales_channel")


def back(column: str, n: int) -> str:
    return f"lag({column}, {n}) OVER (ORDER BY month)"


def last(column: str, n: int, what: str = "sum") -> str:
    return f"{what}({column}) OVER (ORDER BY month ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def grow(column: str, n: int) -> str:
    return r(div(f"({column} - {back(column, n)})", back(column, n)), 4)


YTD = "SELECT *, sum(revenue) OVER (PARTITION BY year(month) ORDER BY month) AS ytd FROM months"
SQL["d_time_intelligence"] = star(
    f"""SELECT month, {d('sum(revenue) OVER (ORDER BY month)')} AS running_total_revenue, {d('ytd')} AS revenue_ytd,
    {d("sum(revenue) OVER (PARTITION BY date_trunc('quarter', month) ORDER BY month)")} AS revenue_qtd,
    {d('sum(profit) OVER (PARTITION BY year(month) ORDER BY month)')} AS profit_ytd,
    {d(last('revenue', 12))} AS rolling_12_month_revenue, {d(last('revenue', 3))} AS rolling_3_month_revenue,
    {d(back('revenue', 12))} AS prior_year_revenue, {d(back('ytd', 12))} AS prior_year_revenue_ytd FROM y""",
    **TIMES,
    y=YTD,
)
WEEK = "OVER (ORDER BY order_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"
SQL["d_daily"] = star(
    f"""SELECT order_date, {d('revenue')} AS total_revenue,
    {d("sum(revenue) OVER (PARTITION BY date_trunc('month', order_date) ORDER BY order_date)")} AS revenue_mtd,
    {r(div(f'sum(revenue) {WEEK}', f'count(revenue) {WEEK}'))} AS revenue_7_day_moving_avg FROM every""",
    days=DAYS,
    every="""SELECT CAST(s.t AS DATE) AS order_date, revenue FROM (SELECT unnest(generate_series(
      (SELECT min(order_date) FROM days), (SELECT max(order_date) FROM days), INTERVAL 1 DAY)) AS t) s
      LEFT JOIN days ON days.order_date = s.t""",
)
SQL["d_moving_avg"] = star(
    f"""SELECT month, {d('revenue')} AS total_revenue,
    {r(div(last('revenue', 3), last('days_sold', 3)))} AS revenue_3_month_moving_avg,
    {r(div(last('orders', 3), last('days_sold', 3)))} AS orders_3_month_moving_avg,
    {r(div(last('revenue', 3), last('revenue', 3, 'count')))} AS monthly_3_month_moving_avg FROM months""",
    **TIMES,
)
SQL["d_growth"] = star(
    f"""SELECT month, {d('revenue')} AS total_revenue, {d(back('revenue', 1))} AS revenue_prior_month,
    {grow('revenue', 1)} AS mom_growth, {d(back('revenue', 3))} AS revenue_prior_quarter, {grow('revenue', 3)} AS qoq_growth,
    {grow('revenue', 12)} AS yoy_growth, {grow('ytd', 12)} AS yoy_growth_ytd, {grow('profit', 12)} AS profit_yoy_growth
    FROM y""",
    **TIMES,
    y=YTD,
)
SQL["d_growth_quarter"] = star(
    f"""SELECT quarter, {d('q')} AS total_revenue, {d('lag(q) OVER (ORDER BY quarter)')} AS revenue_prior_quarter,
    {r(div('(q - lag(q) OVER (ORDER BY quarter))', 'lag(q) OVER (ORDER BY quarter)'), 4)} AS qoq_growth
    FROM (SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS quarter, sum(revenue) AS q FROM days GROUP BY ALL)""",
    days=DAYS,
)


def ranks(dim: str, key: str, name: str, more: str = "") -> str:
    place = "dense_rank() OVER (ORDER BY v DESC)"
    return star(
        f"""SELECT {key}, {d('v')} AS total_revenue, {place} AS {name}{more.replace('PLACE', place)} FROM
        (SELECT {key}, coalesce(v, 0) AS v FROM {dim}
         LEFT JOIN (SELECT {key}, sum(sales_amount) AS v FROM fact_sales GROUP BY ALL) USING ({key}))"""
    )


SQL["d_rank_product"] = ranks(
    "dim_products", "product_id", "product_revenue_rank",
    ", CASE WHEN PLACE <= 10 THEN 'Top 10' ELSE 'Other' END AS is_top_10_product",
)
SQL["d_rank_customer"] = ranks("dim_customers", "customer_id", "customer_ltv_rank")
SQL["d_rank_store"] = ranks("dim_stores", "store_id", "store_revenue_rank")
SQL["d_rank_category"] = star(
    f"""SELECT category, {d('p')} AS total_profit, dense_rank() OVER (ORDER BY p DESC) AS category_profit_rank
    FROM (SELECT category, coalesce(sum(profit), 0) AS p FROM dim_products LEFT JOIN fact_sales USING (product_id) GROUP BY ALL)"""
)
SQL["d_kpi_switch"] = star(
    f"""SELECT month, 'Revenue' AS kpi_name, {d('v')} AS kpi_value FROM k UNION ALL SELECT month, 'Profit', {d('p')} FROM k
    UNION ALL SELECT month, 'Orders', {d('n')} FROM k UNION ALL SELECT month, 'Margin %', {r(div('p', 'v'), 4)} FROM k
    UNION ALL SELECT month, 'AOV', {r(div('v', 'n'))} FROM k""",
    k="""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(sales_amount) AS v, sum(profit) AS p, count(*) AS n
      FROM fact_sales GROUP BY ALL""",
)
SQL["d_kpi_selected"] = star(
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {r(div('sum(profit)', 'sum(sales_amount)'), 4)}
    AS selected_kpi_value FROM fact_sales GROUP BY month"""
)
SQL["d_flags"] = star(
    f"""SELECT month, CASE WHEN margin >= 0.2 THEN 'Healthy' WHEN margin >= 0.1 THEN 'Watch' ELSE 'At Risk' END AS margin_health_flag,
    CASE WHEN mom > 0.02 THEN '▲' WHEN mom < -0.02 THEN '▼' ELSE '▬' END AS growth_trend_icon,
    CASE WHEN {d('revenue')} >= usual THEN 'Above Trend' ELSE 'Below Trend' END AS above_or_below_trailing_average
    FROM (SELECT month, revenue, {div('profit', 'revenue')} AS margin,
      {div(f"(revenue - {back('revenue', 1)})", back('revenue', 1))} AS mom,
      {div(last('revenue', 3), last('days_sold', 3))} AS usual FROM months)""",
    **TIMES,
)
SQL["d_variance"] = star(
    f"""SELECT month, target AS target_revenue, {r('gap')} AS revenue_variance_vs_target,
    {r('gap / target', 4)} AS revenue_variance_pct_vs_target,
    CASE WHEN gap / target >= 0 THEN 'On/Above Target' WHEN gap / target >= -0.05 THEN 'Slightly Below' ELSE 'Materially Below' END
      AS variance_status
    FROM (SELECT t.month, target, coalesce({d('revenue')}, 0) - target AS gap FROM targets t LEFT JOIN months USING (month))""",
    **TIMES,
    targets=TARGETS,
)
SQL["d_customer_returns"] = star(
    f"""SELECT month, {r(div('count(*) FILTER (n > 1)', 'count(*)'), 4)} AS repeat_purchase_rate,
    (SELECT {r(div('sum(lifetime_value)', 'count(*)'))} FROM dim_customers) AS average_customer_lifetime_value,
    {r(div('nullif(sum(back), 0)', 'sum(n)'), 4)} AS return_rate, {r(div('sum(refunds)', 'sum(v)'), 4)} AS refund_cost_ratio
    FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, customer_id, count(*) AS n, sum(sales_amount) AS v,
            count(return_id) AS back, sum(refund_amount) FILTER ({PAID}) AS refunds
          FROM fact_sales LEFT JOIN fact_returns USING (order_id) GROUP BY ALL) GROUP BY month"""
)
SQL["d_inventory"] = star(
    f"""SELECT category, {r(div('sum(sold_stock)', div('sum(f.closing_stock)', 'count(*)')))} AS turnover_ratio_closing,
    {r(div('count(*) FILTER (f.closing_stock = 0)', 'count(*)'), 4)} AS stockout_rate
    FROM fact_inventory f JOIN dim_products USING (product_id) GROUP BY ALL"""
)
SQL["d_dead_stock"] = star(
    """SELECT product_id, CASE WHEN sum(closing_stock) > 0 AND sum(sold_stock) = 0 THEN 'Dead Stock' ELSE 'Active' END
    AS dead_stock_flag FROM fact_inventory GROUP BY ALL"""
)
SQL["d_churn_by_year"] = star(
    """SELECT year, count(*) FILTER (seen < make_date(year, 12, 31) - INTERVAL 180 DAY) AS churn_risk_customers,
    count(*) AS distinct_customers
    FROM (SELECT year(order_date) AS year, customer_id, max(order_date) AS seen FROM fact_sales GROUP BY ALL) GROUP BY ALL"""
)
SQL["d_refunds_by_return_month"] = star(
    f"""SELECT CAST(date_trunc('month', return_date) AS DATE) AS month, {d('sum(refund_amount)')} AS refunds_by_return_date
    FROM fact_returns WHERE {PAID} GROUP BY month"""
)


# -- the same measures in a filter context: a grid of every context and month (or day) from its first sale on

WIDE = """SELECT order_date, sales_amount, profit, category, subcategory, region, segment, sales_channel FROM fact_sales
  JOIN dim_products USING (product_id) JOIN dim_stores USING (store_id) JOIN dim_customers USING (customer_id)"""


class Context:
    def __init__(self, *by: str):
        self.by, self.keys = by, ", ".join(by)
        same = " AND ".join(f"days.{b} = f.{b}" for b in by)
        whole = ", ".join(f"f.{b}" for b in by)
        grid = """SELECT {whole}, CAST(s.t AS DATE) AS {name}, sum(revenue) AS revenue, sum(profit) AS profit, sum(orders) AS orders,
            nullif(count(days.order_date), 0) AS days_sold
          FROM (SELECT {keys}, date_trunc('{unit}', min(order_date)) AS first FROM days GROUP BY ALL) f JOIN
            (SELECT unnest(generate_series((SELECT date_trunc('{unit}', min(order_date)) FROM days),
              (SELECT date_trunc('{unit}', max(order_date)) FROM days), INTERVAL 1 {unit})) AS t) s ON s.t >= f.first
          LEFT JOIN days ON {same} AND date_trunc('{unit}', days.order_date) = s.t GROUP BY ALL"""
        fill = lambda unit, name: grid.format(whole=whole, keys=self.keys, same=same, unit=unit, name=name)
        self.tables = {
            "wide": WIDE,
            "days": f"SELECT {self.keys}, order_date, sum(sales_amount) AS revenue, sum(profit) AS profit, count(*) AS orders FROM wide GROUP BY ALL",
            "months": fill("month", "month"),
            "y": f"SELECT *, sum(revenue) OVER (PARTITION BY {self.keys}, year(month) ORDER BY month) AS ytd FROM months",
        }
        self.each_day = {"wide": WIDE, "days": self.tables["days"], "every": fill("day", "order_date")}

    def over(self, more: str = "", rows: str = "") -> str:
        return f"OVER (PARTITION BY {self.keys}{more} ORDER BY month {rows})"

    def back(self, column: str, n: int) -> str:
        return f"lag({column}, {n}) {self.over()}"

    def last(self, column: str, n: int, what: str = "sum") -> str:
        return f"{what}({column}) {self.over(rows=f'ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW')}"

    def grow(self, column: str, n: int) -> str:
        return r(div(f"({column} - {self.back(column, n)})", self.back(column, n)), 4)

    def time(self, only: str = "") -> str:
        """``only`` is applied to the rows that come out."""
        year, quarter = ", year(month)", ", date_trunc('quarter', month)"
        return star(
            f"""SELECT * EXCLUDE sold FROM (SELECT {self.keys}, month, revenue IS NOT NULL AS sold,
            {d(f'sum(revenue) {self.over()}')} AS running_total_revenue, {d('ytd')} AS revenue_ytd,
            {d(f'sum(revenue) {self.over(quarter)}')} AS revenue_qtd, {d(f'sum(profit) {self.over(year)}')} AS profit_ytd,
            {d(self.last('revenue', 12))} AS rolling_12_month_revenue, {d(self.last('revenue', 3))} AS rolling_3_month_revenue,
            {d(self.back('revenue', 12))} AS prior_year_revenue, {d(self.back('ytd', 12))} AS prior_year_revenue_ytd FROM y) {only}""",
            **self.tables,
        )

    def growth(self) -> str:
        return star(
            f"""SELECT {self.keys}, month, {d('revenue')} AS total_revenue, {d(self.back('revenue', 1))} AS revenue_prior_month,
            {self.grow('revenue', 1)} AS mom_growth, {d(self.back('revenue', 3))} AS revenue_prior_quarter,
            {self.grow('revenue', 3)} AS qoq_growth, {self.grow('revenue', 12)} AS yoy_growth, {self.grow('ytd', 12)} AS yoy_growth_ytd,
            {self.grow('profit', 12)} AS profit_yoy_growth FROM y""",
            **self.tables,
        )

    def moving(self) -> str:
        return star(
            f"""SELECT {self.keys}, month, {d('revenue')} AS total_revenue,
            {r(div(self.last('revenue', 3), self.last('days_sold', 3)))} AS revenue_3_month_moving_avg,
            {r(div(self.last('orders', 3), self.last('days_sold', 3)))} AS orders_3_month_moving_avg,
            {r(div(self.last('revenue', 3), self.last('revenue', 3, 'count')))} AS monthly_3_month_moving_avg FROM months""",
            **self.tables,
        )

    def daily(self) -> str:
        week = f"OVER (PARTITION BY {self.keys} ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
        return star(
            f"""SELECT {self.keys}, order_date, {d('revenue')} AS total_revenue,
            {d(f"sum(revenue) OVER (PARTITION BY {self.keys}, date_trunc('month', order_date) ORDER BY order_date)")} AS revenue_mtd,
            {r(div(f'sum(revenue) {week}', f'count(revenue) {week}'))} AS revenue_7_day_moving_avg FROM every""",
            **self.each_day,
        )

    def quarters(self) -> str:
        now, before = "a.q", "b.q"
        same = " AND ".join(f"a.{k} = b.{k}" for k in self.by)
        return star(
            f"""SELECT {', '.join(f'a.{k}' for k in self.by)}, a.quarter, {d(now)} AS total_revenue, {d(before)} AS revenue_prior_quarter,
            {r(div(f'({now} - {before})', before), 4)} AS qoq_growth
            FROM sums a LEFT JOIN sums b ON {same} AND CAST(b.quarter + INTERVAL 3 MONTH AS DATE) = a.quarter""",
            wide=WIDE,
            sums=f"SELECT {self.keys}, CAST(date_trunc('quarter', order_date) AS DATE) AS quarter, sum(sales_amount) AS q FROM wide GROUP BY ALL",
        )

    def flags(self) -> str:
        return star(
            f"""SELECT {self.keys}, month, CASE WHEN margin >= 0.2 THEN 'Healthy' WHEN margin >= 0.1 THEN 'Watch' ELSE 'At Risk' END AS margin_health_flag,
            CASE WHEN mom > 0.02 THEN '▲' WHEN mom < -0.02 THEN '▼' ELSE '▬' END AS growth_trend_icon,
            CASE WHEN coalesce({d('revenue')}, 0) >= coalesce(usual, 0) THEN 'Above Trend' ELSE 'Below Trend' END AS above_or_below_trailing_average
            FROM (SELECT *, {div('profit', 'revenue')} AS margin,
              {div(f"(revenue - {self.back('revenue', 1)})", self.back('revenue', 1))} AS mom,
              {div(self.last('revenue', 3), self.last('days_sold', 3))} AS usual FROM months)""",
            **self.tables,
        )


for own, context in (("region", Context("region")), ("category_channel", Context("category", "sales_channel"))):
    SQL[f"d_time_{own}"] = context.time()
    SQL[f"d_growth_{own}"] = context.growth()
    SQL[f"d_moving_avg_{own}"] = context.moving()
    SQL[f"d_daily_{own}"] = context.daily()
    SQL[f"d_growth_quarter_{own}"] = context.quarters()
    SQL[f"d_flags_{own}"] = context.flags()
sparse = Context("subcategory", "segment", "region")
SQL["d_time_subcategory_segment"] = sparse.time()
SQL["d_time_subcategory_segment_sold"] = sparse.time("WHERE sold")
