"""Oracle SQL of the statistical analyses. Tail probabilities are integrated numerically from the density."""

from __future__ import annotations

import itertools

from oracle.base import d, div, pct, r, star

SQL: dict[str, str] = {}

WIDE = """SELECT fact_sales.*, category, cost_price, segment, income, age
  FROM fact_sales LEFT JOIN dim_products USING (product_id) LEFT JOIN dim_customers USING (customer_id)"""
SQL["m0_features"] = star(
    f"""SELECT category, segment, count(*) AS orders, count(*) FILTER (income IS NULL) AS missing_income,
    {r(div('sum(income)', 'count(income)'))} AS avg_income, {r(div('sum(age)', 'count(age)'))} AS avg_age,
    {r(div('sum(cost_price)', 'count(cost_price)'))} AS avg_cost, {d('sum(profit)')} AS profit FROM wide GROUP BY ALL""",
    wide=WIDE,
)


def t_tail(t: str, df: str) -> str:
    """Two-sided p: one minus twice the t density integrated from 0 to |t| by Simpson's rule."""
    n = 4000
    return f"""(CASE WHEN abs({t}) > 40 THEN 0 ELSE 1 END) * greatest(0.0, 1 - 2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi()) * abs({t}) / {n} / 3 *
      (SELECT sum(CASE WHEN g IN (0, {n}) THEN 1 WHEN g % 2 = 1 THEN 4 ELSE 2 END
         * pow(1 + pow(abs({t}) * g / {n}, 2) / {df}, -({df} + 1) / 2)) FROM range({n + 1}) s(g)))"""


def f_tail(f: str, a: str, b: str) -> str:
    """Upper p of F: the density in u = sqrt(x), which is smooth at 0, integrated by Simpson's rule."""
    n = 4000
    top = f"sqrt({f})"
    u = f"({top} * g / {n})"
    return f"""greatest(0.0, 1 - exp(lgamma(({a} + {b}) / 2) - lgamma({a} / 2) - lgamma({b} / 2) + {a} / 2 * ln({a} / {b})) * {top} / {n} / 3 *
      (SELECT sum(CASE WHEN g IN (0, {n}) THEN 1 WHEN g % 2 = 1 THEN 4 ELSE 2 END
         * 2 * pow({u}, {a} - 1) * pow(1 + {a} * {u} * {u} / {b}, -({a} + {b}) / 2)) FROM range({n + 1}) s(g)))"""


NAMES = ("quantity", "discount", "sales_amount", "profit", "income", "age")
SQL["m1_correlations"] = star(
    f"""SELECT x, y, n, {r('c', 6)} AS r, {r('t', 3)} AS t, {r(t_tail('t', '(n - 2.0::DOUBLE)'), 5)} AS p,
    CASE WHEN abs(c) < 0.3 THEN 'weak' WHEN abs(c) < 0.6 THEN 'moderate' ELSE 'strong' END AS strength
    FROM (SELECT *, c * sqrt((n - 2) / (1 - c * c)) AS t FROM pairs)""",
    wide=WIDE,
    pairs=" UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, count(*) AS n, corr({d(a)}, {d(b)}) AS c FROM wide WHERE income IS NOT NULL"
        for a, b in itertools.combinations(NAMES, 2)
    ),
)
# normal equations of three inputs in centred form, inverted by cofactors
COV = ", ".join(
    f"covar_samp({a}, {b}) * (count(*) - 1) AS {k}"
    for k, a, b in (
        ("aa", "a", "a"), ("ab", "a", "b"), ("ac", "a", "c"), ("bb", "b", "b"), ("bc", "b", "c"), ("cc", "c", "c"),
        ("ay", "a", "y"), ("by_", "b", "y"), ("cy", "c", "y"), ("yy", "y", "y"),
    )
)
SQL["m2_regression"] = star(
    f"""SELECT term, {r('coef', 4)} AS coefficient, {r('se', 4)} AS std_error, {r('coef / se', 2)} AS t,
    {r(t_tail('(coef / se)', 'df'), 5)} AS p, {r('r2', 6)} AS r_squared FROM terms""",
    v="SELECT CAST(quantity AS DOUBLE) AS a, CAST(discount AS DOUBLE) AS b, CAST(sales_amount AS DOUBLE) AS c, CAST(profit AS DOUBLE) AS y FROM fact_sales",
    m=f"SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, {COV} FROM v",
    inv="""SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det,
      bb * cc - bc * bc AS iaa, ac * bc - ab * cc AS iab, ab * bc - ac * bb AS iac,
      aa * cc - ac * ac AS ibb, ab * ac - aa * bc AS ibc, aa * bb - ab * ab AS icc FROM m""",
    beta="""SELECT *, (iaa * ay + iab * by_ + iac * cy) / det AS ba, (iab * ay + ibb * by_ + ibc * cy) / det AS bb_,
      (iac * ay + ibc * by_ + icc * cy) / det AS bc_ FROM inv""",
    fit="""SELECT *, yy - ba * ay - bb_ * by_ - bc_ * cy AS rss, my - ba * ma - bb_ * mb - bc_ * mc AS b0 FROM beta""",
    terms="""SELECT 'quantity' AS term, ba AS coef, sqrt(rss / (n - 4) * iaa / det) AS se, 1 - rss / yy AS r2,
        CAST(n - 4 AS DOUBLE) AS df FROM fit
      UNION ALL SELECT 'discount', bb_, sqrt(rss / (n - 4) * ibb / det), 1 - rss / yy, n - 4 FROM fit
      UNION ALL SELECT 'sales_amount', bc_, sqrt(rss / (n - 4) * icc / det), 1 - rss / yy, n - 4 FROM fit
      UNION ALL SELECT 'intercept', b0, sqrt(rss / (n - 4) * (1.0 / n + (ma * ma * iaa + mb * mb * ibb + mc * mc * icc
        + 2 * ma * mb * iab + 2 * ma * mc * iac + 2 * mb * mc * ibc) / det)), 1 - rss / yy, n - 4 FROM fit""",
)
SQL["m3_channel_test"] = star(
    f"""SELECT {r('m1')} AS online_mean, {r('m2')} AS offline_mean, {r('t', 5)} AS t, {r('df', 2)} AS df,
    {r(t_tail('t', 'df'), 5)} AS p
    FROM (SELECT m1, m2, (m1 - m2) / sqrt(v1 + v2) AS t, pow(v1 + v2, 2) / (v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1)) AS df
          FROM (SELECT {d('avg(x) FILTER (o)')} AS m1, {d('avg(x) FILTER (NOT o)')} AS m2,
            var_samp(x) FILTER (o) / count(*) FILTER (o) AS v1, var_samp(x) FILTER (NOT o) / count(*) FILTER (NOT o) AS v2,
            count(*) FILTER (o) AS n1, count(*) FILTER (NOT o) AS n2
            FROM (SELECT CAST(sales_amount AS DOUBLE) AS x, sales_channel = 'Online' AS o FROM fact_sales)))"""
)
# t quantile from the normal quantile by the Cornish-Fisher series, exact to many digits for large samples
Z = "1.959963984540054"
TQ = f"({Z} + (pow({Z}, 3) + {Z}) / (4 * (n - 1)) + (5 * pow({Z}, 5) + 16 * pow({Z}, 3) + 3 * {Z}) / (96 * pow(n - 1, 2)))"
SQL["m4_mean_interval"] = star(
    f"""SELECT n, {r('m')} AS mean, {r('e', 4)} AS std_error, {r(f'm - e * {TQ}')} AS lower, {r(f'm + e * {TQ}')} AS upper
    FROM (SELECT count(*) AS n, {div('sum(sales_amount)', 'count(*)')} AS m,
      stddev_samp(CAST(sales_amount AS DOUBLE)) / sqrt(count(*)) AS e FROM fact_sales)"""
)
SQL["m5_segment_anova"] = star(
    f"""SELECT segment, n AS orders, {r('m')} AS mean_order_value, {r('f', 4)} AS f,
    {r(f_tail('f', '(k - 1.0::DOUBLE)', '(total - k + 0.0::DOUBLE)'), 5)} AS p FROM g,
    (SELECT count(*) AS k, sum(n) AS total,
      (sum(n * pow(m - (SELECT avg(CAST(sales_amount AS DOUBLE)) FROM wide), 2)) / (count(*) - 1))
       / (sum(v * (n - 1)) / (sum(n) - count(*))) AS f FROM g)""",
    wide=WIDE,
    g="""SELECT segment, count(*) AS n, avg(CAST(sales_amount AS DOUBLE)) AS m, var_samp(CAST(sales_amount AS DOUBLE)) AS v
      FROM wide GROUP BY ALL""",
)
SQL["m6_rfm_features"] = star(
    f"""SELECT customer_id, date_diff('day', max(order_date), (SELECT max(order_date) FROM fact_sales)) AS recency,
    count(*) AS frequency, {d('sum(sales_amount)')} AS monetary FROM fact_sales GROUP BY ALL"""
)
LIMITS = """SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high, m, s, n
  FROM (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, avg(x) AS m, stddev_pop(x) AS s, count(*) AS n
        FROM (SELECT CAST(sales_amount AS DOUBLE) AS x FROM fact_sales))"""
MARKED = """SELECT order_id, CAST(sales_amount AS DOUBLE) AS sales_amount,
  CAST(sales_amount AS DOUBLE) NOT BETWEEN low AND high AS iqr_outlier,
  abs(CAST(sales_amount AS DOUBLE) - m) > 3 * s AS z_outlier FROM fact_sales, limits"""
SQL["m7_outliers"] = star("SELECT * FROM marked WHERE iqr_outlier OR z_outlier", limits=LIMITS, marked=MARKED)
SQL["m7_outliers_tight"] = star(
    "SELECT * FROM marked WHERE iqr_outlier OR z_outlier", limits=LIMITS.replace("1.5 *", "0.4 *"), marked=MARKED.replace("> 3 * s", "> 1.75 * s")
)
SQL["m7_outlier_summary"] = star(
    f"""SELECT 'iqr' AS method, {r('low')} AS lower, {r('high')} AS upper, hits AS outliers, {pct('hits', 'n')} AS share_pct
    FROM limits, (SELECT count(*) FILTER (iqr_outlier) AS hits FROM marked)
    UNION ALL SELECT 'z_score', {r('m - 3 * s')}, {r('m + 3 * s')}, hits, {pct('hits', 'n')}
    FROM limits, (SELECT count(*) FILTER (z_outlier) AS hits FROM marked)""",
    limits=LIMITS,
    marked=MARKED,
)
SUMS = """SELECT 'total' AS series, CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(sales_amount) AS DOUBLE) AS revenue
    FROM fact_sales WHERE order_date < DATE '2001-08-01' GROUP BY ALL
  UNION ALL SELECT category, CAST(date_trunc('month', order_date) AS DATE), CAST(sum(sales_amount) AS DOUBLE)
    FROM fact_sales JOIN dim_products USING (product_id) WHERE order_date < DATE '2001-08-01' GROUP BY ALL"""
SERIES = """SELECT s.series, CAST(s.m AS DATE) AS month, coalesce(revenue, 0) AS revenue FROM
    (SELECT series, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS m FROM sums GROUP BY series) s
  LEFT JOIN sums ON sums.series = s.series AND sums.month = s.m"""
PANEL = {"sums": SUMS, "panel": SERIES}
SQL["m9_trend"] = star(
    f"""SELECT series, n AS months, {r('slope')} AS slope, {r('base')} AS intercept, {r('r2', 5)} AS r_squared,
    {r(t_tail('sqrt(r2 * (n - 2) / (1 - r2))', '(n - 2.0::DOUBLE)'), 5)} AS p,
    CASE WHEN slope > 0 THEN 'upward' ELSE 'downward' END AS direction
    FROM (SELECT series, count(*) AS n, regr_slope(revenue, t) AS slope, regr_intercept(revenue, t) AS base, regr_r2(revenue, t) AS r2
          FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month) - 1 AS t FROM panel) GROUP BY series)""",
    **PANEL,
)
PARTS = {
    **PANEL,
    "smooth": """SELECT *, (row_number() OVER w - 1) % 12 AS spot, CASE WHEN count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
        THEN (lag(revenue, 6) OVER w / 2 + lead(revenue, 6) OVER w / 2
          + sum(revenue) OVER (w ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) / 12 END AS trend
      FROM panel WINDOW w AS (PARTITION BY series ORDER BY month)""",
    "levels": "SELECT series, spot, avg(revenue - trend) AS lv FROM smooth GROUP BY ALL",
    "parts": """SELECT series, month, revenue AS observed, trend, lv - ml AS seasonal, revenue - trend - (lv - ml) AS resid
      FROM smooth JOIN levels USING (series, spot) JOIN (SELECT series, avg(lv) AS ml FROM levels GROUP BY ALL) USING (series)""",
}
SQL["m10_decomposition"] = star(
    f"""SELECT series, month, {r('parts.observed')} AS observed, {r('parts.trend')} AS trend, {r('parts.seasonal')} AS seasonal,
    {r('parts.resid')} AS resid FROM parts""",
    **PARTS,
)
SQL["m10_seasonality"] = star(
    f"""SELECT series, {r('1 - var_samp(resid) / var_samp(seasonal + resid)', 4)} AS seasonal_strength,
    {r('min(seasonal)')} AS seasonal_low, {r('max(seasonal)')} AS seasonal_high,
    arg_max(month(month), seasonal) AS peak_month, arg_min(month(month), seasonal) AS trough_month
    FROM parts GROUP BY series""",
    **PARTS,
)

SQL["m11_price_elasticity"] = star(
    f"""SELECT category, count(*) AS product_months, {r('regr_slope(y, x)', 4)} AS elasticity, {r('regr_r2(y, x)', 5)} AS r_squared
    FROM (SELECT category, ln(CAST(u AS DOUBLE)) AS y, ln(CAST(v AS DOUBLE) / CAST(u AS DOUBLE)) AS x
          FROM (SELECT product_id, date_trunc('month', order_date) AS m, sum(quantity) AS u, sum(sales_amount) AS v FROM fact_sales GROUP BY ALL)
          JOIN dim_products USING (product_id) WHERE u > 0 AND v > 0) GROUP BY category"""
)
