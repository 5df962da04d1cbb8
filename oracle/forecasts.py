"""Oracle SQL of the monthly panel, the moving average and its errors."""

from __future__ import annotations

from oracle.arima import plain, seasonal
from oracle.base import r, star
from oracle.statistics import PANEL

SQL: dict[str, str] = {}
SQL["e0_series"] = star(f"SELECT series, month, {r('panel.revenue')} AS revenue FROM panel", **PANEL)


def recursive(train: str) -> dict[str, str]:
    """Mean of the last three values per series, fed back for twelve months."""
    return {
        **PANEL,
        "train": train,
        "tails": """SELECT series, max(month) AS final, list(revenue ORDER BY month DESC)[1:3] AS v FROM train GROUP BY series""",
        "ma": """SELECT series, final, 0 AS k, CAST(NULL AS DOUBLE) AS f, v[3] AS x, v[2] AS y, v[1] AS z FROM tails
          UNION ALL SELECT series, final, k + 1, (x + y + z) / 3, y, z, (x + y + z) / 3 FROM ma WHERE k < 12""",
        "ahead": "SELECT series, CAST(final + to_months(k) AS DATE) AS month, f FROM ma WHERE k > 0",
    }


SQL["e2_moving_average"] = star(
    f"SELECT series, month, {r('f')} AS forecast FROM ahead", **recursive("SELECT * FROM panel")
)
HELD = "SELECT * FROM panel WHERE month <= DATE '2000-07-01'"
SQL["e1_metrics"] = star(
    f"""SELECT series, {r('sqrt(avg(pow(revenue - f, 2)))')} AS rmse, {r('avg(abs(revenue - f))')} AS mae,
    {r('100 * avg(abs((revenue - f) / revenue))', 4)} AS mape
    FROM ahead JOIN panel USING (series, month) GROUP BY series""",
    **recursive(HELD),
)


def _sum(first: int) -> str:
    return "(" + " + ".join(f"v[{k}]" for k in range(first, first + 12)) + ") / 12"


def zoomed(n: str) -> dict[str, str]:
    """``{n}_best``: the smoothing state of each series by five rounds of grids, each around the best weights of the one before."""
    out = {
        f"{n}_s0": f"""SELECT series, final, n, v, m + rise * 5.5 AS level, rise AS slope,
            list_transform(v[1:12], lambda x, i: x - (m + rise * (i - 6.5))) AS season
          FROM (SELECT *, {_sum(1)} AS m, ({_sum(13)} - {_sum(1)}) / 12 AS rise FROM {n}_l WHERE n >= 24)""",
        f"{n}_w0": f"SELECT series, 0.5::DOUBLE AS a, 0.5::DOUBLE AS b, 0.5::DOUBLE AS g FROM {n}_s0",
    }
    for k, (points, width) in enumerate(((7, "0.5"), (5, "1.0::DOUBLE / 6"), (5, "1.0::DOUBLE / 12"), (5, "1.0::DOUBLE / 24"), (5, "1.0::DOUBLE / 48")), 1):
        low = {w: f"greatest(0.0::DOUBLE, {w} - {width})" for w in "abg"}
        axis = {w: f"{low[w]} + (least(1.0::DOUBLE, {w} + {width}) - {low[w]}) * {w}i / {points - 1}" for w in "abg"}
        steps = ", ".join(f"(SELECT unnest(range({points}))::DOUBLE AS {w}i)" for w in "abg")
        out |= {
            f"{n}_g{k}": f"SELECT series, {', '.join(f'{axis[w]} AS {w}' for w in 'abg')} FROM {n}_w{k - 1}, {steps}",
            f"{n}_hw{k}": f"""SELECT series, final, n, v, a, b, g, CAST(12 AS BIGINT) AS k, level, slope, season, CAST(0 AS DOUBLE) AS sse
              FROM {n}_s0 JOIN {n}_g{k} USING (series)
              UNION ALL SELECT series, final, n, v, a, b, g, k + 1, up, b * (up - level) + (1 - b) * slope,
                list_append(season[2:12], g * (y - up) + (1 - g) * s), sse + e * e
              FROM (SELECT *, a * (y - s) + (1 - a) * (level + slope) AS up, y - (level + slope + s) AS e
                    FROM (SELECT *, v[k + 1] AS y, season[1] AS s FROM {n}_hw{k} WHERE k < n))""",
            f"{n}_w{k}": f"SELECT * FROM {n}_hw{k} WHERE k = n QUALIFY row_number() OVER (PARTITION BY series ORDER BY sse, a, b, g) = 1",
        }
    return out | {f"{n}_best": f"SELECT * FROM {n}_w5"}


def models(name: str, train: str) -> dict[str, str]:
    """Forecasts of all five models over the table of a training statement, as ``{name}_all``; names carry a prefix so that
    one statement can fit two histories."""
    n = name
    return {
        f"{n}_train": train,
        f"{n}_l": f"""SELECT series, list(revenue ORDER BY month) AS v, count(*) AS n, max(month) AS final, min(revenue) AS least
          FROM {n}_train GROUP BY series""",
        f"{n}_ma": f"""SELECT series, final, 0 AS k, CAST(NULL AS DOUBLE) AS f, v[-least(n, 3):] AS w FROM {n}_l
          UNION ALL SELECT series, final, k + 1, list_sum(w) / len(w), list_append(w, list_sum(w) / len(w))[-3:] FROM {n}_ma WHERE k < 12""",
        **zoomed(n),
        f"{n}_z": f"""SELECT *, avg(t) OVER (PARTITION BY series, p) AS tm, avg(z) OVER (PARTITION BY series, p) AS zm FROM
          (SELECT t.series, final, n, month(month) AS p, CAST(row_number() OVER (PARTITION BY t.series ORDER BY month) - 1 AS DOUBLE) AS t,
           ln(1 + revenue) AS z FROM {n}_train t JOIN {n}_l USING (series) WHERE n >= 24 AND least > -1)""",
        f"{n}_slope": f"SELECT series, sum((t - tm) * (z - zm)) / sum((t - tm) * (t - tm)) AS slope FROM {n}_z GROUP BY series",
        f"{n}_fit": f"SELECT *, zm - slope * tm AS lv FROM {n}_z JOIN {n}_slope USING (series)",
        f"{n}_s": f"""SELECT series, final, n, slope, 1.96 * sqrt(sum((z - lv - slope * t) ** 2) / (max(n) - 13)) AS spread
          FROM {n}_fit GROUP BY series, final, n, slope""",
        f"{n}_h": "SELECT unnest(range(1, 13)) AS h",
        **plain(f"{n}_arima"),
        **seasonal(f"{n}_sarima"),
        f"{n}_all": f"""SELECT series, CAST(final + to_months(CAST(k AS INT)) AS DATE) AS month, 'Moving Average' AS model, f, f AS low, f AS high
            FROM {n}_ma WHERE k > 0
          UNION ALL SELECT series, month, 'ARIMA', f, low, high FROM {n}_arima_out
          UNION ALL SELECT series, month, 'SARIMA', f, low, high FROM {n}_sarima_out
          UNION ALL SELECT series, CAST(final + to_months(CAST(h AS INT)) AS DATE), 'Exponential Smoothing', f, f - w, f + w FROM
            (SELECT *, level + h * slope + season[(h - 1) % 12 + 1] AS f, 1.96 * sqrt(sse / (n - 12)) AS w FROM {n}_best, {n}_h)
          UNION ALL SELECT series, month, 'Log-Linear Trend and Season', exp(z) - 1, exp(z - spread) - 1, exp(z + spread) - 1 FROM
            (SELECT m.*, lv + slope * (n - 1 + h) AS z FROM (SELECT *, CAST(final + to_months(CAST(h AS INT)) AS DATE) AS month FROM {n}_s, {n}_h) m
             JOIN (SELECT DISTINCT series, p, max(lv) OVER (PARTITION BY series, p) AS lv FROM {n}_fit) q ON q.series = m.series AND p = month(month))""",
    }


def outlook(history: str) -> dict[str, str]:
    """Scorecard and outlook of a history (a table of series, month, revenue)."""
    held = f"SELECT series, month, revenue FROM {history} QUALIFY row_number() OVER (PARTITION BY series ORDER BY month DESC)"
    return {
        **models("t", f"{held} > 12"),
        **models("w", f"SELECT series, month, revenue FROM {history}"),
        "kept": f"{held} <= 12",
        "errors": """SELECT series, model, sqrt(avg((revenue - f) * (revenue - f))) AS rmse, avg(abs(revenue - f)) AS mae,
          CASE WHEN count(*) FILTER (revenue = 0) = 0 THEN 100 * avg(abs((revenue - f) / revenue)) END AS mape
          FROM t_all JOIN kept USING (series, month) GROUP BY ALL""",
        "score": f"""SELECT *, row_number() OVER (PARTITION BY series ORDER BY mape NULLS LAST, rmse NULLS LAST,
            model <> 'Moving Average', model) = 1 AS chosen,
          CASE WHEN n <= 12 THEN 'too short for a holdout' WHEN rmse IS NOT NULL THEN NULL
            WHEN n - 12 < 24 THEN 'fewer than 24 months' WHEN model = 'SARIMA' AND n - 12 < 36 THEN 'fewer than 36 months'
            ELSE 'needs revenue above -1' END AS reason
          FROM (SELECT series, count(*) AS n FROM {history} GROUP BY ALL) CROSS JOIN
          (SELECT unnest(['Moving Average', 'Exponential Smoothing', 'ARIMA', 'SARIMA', 'Log-Linear Trend and Season']) AS model) LEFT JOIN errors USING (series, model)""",
        "ahead": """SELECT w_all.series, model, month, f, low, high, reason FROM w_all JOIN score USING (series, model) WHERE chosen""",
    }


FIT = models("w", "SELECT series, month, revenue FROM panel")
for name, model in (("e3_holt_winters", "Exponential Smoothing"), ("e4_arima", "ARIMA"), ("e5_sarima", "SARIMA"), ("e6_trend_and_season", "Log-Linear Trend and Season")):
    SQL[name] = star(
        f"SELECT series, month, {r('f')} AS forecast, {r('low')} AS lower, {r('high')} AS upper FROM w_all WHERE model = '{model}'", **PANEL, **FIT
    )
ALL = outlook("panel")
SQL["e7_scorecard"] = star(
    f"SELECT series, model, {r('rmse')} AS rmse, {r('mae')} AS mae, {r('mape', 4)} AS mape, chosen, reason FROM score", **PANEL, **ALL
)
SQL["e8_outlook"] = star(
    f"SELECT series, model, month, {r('f')} AS forecast, {r('low')} AS lower, {r('high')} AS upper, reason FROM ahead", **PANEL, **ALL
)
NONE = "CAST(NULL AS DOUBLE)"
SQL["b6_outlook"] = star(
    f"""SELECT series, month, {r('panel.revenue')} AS total_revenue, {NONE} AS forecast, {NONE} AS lower, {NONE} AS upper FROM panel
    UNION ALL SELECT series, month, NULL, {r('f')}, {r('low')}, {r('high')} FROM ahead""",
    **PANEL,
    **ALL,
)
UNTIL = {**PANEL, "seen": "SELECT * FROM panel WHERE series = 'total' AND month <= DATE '2000-07-01'", **outlook("seen")}
SQL["s10_forecast_csv"] = star(
    f"""SELECT month AS "Month", {r('f')} AS "Forecasted_Revenue", {r('low')} AS "Lower_95CI", {r('high')} AS "Upper_95CI" FROM ahead""", **UNTIL
)
PLANNED = "SELECT month, CAST({} AS DOUBLE) AS f, CAST({} AS DOUBLE) AS low, CAST({} AS DOUBLE) AS high FROM ahead".format(r("f"), r("low"), r("high"))
SQL["d_forecast_compare"] = SQL["b1_forecast"] = star(
    f"""SELECT month, {r('f')} AS forecasted_revenue, {r('low')} AS forecast_lower_bound, {r('high')} AS forecast_upper_bound,
    {r('a - f')} AS actual_vs_forecast_variance, {r('(a - f) / f', 4)} AS actual_vs_forecast_variance_pct,
    CASE WHEN a >= low AND a <= high THEN 'Within Range' ELSE 'Outside Range' END AS is_actuals_within_forecast_ci
    FROM (SELECT planned.*, coalesce(CAST(v AS DOUBLE), 0) AS a FROM planned LEFT JOIN
      (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(sales_amount) AS v FROM fact_sales GROUP BY ALL) USING (month))""",
    **UNTIL,
    planned=PLANNED,
)
