"""ARIMA and SARIMA forecasts of many series by two-stage least squares (E4, E5), in DataFrame expressions alone.

Stage 1 regresses the differenced series on its own lags and keeps the residuals; stage 2 regresses it on its lags and on
lagged residuals (0 before the first one). Both come from sums of products per series, so a stage costs one grouping and
windows that share its partitioning; the small normal equations are solved by elimination as a fold over an array. Lag
polynomials are multiplied out with the differencing, so forecasts invert it exactly, and the same polynomials give the
psi weights by which the 95 % bands widen.

``order`` (2, 1, 2) fits two lags of each kind by one regression. The seasonal model (1, 1, 1)(1, 1, 1, 12) has products of its
weights at lag 13: the regular and the seasonal pair are fitted in turn, each exactly given the other, from one matrix of
sums. Autoregressive weights are drawn into the stationary region, which keeps forecasts finite. A regressor that the ones
before it explain gets no weight, so constant series and lines are forecast too. A series needs 24 (seasonal: 36) months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEASON = 12
Z95 = 1.96  # fixed value: normal quantile of the published bands
LONG_LAGS = (1, 2, 3, 4, 5)  # stage 1 of the plain model
SEASONAL_LAGS = (1, 2, 12, 13)  # and of the seasonal one
TURNS = 30  # fits of each pair of the seasonal model
EXPLAINED = 1e-9  # share of a regressor's own sum of squares that counts as nothing left
EDGE = 0.99  # autoregressive weights stay within this
Polynomial = dict[int, Column]


def solved(matrix: Column, n: int) -> Column:
    """The solution of n normal equations given as rows of n + 1 entries, right side last; null rows count as 0."""
    original = F.transform(matrix, lambda row, i: F.get(row, i))

    def step(rows: Column, i: Column) -> Column:
        pivot = F.get(F.get(rows, i), i)
        left = pivot > EXPLAINED * F.get(original, i)
        own = F.transform(F.get(rows, i), lambda x: F.when(left, x / pivot).otherwise(0.0))
        return F.transform(rows, lambda row, j: F.when(j == i, own).otherwise(F.zip_with(row, own, lambda x, y: x - F.get(row, i) * y)))

    return F.transform(F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), matrix, step), lambda row: F.get(row, F.lit(n)))


def sums_of_products(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)).alias(f"{a}_{b}") for k, a in enumerate(names) for b in names[k:]]


def equations(regressors: Sequence[str], target: str) -> Column:
    """Normal equations from the sums of products."""
    order = [target, *regressors]
    entry = lambda a, b: F.col(f"{a}_{b}" if order.index(a) <= order.index(b) else f"{b}_{a}")
    return F.array(*(F.array(*(entry(a, b) for b in [*regressors, target])) for a in regressors))


def along(name: str, lags: Sequence[int], prefix: str) -> list[Column]:
    by_time = Window.partitionBy("series").orderBy("t")
    return [F.lag(name, k).over(by_time).alias(f"{prefix}{k}") for k in lags]


def differenced(series: DataFrame, least: int, seasonal: bool) -> DataFrame:
    """series, month, revenue, t from 1, n and w, the differenced value, of series of ``least`` months or more."""
    by_time, whole = Window.partitionBy("series").orderBy("month"), Window.partitionBy("series")
    rows = series.withColumn("t", F.row_number().over(by_time)).withColumn("n", F.count("*").over(whole)).where(F.col("n") >= least)
    change = F.col("revenue") - F.lag("revenue", 1).over(by_time)
    if seasonal:
        change = change - F.lag("revenue", SEASON).over(by_time) + F.lag("revenue", SEASON + 1).over(by_time)
    return rows.withColumn("w", change)


def first_stage(rows: DataFrame, lags: Sequence[int]) -> DataFrame:
    """The rows with e, the residual of the long autoregression (0 where its lags don't reach), and ``full``."""
    names = [f"l{k}" for k in lags]
    laid = rows.select("*", *along("w", lags, "l"))
    sums = laid.where(F.col(f"l{max(lags)}").isNotNull()).groupBy("series").agg(*sums_of_products(["w", *names]))
    fit = sums.select("series", solved(equations(names, "w"), len(names)).alias("long"))
    said = sum((F.get("long", F.lit(k)) * F.col(name) for k, name in enumerate(names)), F.lit(0.0))
    full = F.col(f"l{max(lags)}").isNotNull()
    out = laid.join(fit, "series").withColumn("full", full).withColumn("e", F.when(full, F.col("w") - said).otherwise(0.0))
    return out.select(*rows.columns, "e", "full")


def multiplied(*factors: Polynomial) -> Polynomial:
    out: Polynomial = {0: F.lit(1.0)}
    for factor in factors:
        product: Polynomial = {}
        for i, x in out.items():
            for j, y in factor.items():
                term = y if i == 0 else x if j == 0 else x * y
                product[i + j] = product[i + j] + term if i + j in product else term
        out = product
    return out


def weights(polynomial: Polynomial, sign: int) -> Column:
    """Lags 1 to the last one as an array."""
    return F.array(*(F.lit(float(sign)) * polynomial[k] if k in polynomial else F.lit(0.0) for k in range(1, max(polynomial) + 1)))


def continued(fitted: DataFrame, horizon: int) -> DataFrame:
    """Forecasts and bands of rows with final, ar and ma (weights from lag 1 on), y and e (latest first) and sigma2."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    shifted = lambda x, values: F.concat(F.array(x), F.slice(values, F.lit(1), F.size(values) - 1))

    def forward(s: Column, _: Column) -> Column:
        f = dot(F.col("ar"), s["y"]) + dot(F.col("ma"), s["e"])
        return F.struct(shifted(f, s["y"]).alias("y"), shifted(F.lit(0.0), s["e"]).alias("e"), F.concat(s["out"], F.array(f)).alias("out"))

    def widen(s: Column, h: Column) -> Column:
        psi = dot(F.col("ar"), s["psi"]) + F.coalesce(F.get("ma", h - 1), F.lit(0.0))
        total = s["total"] + F.get(s["psi"], F.lit(0)) * F.get(s["psi"], F.lit(0))
        return F.struct(shifted(psi, s["psi"]).alias("psi"), total.alias("total"), F.concat(s["out"], F.array(total)).alias("out"))

    nothing = F.array().cast("array<double>")
    ahead = F.aggregate(steps, F.struct(F.col("y").alias("y"), F.col("e").alias("e"), nothing.alias("out")), forward)["out"]
    start = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), F.size("ar") - 1))
    spread = F.aggregate(steps, F.struct(start.alias("psi"), F.lit(0.0).alias("total"), nothing.alias("out")), widen)["out"]
    out = fitted.select("series", "final", "sigma2", ahead.alias("ahead"), spread.alias("spread"))
    out = out.select("series", "final", "sigma2", F.posexplode(F.arrays_zip("ahead", "spread")).alias("k", "x"))
    width = Z95 * F.sqrt(F.col("sigma2") * F.col("x.spread"))
    forecast = F.col("x.ahead")
    month = F.add_months("final", F.col("k") + 1)
    return out.select("series", month.alias("month"), forecast.alias("forecast"), (forecast - width).alias("lower"), (forecast + width).alias("upper"))


def latest(rows: DataFrame, values: int, errors: int) -> DataFrame:
    """final month, the last values and the last residuals of each series, latest first."""
    back = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("t")))
    ends = rows.withColumn("back", back).where(F.col("back") <= max(values, errors))
    listed = lambda name, n: F.transform(F.array_sort(F.collect_list(F.when(F.col("back") <= n, F.struct("back", name)))), lambda x: x[name])
    return ends.groupBy("series").agg(F.max("month").alias("final"), listed("revenue", values).alias("y"), listed("e", errors).alias("e"))


def within(x: Column) -> Column:
    return F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), x))


def arima(series: DataFrame, horizon: int = 12) -> DataFrame:
    """Order (2, 1, 2) with 95 % bands."""
    rows = first_stage(differenced(series, 2 * SEASON, False), LONG_LAGS)
    laid = rows.select("*", *along("w", (1, 2), "l"), *along("e", (1, 2), "e")).where("full")
    names = ["l1", "l2", "e1", "e2"]
    sums = laid.groupBy("series").agg(*sums_of_products(["w", *names]))
    fit = sums.select("series", solved(equations(names, "w"), 4).alias("c"))
    c = [F.get("c", F.lit(k)) for k in range(4)]
    fit = fit.select("series", within(c[1]).alias("p2"), c[0].alias("raw"), c[2].alias("q1"), c[3].alias("q2"))
    fit = fit.withColumn("p1", within(F.col("raw") / (1 - F.col("p2"))) * (1 - F.col("p2")))
    said = sum((F.col(a) * F.col(b) for a, b in zip(("p1", "p2", "q1", "q2"), names, strict=True)), F.lit(0.0))
    miss = F.col("w") - said
    spread = laid.join(fit, "series").groupBy("series").agg((F.sum(miss * miss) / (F.count("*") - 4)).alias("sigma2"))
    ar = multiplied({0: F.lit(1.0), 1: -F.col("p1"), 2: -F.col("p2")}, {0: F.lit(1.0), 1: F.lit(-1.0)})
    fitted = fit.select("series", weights(ar, -1).alias("ar"), F.array("q1", "q2").alias("ma"))
    return continued(fitted.join(spread, "series").join(latest(rows, 3, 2), "series"), horizon)


def quadratic(p: Polynomial, q: Polynomial, names: Sequence[str]) -> Column:
    """The sum of products of two combinations of the named columns."""
    entry = lambda i, j: F.col(f"{names[min(i, j)]}_{names[max(i, j)]}")
    return sum((x * y * entry(i, j) for i, x in p.items() for j, y in q.items()), F.lit(0.0))


def pair(target: Polynomial, one: Polynomial, two: Polynomial, names: Sequence[str]) -> tuple[Column, Column]:
    """Least squares of one combination on two others."""
    a, b, c = quadratic(one, one, names), quadratic(one, two, names), quadratic(two, two, names)
    x, y = quadratic(one, target, names), quadratic(two, target, names)
    rest = c - F.coalesce(F.try_divide(b * b, a), F.lit(0.0))
    second = F.when(rest > EXPLAINED * c, (y - F.coalesce(F.try_divide(b * x, a), F.lit(0.0))) / rest).otherwise(0.0)
    return F.coalesce(F.try_divide(x - b * second, a), F.lit(0.0)), second


def sarima(series: DataFrame, horizon: int = 12) -> DataFrame:
    """E5: order (1, 1, 1)(1, 1, 1, 12) with 95 % bands."""
    rows = first_stage(differenced(series, 3 * SEASON, True), SEASONAL_LAGS)
    lags = (1, SEASON, SEASON + 1)
    laid = rows.select("*", *along("w", lags, "l"), *along("e", lags, "e")).where("full")
    names = ["w", "l1", "l12", "l13", "e1", "e12", "e13"]
    sums = laid.groupBy("series").agg(*sums_of_products(names))

    def turn(s: Column, _: Column) -> Column:
        one = F.lit(1.0)
        # the regular pair, given the seasonal one, then the other way round
        p, q = pair({0: one, 2: -s["sp"], 5: -s["sq"]}, {1: one, 3: -s["sp"]}, {4: one, 6: s["sq"]}, names)
        made = F.struct(within(p).alias("p"), within(q).alias("q"))
        return F.transform(F.array(made), lambda m: F.transform(F.array(F.struct(*_seasonal(m, names))), lambda z: F.struct(m["p"].alias("p"), m["q"].alias("q"), z["sp"].alias("sp"), z["sq"].alias("sq")))[0])[0]

    start = F.struct(*(F.lit(0.0).alias(k) for k in ("p", "q", "sp", "sq")))
    fit = sums.select("series", F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), start, turn).alias("s")).select("series", "s.*")
    p, q, sp, sq = (F.col(k) for k in ("p", "q", "sp", "sq"))
    said = p * F.col("l1") + sp * F.col("l12") - p * sp * F.col("l13") + q * F.col("e1") + sq * F.col("e12") + q * sq * F.col("e13")
    miss = F.col("w") - said
    spread = laid.join(fit, "series").groupBy("series").agg((F.sum(miss * miss) / (F.count("*") - 4)).alias("sigma2"))
    one, minus = F.lit(1.0), F.lit(-1.0)
    ar = multiplied({0: one, 1: -p}, {0: one, SEASON: -sp}, {0: one, 1: minus}, {0: one, SEASON: minus})
    ma = multiplied({0: one, 1: q}, {0: one, SEASON: sq})
    fitted = fit.select("series", weights(ar, -1).alias("ar"), weights(ma, 1).alias("ma"))
    return continued(fitted.join(spread, "series").join(latest(rows, 2 * SEASON + 2, SEASON + 1), "series"), horizon)


def _seasonal(m: Column, names: Sequence[str]) -> tuple[Column, Column]:
    one = F.lit(1.0)
    p, q = pair({0: one, 1: -m["p"], 4: -m["q"]}, {2: one, 3: -m["p"]}, {5: one, 6: m["q"]}, names)
    return within(p).alias("sp"), within(q).alias("sq")
