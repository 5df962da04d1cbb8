"""Forecasts of many monthly series at once (E0-E8). The published single series is the panel with one series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.dates import spine_between
from tallycart.functions.numeric import rnd
from tallycart.plans.arima import arima, sarima
from tallycart.plans.measures import fact_keys, in_context
from tallycart.session import staged
from tallycart.sources.warehouse import Warehouse


def _sums(wh: Warehouse, by: Sequence[str], last) -> DataFrame:
    """Revenue per month and attribute values, reduced from the fact once and written. ``last`` cuts off incomplete months."""
    reduced = wh.sales.groupBy(*fact_keys([*by, "month"])).agg(F.sum("sales_amount").alias("revenue"))
    sums = in_context(wh, reduced, by).groupBy(*by, "month").agg(F.sum("revenue").alias("revenue"))
    return staged(sums if last is None else sums.where(F.col("month") <= F.lit(last)), "monthly-sums")


def _gap_free(sums: DataFrame, name: Column) -> DataFrame:
    named = sums.groupBy(name.alias("series"), "month").agg(F.sum("revenue").cast("double").alias("revenue"))
    bounds = named.groupBy("series").agg(F.min("month").alias("first"), F.max("month").alias("final"))
    return (
        spine_between(bounds, "first", "final", "month", "month")
        .join(named, ["series", "month"], "left")
        .select("series", "month", F.coalesce("revenue", F.lit(0.0)).alias("revenue"))
    )


def monthly_series(wh: Warehouse, by: Sequence[str] = (), last=None) -> DataFrame:
    """(series, month, revenue) with every month between a series' first and last sale; missing months are 0.

    ``series`` is 'total' or the attribute values joined by '|'. ``last`` cuts off incomplete months.
    """
    return _gap_free(_sums(wh, by, last), F.concat_ws("|", *by) if by else F.lit("total"))


def panel(wh: Warehouse, by: Sequence[str] = (), last=None) -> DataFrame:
    """The total series and one series per value of the given attributes, from one scan of the fact."""
    sums = _sums(wh, by, last)
    total = _gap_free(sums, F.lit("total"))
    return total.unionByName(_gap_free(sums, F.concat_ws("|", *by))) if by else total


def moving_average(series: DataFrame, horizon: int = 12, window: int = 3) -> DataFrame:
    """The mean of the last ``window`` values, fed back month after month. Plain SQL arrays, no Python."""
    recent = Window.partitionBy("series").orderBy(F.desc("month"))
    tails = (
        series.withColumn("back", F.row_number().over(recent))
        .where(F.col("back") <= window)
        .groupBy("series")
        .agg(
            F.max("month").alias("final"),
            F.transform(
                F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("o"), "revenue"))), lambda x: x["revenue"]
            ).alias("values"),
        )
    )

    def step(history, _):
        used = F.slice(history, -F.least(F.lit(window), F.size(history)), F.least(F.lit(window), F.size(history)))
        total = F.aggregate(used, F.lit(0.0), lambda a, x: a + x)
        return F.concat(history, F.array(total / F.size(used)))

    steps = F.sequence(F.lit(1), F.lit(horizon))
    grown = tails.withColumn("all", F.aggregate(steps, F.col("values"), step)).select(
        "series", "final", F.slice("all", -F.lit(horizon), F.lit(horizon)).alias("ahead")
    )
    return grown.select("series", "final", F.posexplode("ahead").alias("k", "forecast")).select(
        "series", F.add_months("final", F.col("k") + 1).alias("month"), "forecast"
    )


MOVING_AVERAGE, SMOOTHING, LOG_LINEAR = "Moving Average", "Exponential Smoothing", "Log-Linear Trend and Season"
ARIMA, SARIMA = "ARIMA", "SARIMA"
SEASON = 12
Z95 = 1.96  # fixed value: normal quantile of the published bands
#: Points per weight and half width of the grids that exponential smoothing tries, one after the other.
ZOOM = ((7, 0.5), (5, 1 / 6), (5, 1 / 12), (5, 1 / 24), (5, 1 / 48))
SHORT, SHORT_SEASONAL = "fewer than 24 months", "fewer than 36 months"
NEGATIVE = "needs revenue above -1"
NO_HOLDOUT = "too short for a holdout"


def _lists(series: DataFrame) -> DataFrame:
    """One row per series with its values in order; a series is as long as the calendar."""
    ordered = F.array_sort(F.collect_list(F.struct("month", "revenue")))
    rows = series.groupBy("series").agg(F.max("month").alias("final"), ordered.alias("rows"))
    return rows.select("series", "final", F.transform("rows", lambda x: x["revenue"]).alias("v"), F.size("rows").alias("n"))


def _ahead(frame: DataFrame, horizon: int) -> DataFrame:
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return frame.withColumn("h", steps).withColumn("month", F.add_months("final", F.col("h")))


def smoothing(series: DataFrame, horizon: int = 12) -> DataFrame:
    """Additive level, slope and season of twelve months with estimated weights. The step from the first year's mean to
    the second's gives the slope, the first year about that line level and season. The weights of least squared one-step
    error are found for each series by zooming: a grid over 0 to 1, then finer grids around the best point so far, each
    tried by a fold over the series' months, without a shuffle. The error may have several valleys and the zoom follows the
    best point of the first grid: on 30 test series its squared error was at most 3.2 % above the best of 30 x 30 x 30
    weights, for most below it. The band is constant, as the published one. 24 months at least."""
    year = lambda at: F.aggregate(F.slice("v", at, SEASON), F.lit(0.0), lambda a, x: a + x) / SEASON
    start = _lists(series).where(F.col("n") >= 2 * SEASON).withColumn("m1", year(1))
    start = start.withColumn("rise", (year(SEASON + 1) - F.col("m1")) / SEASON)
    state = F.struct(
        (F.col("m1") + F.col("rise") * 5.5).alias("level"),  # the line at the end of the first year
        F.col("rise").alias("slope"),
        F.transform(F.slice("v", 1, SEASON), lambda x, i: x - (F.col("m1") + F.col("rise") * (i - 5.5))).alias("season"),
        F.lit(0.0).alias("sse"),
    )
    start = start.withColumn("state", state).withColumn("rest", F.slice(F.col("v"), F.lit(SEASON + 1), F.col("n") - SEASON))

    def run(w: Column) -> Column:
        def step(s: Column, y: Column) -> Column:
            cycle, line = F.element_at(s["season"], 1), s["level"] + s["slope"]
            miss = y - (line + cycle)
            level = w["a"] * (y - cycle) + (1 - w["a"]) * line
            return F.struct(
                level.alias("level"),
                (w["b"] * (level - s["level"]) + (1 - w["b"]) * s["slope"]).alias("slope"),
                F.concat(F.slice(s["season"], 2, SEASON - 1), F.array(w["g"] * (y - level) + (1 - w["g"]) * cycle)).alias("season"),
                (s["sse"] + miss * miss).alias("sse"),
            )

        return F.aggregate("rest", F.col("state"), step)

    best = start.withColumn("w", F.struct(*(F.lit(0.5).alias(k) for k in "abg")))
    for points, width in ZOOM:
        low = {k: F.greatest(F.lit(0.0), F.col("w")[k] - width) for k in "abg"}
        high = {k: F.least(F.lit(1.0), F.col("w")[k] + width) for k in "abg"}
        axis = {k: F.array(*(low[k] + (high[k] - low[k]) * float(i) / (points - 1) for i in range(points))) for k in "abg"}
        best = best.select("*", *(axis[k].alias(f"_{k}") for k in "abg"))
        grid = F.flatten(F.transform("_a", lambda a: F.flatten(F.transform("_b", lambda b: F.transform("_g", lambda g: F.struct(a.alias("a"), b.alias("b"), g.alias("g")))))))
        tried = F.transform(grid, lambda w: F.struct(run(w)["sse"].alias("sse"), w["a"].alias("a"), w["b"].alias("b"), w["g"].alias("g")))
        best = best.withColumn("w", F.array_min(tried)).drop("_a", "_b", "_g")
    best = best.withColumn("s", run(F.col("w"))).select("series", "final", "n", "s")
    h = F.col("h")
    forecast = F.col("s.level") + h * F.col("s.slope") + F.element_at("s.season", ((h - 1) % SEASON + 1).cast("int"))
    spread = Z95 * F.sqrt(F.col("s.sse") / (F.col("n") - SEASON))
    out = _ahead(best, horizon).withColumn("forecast", forecast)
    return out.select("series", "month", "forecast", (forecast - spread).alias("lower"), (forecast + spread).alias("upper"))


def log_linear(series: DataFrame, horizon: int = 12) -> DataFrame:
    """ln(1 + revenue) as a line in time plus a level per calendar month, by least squares. The line's slope comes
    from deviations within the calendar months, which solves the normal equations by grouped sums alone. 24 months at
    least, all above -1."""
    along = Window.partitionBy("series").orderBy("month")
    whole = Window.partitionBy("series")
    rows = series.withColumn("t", (F.row_number().over(along) - 1).cast("double")).withColumn("n", F.count("*").over(whole))
    rows = rows.withColumn("least", F.min("revenue").over(whole)).where((F.col("n") >= 2 * SEASON) & (F.col("least") > -1))
    rows = rows.withColumn("z", F.log1p("revenue"))
    rows = rows.withColumn("place", F.month("month"))
    within = Window.partitionBy("series", "place")
    centred = rows.withColumn("tm", F.avg("t").over(within)).withColumn("zm", F.avg("z").over(within))
    dt_, dz = F.col("t") - F.col("tm"), F.col("z") - F.col("zm")
    slope = centred.groupBy("series").agg((F.sum(dt_ * dz) / F.sum(dt_ * dt_)).alias("slope"))
    fitted = centred.join(slope, "series").withColumn("level", F.col("zm") - F.col("slope") * F.col("tm"))
    miss = F.col("z") - F.col("level") - F.col("slope") * F.col("t")
    size = fitted.groupBy("series").agg(
        F.max("month").alias("final"), F.max("n").alias("n"), F.max("slope").alias("slope"), F.sum(miss * miss).alias("sse")
    )
    levels = fitted.groupBy("series", "place").agg(F.max("level").alias("level"))
    ahead = _ahead(size, horizon).withColumn("place", F.month("month")).join(levels, ["series", "place"])
    z = F.col("level") + F.col("slope") * (F.col("n") - 1 + F.col("h"))
    spread = Z95 * F.sqrt(F.col("sse") / (F.col("n") - SEASON - 1))
    return ahead.select(
        "series", "month", (F.exp(z) - 1).alias("forecast"), (F.exp(z - spread) - 1).alias("lower"), (F.exp(z + spread) - 1).alias("upper")
    )


def averaged(series: DataFrame, horizon: int = 12) -> DataFrame:
    """The moving average in the form of the other models; it has no interval of its own."""
    out = moving_average(series, horizon)
    return out.select("series", "month", "forecast", F.col("forecast").alias("lower"), F.col("forecast").alias("upper"))


MODELS = {MOVING_AVERAGE: averaged, SMOOTHING: smoothing, ARIMA: arima, SARIMA: sarima, LOG_LINEAR: log_linear}


def holdout(series: DataFrame, months: int = 12) -> tuple[DataFrame, DataFrame]:
    """Training and test part of every series: the last ``months`` are held out in time order."""
    back = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("month")))
    marked = series.withColumn("back", back)
    return (
        marked.where(F.col("back") > months).drop("back"),
        marked.where(F.col("back") <= months).drop("back"),
    )


def metrics(pairs: DataFrame, *by: str) -> DataFrame:
    """RMSE, MAE and MAPE of (revenue, forecast) per group; MAPE is NULL when an actual value is 0."""
    miss = F.col("revenue") - F.col("forecast")
    share = F.abs(F.try_divide(miss, "revenue"))
    undefined = F.max(F.when(F.col("revenue") == 0, 1).otherwise(0)) == 1
    return pairs.groupBy(*by).agg(
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        F.when(~undefined, F.avg(share) * 100).alias("mape"),
    )


def all_forecasts(train: DataFrame, horizon: int = 12) -> DataFrame:
    """Every model's forecast of every series that it can fit."""
    out = None
    for name, model in MODELS.items():
        made = model(train, horizon).withColumn("model", F.lit(name))
        out = made if out is None else out.unionByName(made)
    return out


def scorecard(series: DataFrame, months: int = 12) -> DataFrame:
    """Errors of every model on the held-out months, and the chosen model per series: least MAPE, or least RMSE where
    a held-out month without revenue leaves MAPE undefined. Every series has a row for every model; a model that can't be
    fitted or a series without a holdout has no scores but a ``reason``, and then the moving average is chosen."""
    series = staged(series, "series")
    train, test = holdout(series, months)
    scores = metrics(all_forecasts(train, months).join(test, ["series", "month"]), "series", "model")
    counts = series.groupBy("series").agg(F.count("*").alias("n"))
    least = train.groupBy("series").agg(F.min("revenue").alias("least"))
    names = F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model")
    every = counts.join(least, "series", "left").select("series", "n", "least", names).join(scores, ["series", "model"], "left")
    reason = (
        F.when(F.col("n") <= months, NO_HOLDOUT)
        .when(F.col("rmse").isNotNull(), F.lit(None))
        .when(F.col("n") - months < 2 * SEASON, SHORT)
        .when((F.col("model") == SARIMA) & (F.col("n") - months < 3 * SEASON), SHORT_SEASONAL)
        .otherwise(NEGATIVE)
    )
    order = [F.asc_nulls_last("mape"), F.asc_nulls_last("rmse"), F.when(F.col("model") == MOVING_AVERAGE, 0).otherwise(1), F.col("model")]
    place = F.row_number().over(Window.partitionBy("series").orderBy(*order))
    return every.select(
        "series", "model", rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), rnd("mape", 4).alias("mape"),
        (place == 1).alias("chosen"), reason.alias("reason"),
    )


def outlook(series: DataFrame, horizon: int = 12, months: int = 12) -> DataFrame:
    """The chosen model of each series refitted on its whole history, ``horizon`` months ahead with bounds; ``reason``
    says why a series had to take the moving average."""
    kept = staged(series, "series")
    best = staged(scorecard(kept, months).where("chosen").select("series", "model", "reason"), "chosen")
    wanted = {row.model for row in best.select("model").distinct().collect()}  # names of MODELS, so five at most
    out = None
    for name, model in MODELS.items():
        if wanted and name not in wanted:
            continue
        own = kept.join(best.where(F.col("model") == name).select("series"), "series", "left_semi")
        made = model(own, horizon).withColumn("model", F.lit(name))
        out = made if out is None else out.unionByName(made)
    rounded = [rnd(c).alias(c) for c in ("forecast", "lower", "upper")]
    return out.join(best.select("series", "reason"), "series").select("series", "model", "month", *rounded, "reason")


def forecast_file(rows: DataFrame, series: str = "total") -> DataFrame:
    """A series' outlook in the columns of the stored forecast file."""
    return rows.where(F.col("series") == series).select(
        F.col("month").alias("Month"), F.col("forecast").alias("Forecasted_Revenue"),
        F.col("lower").alias("Lower_95CI"), F.col("upper").alias("Upper_95CI"),
    )


def total_outlook(wh: Warehouse, last: dt.date, horizon: int = 12) -> DataFrame:
    """S10 content: the outlook of the total series after ``last``, in the columns of the forecast file."""
    return forecast_file(outlook(monthly_series(wh, last=last), horizon))


def outlook_with_history(series: DataFrame, horizon: int = 12) -> DataFrame:
    """B6 line and band: history first, then the forecast with its bounds."""
    nothing = F.lit(None).cast("double")
    past = series.select(
        "series", "month", rnd("revenue").alias("total_revenue"), nothing.alias("forecast"),
        nothing.alias("lower"), nothing.alias("upper"),
    )
    ahead = outlook(series, horizon).select(
        "series", "month", nothing.alias("total_revenue"), "forecast", "lower", "upper"
    )
    return past.unionByName(ahead)
