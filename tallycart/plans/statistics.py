"""Statistical analyses M0-M10.

Means and variances come from exact decimal sums; cross products are summed as doubles. Tests that involve a customer attribute
first reduce the sales to sums per customer, so the fact table is never joined row by row.
"""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.dates import month_of
from tallycart.functions.numeric import count_if, dbl, pct, ratio, rnd
from tallycart.functions.tails import f_p_value, t_bound, t_p_value
from tallycart.operators.ladder import quantiles
from tallycart.plans.forecasting import SEASON, monthly_series, panel
from tallycart.plans.forest import fitted
from tallycart.session import lean, passing, staged
from tallycart.sources.warehouse import Warehouse


def features(wh: Warehouse) -> DataFrame:
    """M0: sales with product cost, price and category and customer segment, income and age."""
    products = wh.products.select("product_id", "category", "cost_price", "selling_price")
    people = wh.customers.select("customer_id", "segment", "income", "age")
    return wh.sales.join(products, "product_id", "left").join(people, "customer_id", "left")


def feature_profile(wh: Warehouse) -> DataFrame:
    """M0 summed up per category and segment."""
    return (
        features(wh)
        .groupBy("category", "segment")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            (F.count(F.lit(1)) - F.count("income")).alias("missing_income"),
            rnd(ratio(F.sum("income"), F.count("income"))).alias("avg_income"),
            rnd(ratio(F.sum("age"), F.count("age"))).alias("avg_age"),
            rnd(ratio(F.sum("cost_price"), F.count("cost_price"))).alias("avg_cost"),
            dbl(F.sum("profit")).alias("profit"),
        )
    )


FITS_AT_ONCE = 5

SALE_VARIABLES = ("quantity", "discount", "sales_amount", "profit")
PERSON_VARIABLES = ("income", "age")


def product_sums(wh: Warehouse) -> DataFrame:
    """One row with n, the sum of every variable and the sum of every product of two, rows with a gap left out.

    Income and age are constant per customer, so sale-side sums per customer are all that has to meet them.
    """
    pairs = list(itertools.combinations_with_replacement(SALE_VARIABLES, 2))
    own = (
        wh.sales.where(" AND ".join(f"{v} IS NOT NULL" for v in SALE_VARIABLES))
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(dbl(v)).alias(v) for v in SALE_VARIABLES],
            *[F.sum(dbl(a) * dbl(b)).alias(f"{a}*{b}") for a, b in pairs],
        )
    )
    people = wh.customers.select("customer_id", *[dbl(v).alias(f"p_{v}") for v in PERSON_VARIABLES])
    rows = own.join(people.where("p_income IS NOT NULL AND p_age IS NOT NULL"), "customer_id")
    count = F.col("n").cast("double")
    sums = [F.sum("n").alias("n")]
    sums += [dbl(F.sum(v)).alias(v) for v in SALE_VARIABLES]
    sums += [F.sum(count * F.col(f"p_{v}")).alias(v) for v in PERSON_VARIABLES]
    sums += [dbl(F.sum(f"`{a}*{b}`")).alias(f"{a}*{b}") for a, b in pairs]
    sums += [
        F.sum(dbl(a) * F.col(f"p_{b}")).alias(f"{a}*{b}") for a in SALE_VARIABLES for b in PERSON_VARIABLES
    ]
    sums += [
        F.sum(count * F.col(f"p_{a}") * F.col(f"p_{b}")).alias(f"{a}*{b}")
        for a, b in itertools.combinations_with_replacement(PERSON_VARIABLES, 2)
    ]
    return rows.agg(*sums)


def _centred(a: str, b: str) -> Column:
    return F.col("n") * F.col(f"`{a}*{b}`") - F.col(a) * F.col(b)


def correlations(wh: Warehouse) -> DataFrame:
    """M1: Pearson r, t and p for every pair of the six variables in long form, with a strength label."""
    names = (*SALE_VARIABLES, *PERSON_VARIABLES)
    cells = [
        F.struct(
            F.lit(a).alias("x"),
            F.lit(b).alias("y"),
            F.try_divide(_centred(a, b), F.sqrt(_centred(a, a)) * F.sqrt(_centred(b, b))).alias("r"),
        )
        for a, b in itertools.combinations(names, 2)
    ]
    freedom = F.col("n") - 2
    t = F.col("r") * F.sqrt(F.try_divide(freedom.cast("double"), 1 - F.col("r") * F.col("r")))
    size = F.abs("r")
    return (
        product_sums(wh)
        .select("n", F.explode(F.array(*cells)).alias("c"))
        .select("n", "c.x", "c.y", "c.r")
        .select(
            "x", "y", "n",
            rnd("r", 6).alias("r"),
            rnd(t, 3).alias("t"),
            rnd(t_p_value(t, freedom), 5).alias("p"),
            F.when(size < 0.3, "weak").when(size < 0.6, "moderate").otherwise("strong").alias("strength"),
        )
    )


def regression(wh: Warehouse, target: str = "profit", inputs: Sequence[str] = ("quantity", "discount", "sales_amount")) -> DataFrame:
    """M2: ordinary least squares with intercept; coefficient, standard error, t, p per term and R squared."""
    rows = wh.sales.select(*[dbl(c).alias(c) for c in (*inputs, target)]).na.drop()
    data = VectorAssembler(inputCols=list(inputs), outputCol="x").transform(rows).select("x", target)
    model = LinearRegression(featuresCol="x", labelCol=target, solver="normal").fit(data)
    summary = model.summary  # the intercept comes last in the per-term arrays
    terms = [*inputs, "intercept"]
    values = zip(
        terms, [*model.coefficients, model.intercept], summary.coefficientStandardErrors, summary.tValues, summary.pValues
    )
    table = wh.spark.createDataFrame(
        [(term, *map(float, numbers), float(summary.r2)) for term, *numbers in values],
        "term string, coefficient double, std_error double, t double, p double, r_squared double",
    )
    digits = {"coefficient": 4, "std_error": 4, "t": 2, "p": 5, "r_squared": 6}
    return table.select("term", *[rnd(c, n).alias(c) for c, n in digits.items()])


def _moments(df: DataFrame, *by: str) -> DataFrame:
    amount = F.col("sales_amount")
    return df.groupBy(*by).agg(
        F.count(amount).alias("n"), F.sum(amount).alias("s"), F.sum(amount * amount).alias("ss")
    )


def _mean() -> Column:
    return ratio("s", "n")


def _variance() -> Column:
    """Sample variance from exact sums."""
    spread = F.col("ss").cast("decimal(38,4)") * F.col("n") - F.col("s").cast("decimal(30,2)") * F.col("s").cast("decimal(30,2)")
    return F.try_divide(dbl(spread), dbl(F.col("n") * (F.col("n") - 1)))


def channel_test(wh: Warehouse) -> DataFrame:
    """M3: Welch's t-test of order value, online against offline."""
    sides = _moments(wh.sales, "sales_channel").select("sales_channel", "n", _mean().alias("m"), _variance().alias("v"))

    def side(name: str, column: str) -> Column:
        return F.max(F.when(F.col("sales_channel") == name, F.col(column))).cast("double")

    row = sides.agg(
        *[side(ch, c).alias(f"{c}{k}") for k, ch in ((1, "Online"), (2, "Offline")) for c in ("n", "m", "v")]
    )
    e1, e2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    t = (F.col("m1") - F.col("m2")) / F.sqrt(e1 + e2)
    freedom = (e1 + e2) * (e1 + e2) / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))
    return row.select(
        rnd("m1").alias("online_mean"),
        rnd("m2").alias("offline_mean"),
        rnd(t, 5).alias("t"),
        rnd(freedom, 2).alias("df"),
        rnd(t_p_value(t, freedom), 5).alias("p"),
    )


def mean_interval(wh: Warehouse, level: float = 0.95) -> DataFrame:
    """M4: t confidence interval of the mean order value."""
    error = F.sqrt(_variance() / F.col("n"))
    row = _moments(wh.sales).select("n", _mean().alias("m"), error.alias("e"))
    reach = F.col("e") * t_bound(level, F.col("n") - 1)
    return row.select(
        "n",
        rnd("m").alias("mean"),
        rnd("e", 4).alias("std_error"),
        rnd(F.col("m") - reach).alias("lower"),
        rnd(F.col("m") + reach).alias("upper"),
    )


def segment_anova(wh: Warehouse) -> DataFrame:
    """M5: one-way analysis of variance of order value by customer segment, with the group means."""
    own = _moments(wh.sales, "customer_id").join(wh.customers.select("customer_id", "segment"), "customer_id")
    groups = (
        own.where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    )
    square = dbl("s") * dbl("s")
    total = groups.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("every_n"),
        F.sum(square / F.col("n")).alias("between"),
        F.sum("s").alias("every_s"),
        F.sum("ss").alias("every_ss"),
    )
    k, rows = dbl("k"), dbl("every_n")
    explained = F.col("between") - dbl("every_s") * dbl("every_s") / rows
    rest = dbl("every_ss") - F.col("between")
    f = (explained / (k - 1)) / (rest / (rows - k))
    return groups.crossJoin(F.broadcast(total)).select(
        "segment",
        F.col("n").alias("orders"),
        rnd(ratio("s", "n")).alias("mean_order_value"),
        rnd(f, 4).alias("f"),
        rnd(f_p_value(f, k - 1, rows - k), 5).alias("p"),
    )


def rfm_features(wh: Warehouse) -> DataFrame:
    """M6 input: recency against the last order date, frequency and monetary value per buyer."""
    latest = wh.sales.agg(F.max("order_date").alias("latest"))
    own = wh.sales.groupBy("customer_id").agg(
        F.max("order_date").alias("seen"), F.count(F.lit(1)).alias("frequency"), F.sum("sales_amount").alias("monetary")
    )
    return own.crossJoin(F.broadcast(latest)).select(
        "customer_id",
        F.datediff("latest", "seen").cast("bigint").alias("recency"),
        "frequency",
        dbl("monetary").alias("monetary"),
    )


def clustered(wh: Warehouse, k: int = 4, seed: int = 42, restarts: int = 10) -> DataFrame:
    """M6: customers with their K-Means cluster on standardised RFM; the cheapest of ``restarts`` fits.

    Clusters are numbered by falling mean monetary value, so the numbering does not depend on the seed.
    Property checked in the tests: every customer belongs to its nearest centre.
    """
    columns = ["recency", "frequency", "monetary"]
    scale = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        ]
    )
    rows = staged(rfm_features(wh), "rfm")
    scaled = scale.fit(rows).transform(rows).drop("raw")
    data = scaled.persist()

    def fit(attempt: int):
        return KMeans(k=k, seed=seed + attempt, featuresCol="features", predictionCol="label").fit(data)

    with ThreadPool(FITS_AT_ONCE) as pool:  # fits are independent; their jobs share the cluster
        fits = pool.map(inheritable_thread_target(wh.spark)(fit), range(restarts))
    best = min(fits, key=lambda model: model.summary.trainingCost)
    data.unpersist()
    labelled = best.transform(scaled)
    order = labelled.groupBy("label").agg(F.avg("monetary").alias("worth"))
    order = order.select("label", F.row_number().over(Window.orderBy(F.desc("worth"))).cast("bigint").alias("cluster"))
    return labelled.join(F.broadcast(order), "label").select(
        "customer_id", *columns, "cluster", vector_to_array("features").alias("features")
    )


def cluster_profile(wh: Warehouse, k: int = 4) -> DataFrame:
    """M6: size and mean recency, frequency and monetary value per cluster."""
    return (
        clustered(wh, k)
        .groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rnd(F.avg("recency"), 1).alias("avg_recency"),
            rnd(F.avg("frequency"), 1).alias("avg_frequency"),
            rnd(F.avg("monetary"), 1).alias("avg_monetary"),
        )
    )


def _limits(wh: Warehouse, fence: float = 1.5) -> DataFrame:
    """One row with the fences of both outlier rules."""
    box = quantiles(wh.sales, "sales_amount", {"q1": 0.25, "q3": 0.75})
    whole = _moments(wh.sales).select("n", _mean().alias("m"), (_variance() * (F.col("n") - 1) / F.col("n")).alias("pv"))
    reach = (F.col("q3") - F.col("q1")) * fence
    return box.crossJoin(F.broadcast(whole)).select(
        "n", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"), "m", F.sqrt("pv").alias("sd")
    )


def _marked(wh: Warehouse, fence: float = 1.5, deviations: float = 3.0) -> DataFrame:
    value = dbl("sales_amount")
    return wh.sales.crossJoin(F.broadcast(_limits(wh, fence))).select(
        "order_id",
        value.alias("sales_amount"),
        ((value < F.col("low")) | (value > F.col("high"))).alias("iqr_outlier"),
        (F.abs(value - F.col("m")) > F.col("sd") * deviations).alias("z_outlier"),
        "n", "low", "high", "m", "sd",
    )


def outliers(wh: Warehouse, fence: float = 1.5, deviations: float = 3.0) -> DataFrame:
    """M7: orders outside the IQR fences or more than three population standard deviations from the mean."""
    columns = ("order_id", "sales_amount", "iqr_outlier", "z_outlier")
    return _marked(wh, fence, deviations).where(F.col("iqr_outlier") | F.col("z_outlier")).select(*columns)


def outlier_summary(wh: Warehouse) -> DataFrame:
    """M7: fences, counts and shares of both rules."""
    both = _marked(wh).agg(
        count_if(F.col("iqr_outlier")).alias("iqr"),
        count_if(F.col("z_outlier")).alias("z"),
        *[F.max(c).alias(c) for c in ("n", "low", "high", "m", "sd")],
    )
    entry = F.array(
        F.struct(F.lit("iqr").alias("method"), F.col("low").alias("lower"), F.col("high").alias("upper"), F.col("iqr").alias("hits")),
        F.struct(
            F.lit("z_score").alias("method"), (F.col("m") - F.col("sd") * 3).alias("lower"),
            (F.col("m") + F.col("sd") * 3).alias("upper"), F.col("z").alias("hits"),
        ),
    )
    return both.select("n", F.explode(entry).alias("e")).select(
        "e.method",
        rnd("e.lower").alias("lower"),
        rnd("e.upper").alias("upper"),
        F.col("e.hits").alias("outliers"),
        pct("e.hits", "n").alias("share_pct"),
    )


def importance(wh: Warehouse, trees: int = 100, depth: int = 8, seed: int = 42) -> DataFrame:
    """M8: random-forest importance of five inputs for order profit and R squared on the held-out fifth.

    The fifth is chosen by a hash of the order id, and so are the rows each tree draws: neither depends on partitioning.
    Property checked in the tests: an input unrelated to the target gets next to no importance.
    """
    inputs = ["quantity", "discount", "sales_amount", "income", "age"]
    people = wh.customers.select("customer_id", "income", "age")
    rows = (
        wh.sales.select("order_id", "customer_id", "quantity", "discount", "sales_amount", "profit")
        .join(people, "customer_id")
        .select("order_id", *[dbl(c).alias(c) for c in (*inputs, "profit")])
        .na.drop()
        .select(F.xxhash64("order_id").alias("key"), *inputs, "profit")
        .withColumn("held_out", F.pmod("key", F.lit(5)) == 0)
    )
    with lean(wh.spark), passing(wh.spark):
        rows = staged(rows, "forest-rows")  # the forest reads them several times
        # the inputs that cut most come last, the high digits of a cell: a task then meets few nodes of a tree
        order = ["age", "income", "discount", "quantity", "sales_amount"]
        weights, score = fitted(rows, order, "profit", "key", "held_out", trees, depth, seed)
    table = [(name, float(weights[order.index(name)]), float(score)) for name in inputs]
    return wh.spark.createDataFrame(table, "feature string, importance double, test_r_squared double").orderBy(
        F.desc("importance")
    )


def trend(wh: Warehouse, by: Sequence[str] = (), last=None, with_total: bool = False) -> DataFrame:
    """M9: least-squares line through each monthly series with the significance of its slope."""
    place = F.row_number().over(Window.partitionBy("series").orderBy("month")) - 1
    fit = (
        (panel if with_total else monthly_series)(wh, by, last)
        .withColumn("t", place.cast("double"))
        .groupBy("series")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.regr_slope("revenue", "t").alias("slope"),
            F.regr_intercept("revenue", "t").alias("intercept"),
            F.regr_r2("revenue", "t").alias("r2"),
        )
    )
    freedom = F.col("months") - 2
    t = F.signum("slope") * F.sqrt(F.try_divide(F.col("r2") * freedom, 1 - F.col("r2")))
    return fit.select(
        "series",
        "months",
        rnd("slope").alias("slope"),
        rnd("intercept").alias("intercept"),
        rnd("r2", 5).alias("r_squared"),
        rnd(t_p_value(t, freedom), 5).alias("p"),
        F.when(F.col("slope") > 0, "upward").otherwise("downward").alias("direction"),
    )


def decomposed(wh: Warehouse, by: Sequence[str] = (), last=None, with_total: bool = False) -> DataFrame:
    """Additive decomposition with period 12, unrounded.

    Trend: centred 2 x 12 mean, unknown for the first and last six months. Seasonal: mean of the detrended values per
    position in the year, shifted to average zero over the year.
    """
    half = SEASON // 2
    along = Window.partitionBy("series").orderBy("month")
    inner, full = along.rowsBetween(1 - half, half - 1), along.rowsBetween(-half, half)
    ends = F.lag("revenue", half).over(along) + F.lead("revenue", half).over(along)
    centred = (ends * 0.5 + F.sum("revenue").over(inner)) / SEASON
    rows = (
        (panel if with_total else monthly_series)(wh, by, last)
        .withColumn("place", (F.row_number().over(along) - 1) % SEASON)
        .withColumn("trend", F.when(F.count("revenue").over(full) == SEASON + 1, centred))
        .withColumn("loose", F.col("revenue") - F.col("trend"))
    )
    positions = rows.groupBy("series", "place").agg(F.avg("loose").alias("level"))
    shifted = positions.select(
        "series", "place", (F.col("level") - F.avg("level").over(Window.partitionBy("series"))).alias("seasonal")
    )
    return rows.join(shifted, ["series", "place"]).select(
        "series", "month", F.col("revenue").alias("observed"), "trend", "seasonal",
        (F.col("loose") - F.col("seasonal")).alias("resid"),
    )


def decomposition(wh: Warehouse, by: Sequence[str] = (), last=None, with_total: bool = False) -> DataFrame:
    """M10 per month, rounded."""
    parts = ("observed", "trend", "seasonal", "resid")
    return decomposed(wh, by, last, with_total).select("series", "month", *[rnd(c).alias(c) for c in parts])


def seasonal_index(wh: Warehouse, by: Sequence[str] = (), last=None, with_total: bool = False) -> DataFrame:
    """Seasonal component per calendar month."""
    return (
        decomposed(wh, by, last, with_total)
        .groupBy("series", F.month("month").cast("bigint").alias("month_number"))
        .agg(rnd(F.avg("seasonal")).alias("seasonal_index"))
    )


def seasonality(wh: Warehouse, by: Sequence[str] = (), last=None, with_total: bool = False) -> DataFrame:
    """M10 summary per series: strength, range and the months of peak and trough."""
    rows = decomposed(wh, by, last, with_total).withColumn("m", F.month("month"))
    both = F.col("seasonal") + F.col("resid")
    whole = rows.groupBy("series").agg(
        (1 - ratio(F.var_samp("resid"), F.var_samp(both))).alias("strength"),
        F.min("seasonal").alias("low"),
        F.max("seasonal").alias("high"),
        F.max_by("m", "seasonal").cast("bigint").alias("peak_month"),
        F.min_by("m", "seasonal").cast("bigint").alias("trough_month"),
    )
    return whole.select(
        "series",
        rnd("strength", 4).alias("seasonal_strength"),
        rnd("low").alias("seasonal_low"),
        rnd("high").alias("seasonal_high"),
        "peak_month",
        "trough_month",
    )


def price_elasticity(wh: Warehouse) -> DataFrame:
    """Demand elasticity per category: slope of ln(units) on ln(net price per unit) over the product-months with sales.

    NULL where all prices are equal. The fact is reduced to product-months before anything is joined.
    """
    months = wh.sales.groupBy("product_id", month_of("order_date").alias("month")).agg(
        F.sum("quantity").alias("units"), F.sum("sales_amount").alias("revenue")
    )
    sold = months.where((F.col("units") > 0) & (F.col("revenue") > 0)).join(wh.products.select("product_id", "category"), "product_id")
    points = sold.select("category", F.log(dbl("units")).alias("y"), F.log(dbl("revenue") / dbl("units")).alias("x"))
    fit = points.groupBy("category").agg(
        F.count(F.lit(1)).alias("product_months"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_r2("y", "x").alias("r2"),
    )
    return fit.select("category", "product_months", rnd("slope", 4).alias("elasticity"), rnd("r2", 5).alias("r_squared"))


def churn_propensity(wh: Warehouse, cut: dt.date, days: int = 180) -> DataFrame:
    """Probability per customer that no order follows within ``days`` after ``cut``, by logistic regression on recency,
    frequency and spend up to the cut. Fitted by Spark on all customers seen by then; whoever came back is known."""
    until = wh.sales.where(F.col("order_date") <= F.lit(cut)).groupBy("customer_id").agg(
        F.datediff(F.lit(cut), F.max("order_date")).cast("double").alias("recency"),
        F.log1p(F.count(F.lit(1)).cast("double")).alias("frequency"),
        F.log1p(F.greatest(dbl(F.sum("sales_amount")), F.lit(0.0))).alias("monetary"),
    )
    after = wh.sales_between(cut + dt.timedelta(days=1), cut + dt.timedelta(days=days)).select("customer_id").distinct()
    rows = until.join(after.withColumn("back", F.lit(1)), "customer_id", "left").withColumn("churned", F.isnull("back").cast("double"))
    inputs = ["recency", "frequency", "monetary"]
    data = staged(rows.select("customer_id", *inputs, "churned"), "churn-rows")
    vectors = VectorAssembler(inputCols=inputs, outputCol="x").transform(data)
    model = LogisticRegression(featuresCol="x", labelCol="churned", regParam=0.001, maxIter=50).fit(vectors)
    # by the coefficients: the model holds its summary, the summary the session, which no task takes once it has observed metrics
    margin = F.lit(float(model.intercept))
    for name, weight in zip(inputs, model.coefficients, strict=True):
        margin += F.col(name) * F.lit(float(weight))
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return data.select("customer_id", rnd(chance, 6).alias("churn_probability"), F.col("churned").cast("int").alias("churned"))
