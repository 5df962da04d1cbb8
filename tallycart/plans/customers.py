"""Customer reports Q24-Q35."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.functions.bands import RFM_LABELS, SPEND_LABELS, at_least
from tallycart.functions.dates import month_of, months_apart
from tallycart.functions.numeric import big, count_if, dbl, pct, ratio, rnd
from tallycart.operators.ladder import tile_scores
from tallycart.plans.rollups import customer_months, per_customer, resum
from tallycart.sources.warehouse import Warehouse

AS_OF = dt.date(2024, 12, 31)  # fixed value: the reporting date of the published reports


def rfm_base(wh: Warehouse, as_of: dt.date | Column = AS_OF) -> DataFrame:
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    # the filter that a later join on the customer would add is stated here, so that all uses share one scan
    return wh.sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.datediff(day, F.max("order_date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("sales_amount").alias("monetary"),
    )


def rfm_scored(wh: Warehouse, as_of: dt.date = AS_OF) -> DataFrame:
    return rfm_of(rfm_base(wh, as_of))


def rfm_of(base: DataFrame) -> DataFrame:
    """Scores of rows with customer_id, recency_days, frequency and monetary."""
    scores = {"r_score": ("recency_days", True), "f_score": ("frequency", False), "m_score": ("monetary", False)}
    return base.join(tile_scores(base, "customer_id", scores, 5), "customer_id").select(
        "customer_id",
        big("recency_days").alias("recency_days"),
        big("frequency").alias("frequency"),
        dbl("monetary").alias("monetary"),
        *scores,
    )


def rfm_segments(wh: Warehouse, as_of: dt.date = AS_OF, cuts: tuple[int, ...] = (13, 10, 7)) -> DataFrame:
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    bands = list(zip([F.lit(c) for c in cuts], RFM_LABELS))
    return (
        rfm_scored(wh, as_of)
        .withColumn("rfm_total", total)
        .withColumn("rfm_segment", at_least(F.col("rfm_total"), bands, RFM_LABELS[-1]))
    )


def q24(wh: Warehouse, as_of: dt.date = AS_OF, limit: int = 200) -> DataFrame:
    """Q24 RFM quintiles and segment, best totals first; customer id breaks ties."""
    return rfm_segments(wh, as_of).orderBy(F.desc("rfm_total"), "customer_id").limit(limit)


def q25(wh: Warehouse) -> DataFrame:
    """Q25 lifetime value per loyalty tier."""
    return (
        wh.customers.groupBy("loyalty_tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rnd(ratio(F.sum("lifetime_value"), F.count("lifetime_value"))).alias("avg_ltv"),
            dbl(F.min("lifetime_value")).alias("min_ltv"),
            dbl(F.max("lifetime_value")).alias("max_ltv"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def q26(wh: Warehouse) -> DataFrame:
    """Q26 share of buyers with more than one order."""
    per = wh.sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("c"))
    return per.agg(count_if(F.col("c") > 1).alias("again"), F.count(F.lit(1)).alias("every")).select(
        pct("again", "every").alias("repeat_purchase_rate_pct")
    )


def q27(wh: Warehouse) -> DataFrame:
    """Q27 new customers per signup month."""
    return (
        wh.customers.groupBy(month_of("signup_date").alias("signup_month"))
        .agg(F.count(F.lit(1)).alias("new_customers"))
        .orderBy("signup_month")
    )


def q28(wh: Warehouse, months: int = 12) -> DataFrame:
    """Q28 cohort retention for months 0-12.

    Activity is first reduced to one row per customer and month, so the later counts need no DISTINCT and no customer
    brings more rows than the calendar has months.
    """
    cohorts = wh.customers.select("customer_id", month_of("signup_date").alias("cohort_month"))
    active = wh.sales.select("customer_id", month_of("order_date").alias("activity_month")).distinct()
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_customers"))
    number = months_apart(F.col("activity_month"), F.col("cohort_month"))
    return (
        active.join(cohorts, "customer_id")
        .withColumn("month_number", big(number))
        .where((F.col("activity_month") >= F.col("cohort_month")) & F.col("month_number").between(0, months))
        .groupBy("cohort_month", "month_number")
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .join(sizes, "cohort_month")
        .select(
            "cohort_month",
            "month_number",
            "active_customers",
            "cohort_customers",
            pct("active_customers", "cohort_customers").alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def q29(wh: Warehouse, as_of: dt.date = AS_OF, days: int = 180) -> DataFrame:
    """Q29 customers whose last order lies more than ``days`` before ``as_of``."""
    last = wh.sales.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    gone = F.col("last_order") < F.date_sub(F.lit(as_of), days)
    return last.agg(
        count_if(gone).alias("churned_customers"), F.count(F.lit(1)).alias("total_customers_with_orders")
    ).withColumn("churn_rate_pct", pct("churned_customers", "total_customers_with_orders"))


def segment_profit(wh: Warehouse) -> DataFrame:
    """Revenue, profit and buyers per segment; one row per customer makes the distinct count a plain count."""
    return per_customer(wh).groupBy("segment").agg(*resum(), F.count(F.lit(1)).alias("customers"))


def q30(wh: Warehouse) -> DataFrame:
    """Q30 profit and profit per buyer by segment."""
    return (
        segment_profit(wh)
        .select(
            "segment",
            dbl("profit").alias("total_profit"),
            rnd(ratio("profit", "customers")).alias("profit_per_customer"),
        )
        .orderBy(F.desc("total_profit"))
    )


def q31(wh: Warehouse, cuts: tuple[int, int] = (10000, 3000)) -> DataFrame:
    """Q31 spend tiers by lifetime value."""
    value = F.col("lifetime_value")
    tier = (
        F.when(value >= cuts[0], SPEND_LABELS[0])
        .when(value >= cuts[1], SPEND_LABELS[1])
        .when(value > 0, SPEND_LABELS[2])
        .otherwise(SPEND_LABELS[3])
    )
    return (
        wh.customers.groupBy(tier.alias("spend_tier"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rnd(ratio(F.sum("lifetime_value"), F.count("lifetime_value"))).alias("avg_ltv"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def q32(wh: Warehouse, min_gaps: int = 3, limit: int = 50) -> DataFrame:
    """Q32 mean days between purchases. Gaps telescope, so the mean is (last - first) / (orders - 1): no window."""
    span = F.datediff(F.max("order_date"), F.min("order_date"))
    return (
        wh.sales.groupBy("customer_id")
        .agg(span.alias("span"), (F.count(F.lit(1)) - 1).alias("gaps"))
        .where(F.col("gaps") >= min_gaps)
        .select("customer_id", rnd(ratio("span", "gaps"), 1).alias("avg_days_between_purchases"))
        .orderBy("avg_days_between_purchases", "customer_id")
        .limit(limit)
    )


def q33(wh: Warehouse, factor: float = 0.3, month: dt.date | None = None, limit: int = 50) -> DataFrame:
    """Q33 customers whose revenue in the last (or given) month fell below ``factor`` of their prior three rows."""
    prior = Window.partitionBy("customer_id").orderBy("month").rowsBetween(-3, -1)
    trend = customer_months(wh).withColumn(
        "prior_3mo_avg", ratio(F.sum("revenue").over(prior), F.count("revenue").over(prior))
    )
    low = trend.where(F.col("revenue").cast("double") < F.lit(factor) * F.col("prior_3mo_avg"))
    if month is None:
        latest = wh.sales.agg(month_of(F.max("order_date")).alias("month"))
        low = low.join(F.broadcast(latest), "month")
    else:
        low = low.where(F.col("month") == F.lit(month))
    return (
        low.orderBy(F.desc("prior_3mo_avg"), "customer_id")
        .limit(limit)
        .select("customer_id", "month", dbl("revenue").alias("revenue"), rnd("prior_3mo_avg", 4).alias("prior_3mo_avg"))
    )


def q34(wh: Warehouse) -> DataFrame:
    """Q34 revenue of first-day orders and of later ones per month.

    Orders are summed per customer and day first; the first day is then found inside at most one row per day.
    """
    days = wh.sales.groupBy("customer_id", "order_date").agg(F.sum("sales_amount").alias("revenue"))
    first = F.min("order_date").over(Window.partitionBy("customer_id"))
    return (
        days.withColumn("fresh", F.col("order_date") == first)
        .groupBy(month_of("order_date").alias("month"))
        .agg(
            dbl(F.sum(F.when(F.col("fresh"), F.col("revenue")))).alias("new_customer_revenue"),
            dbl(F.sum(F.when(~F.col("fresh"), F.col("revenue")))).alias("returning_customer_revenue"),
        )
        .orderBy("month")
    )


def q35(wh: Warehouse, limit: int = 20) -> DataFrame:
    """Q35 top customers by lifetime value with their favourite category.

    The customers are chosen first; their ids (``limit`` rows) then filter the fact scan.
    """
    buyers = wh.sales.select("customer_id").distinct()
    top = (
        wh.customers.join(buyers, "customer_id", "left_semi")
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(limit)
        .select("customer_id", "country", "loyalty_tier", "lifetime_value")
    )
    spent = (
        wh.sales.join(F.broadcast(top.select("customer_id")), "customer_id", "left_semi")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("sales_amount").alias("revenue"))
        .join(wh.products.select("product_id", "category"), "product_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("revenue").alias("revenue"))
    )
    best = spent.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("revenue")).alias("minus"), "category")).getField("category").alias("favorite_category")
    )
    return (
        top.join(best, "customer_id")
        .withColumn("lifetime_value", dbl("lifetime_value"))
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )
