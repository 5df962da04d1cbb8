"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The star schema is derived and stored before the clock starts on the reports, as a loaded database would be; the time
it takes is reported as ``load_star_schema``. Every query is run once to warm up and then timed with a full evaluation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallycart import Warehouse
from tallycart.catalog import QUERIES
from tallycart.session import local_session
from tallycart.sources.schemas import STAR

HEADLINE = (
    "q01", "q02", "q08", "q10", "q13", "q16", "q18", "q19", "q23", "q24", "q28", "q32", "q33", "q34", "q35", "q36",
    "q37", "q42", "q48", "q49", "q51", "q56", "q57", "q60", "q65", "q66", "q68", "q69", "v1_monthly_kpis",
    "r1_refresh_customer_ltv", "g1_revenue_in_range", "c3_clean_sales", "d_base_margin", "d_time_intelligence",
    "d_rank_customer", "m1_correlations", "m5_segment_anova", "m7_outlier_summary", "m10_decomposition", "i1_sales_movement",
    "b7_sliced_sales", "e7_scorecard", "c5_clean_returns", "c6_derive_stores", "c7_derive_warehouses", "c8_refresh_ltv",
    "c10_rules_before_cleaning", "s5_idempotent_load", "m6_cluster_profile", "m8_importance", "e8_outlook", "x1_clean_orders",
    "x2_stock_alerts", "x3_customer_value", "x4_daily_revenue", "x5_sliding_revenue", "e4_arima", "e5_sarima",
    "d_time_category_channel", "v1_after_loads", "b7_cube_region_category",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    wh = Warehouse.open(spark, sf_dir)
    seconds = {"load_star_schema": timed(lambda: [wh.table(t) for t in STAR])}
    cold: dict[str, float] = {}
    for name in wanted:

        def run(name: str = name) -> None:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        first = timed(run)
        seconds[name] = timed(run)
        cold[name] = first
    total = round(sum(seconds.values()), 3)
    result = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)[2:]}
    print(json.dumps(result | {"cold": cold, "cpus": int(cpus) if cpus.isdigit() else cpus}))


if __name__ == "__main__":
    main()
