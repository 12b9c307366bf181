"""Time the headline queries on one machine; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query writes its
whole result to Spark's noop sink. The shared tables (cleaned lines, segments,
features) are built first and timed as queries of their own, "stage_*".
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.catalog import tables  # noqa: E402
from tillroll.catalog.queries import QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402
from tillroll.staging import scratch  # noqa: E402

HEADLINE = [
    "revenue_totals",
    "revenue_monthly",
    "revenue_weekly",
    "revenue_top_months",
    "revenue_avg_daily",
    "customers_top_spend",
    "customers_frequency_dist",
    "customers_cohorts",
    "customers_active",
    "customers_pareto",
    "products_top_revenue",
    "products_best_by_country",
    "products_return_rate",
    "adv_rolling_3m",
    "adv_purchase_gaps",
    "adv_country_cumulative",
    "adv_top_product_per_customer",
    "adv_basket_sizes",
    "cross_sell",
    "rfm_summary_sql",
    "rfm_summary",
    "v_customer_summary",
    "v_product_summary",
    "w_rank",
    "w_lag",
    "table_profile",
    "cleaning_report",
    "winsorize",
    "feature_table",
    "kpi_by",
    "star_join",
    "metrics_regression",
    "attribution_local",
    "cac_tier_percentile",
    "model_linear",
    "model_tree",
]
STAGES = {
    "stage_lines": tables.kept,
    "stage_cleaned": tables.cleaned,
    "stage_segments": tables.segments,
    "stage_features": tables.feature_table,
}


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    drain(tables.lines(spark, folder))  # start the JVM's compilers
    timings = {}
    with scratch(spark):
        for name, run in {**STAGES, **{n: QUERIES[n] for n in HEADLINE}}.items():
            start = time.perf_counter()
            drain(run(spark, folder))
            timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
