"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is computed in full (the result goes to Spark's ``noop`` sink): one warm-up run, then the
median of three timed runs. ``bench.py NAME ...`` times only the named queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans import QUERIES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

HEADLINE = [
    "kpi_row",
    "daily_trend",
    "top_products",
    "hierarchy_totals",
    "basket_affinity",
    "copurchase_network",
    "rfm_table",
    "rfm_scores",
    "quantile_segments",
    "cohort_retention",
    "customer_race",
    "customer_profiles",
    "price_scenarios",
    "quality_score",
    "outlier_report",
    "integrity_report",
    "json_typed_view",
    "quality_metrics",
    "auditor_view",
    "role_masks",
    "window_alerts",
    "orders_by_state",
    "customer_clusters",
    "sales_forecast_by_theme",
    "stream_refined_cards",
    "stream_fan_out",
]


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(spark, folder, name)
        runs = [timed(spark, folder, name) for _ in range(3)]
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name:28} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cores": int(cores),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
