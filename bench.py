"""Times the named queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

One query runs untimed first, so that starting the session is not charged to whichever comes first.
Every timed query then runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tillwise.catalog.queries import QUERIES

# One query per kind of plan: scans and star joins, distinct orders, windows, exact order
# statistics, two-month comparisons, forecasts, rule sets, validation and ingest.
HEADLINE = (
    "kpis",
    "monthly_performance",
    "dimension_summary",
    "combo_product_channel",
    "seasonality_category",
    "pareto_product",
    "discount_leakage",
    "discount_margin_spearman",
    "anomalies",
    "product_economics",
    "filtered_kpis",
    "period_over_period_kpis",
    "period_drivers_mom",
    "opportunity_radar",
    "scenario_grid",
    "forecast_by_category",
    "forecast_backtest",
    "recommendations",
    "validation_report",
    "dataset_fingerprint",
    "ingest_quality",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["monthly_series"](spark, folder).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
