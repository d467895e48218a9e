"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables' folder, ``BENCH_CPUS`` the local cores. Every
query is planned and run in full into a sink that discards rows; its time is the
median of three runs after one shared warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workloads.queries import QUERIES  # noqa: E402

HEADLINES = (
    "cell_site_actual",
    "usage_hourly",
    "region_usage_monthly",
    "primary_region_weekly",
    "primary_region_monthly",
    "primary_region_3month",
    "primary_region_horizons",
    "location_pipeline",
    "recharge_source_monthly",
    "recharge_source_horizons",
    "price_plan_current_prev",
    "subscriber_profile",
    "subscriber_profile_daily",
    "profile_voice",
    "crm_contacts",
    "bundle_sales",
    "tv_sales",
    "fixed_line_sales",
    "porting_feed",
    "service_visits",
    "asof_prior_record",
    "first_match_lookup",
    "latest_per_key",
    "sink_overwrite_date",
)
RUNS = 3


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("primary_region_monthly", "bundle_sales"):
        seconds(spark, name, folder)
    times = {
        name: round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
        for name in HEADLINES
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(folder.rsplit("sf", 1)[-1]) if "sf" in folder else None,
                "cpus": int(cpus),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
