"""Time the headline queries and print one JSON line.

Each query is built and run in full once to warm up and then BENCH_RUNS times; the value
is the sum of the medians. Building the plan counts as part of the query.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tracewell.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "feat_user_7d_count",
    "feat_last_login_asof",
    "feat_login_history_lag",
    "feat_all",
    "clean_dedup",
    "clean_all",
    "clean_report",
    "rule_velocity_raw",
    "prim_interval_self_join",
    "rule_flags_all",
    "rule_trigger_counts",
    "mart_fraud_summary",
    "mart_rule_breakdown",
    "mart_hourly_trend",
    "rpt_velocity_off_hours",
    "rpt_evasion_share",
    "rpt_remote_off_hours",
    "rpt_exec_metrics",
    "rpt_top10",
    "port_clean",
    "port_quality_report",
    "port_distance_summary",
    # Last, as their many small stages slow what comes after them in the same process.
    "feat_all_hot",
    "rule_flags_all_hot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        # A few MB of data: let small partitions stand, or adaptive execution leaves one task per stage.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
