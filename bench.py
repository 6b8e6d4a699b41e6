"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Each query writes its
whole result to Spark's noop sink; the best of BENCH_RUNS timed runs counts, after one
untimed run that loads classes and compiles code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from authlane.plans.catalog import QUERIES  # noqa: E402
from authlane.session import RUNTIME_CONF  # noqa: E402

HEADLINE = [
    "auth_events",
    "endpoint_activity",
    "recent_login_detections",
    "rule_failed_login_burst",
    "rule_failed_then_success",
    "rule_password_spray",
    "rule_distributed_attack",
    "rule_windows_failed_logon_burst",
    "rule_pack_top1",
    "rule_pack_all_groups",
    "alert_history",
    "alert_dedup_ever",
    "replay_sliding_top1",
    "suppression_by_table",
    "normalize_generic",
    "normalize_synthetic_auth",
    "normalize_ssh_auth",
    "normalize_windows_auth",
    "windows_export_to_envelope",
    "envelope_decode",
    "envelope_publish",
    "stringify_map",
    "events_feed",
    "health",
    "events_per_minute",
    "top_ingest_sources",
    "alert_conditions",
    "event_rate_transitions",
    "alert_presentation",
    "contract_violations",
]


def run_once(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("authlane-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        # The test tables are megabytes: let adaptive execution keep small tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
        times[name] = round(min(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
