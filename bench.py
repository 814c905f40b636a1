"""Time the headline queries; print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Each query runs once to warm up
and once on the clock, into a sink that discards rows; queries that write do so every time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from reledger.plans.queries import REGISTRY  # noqa: E402
from reledger.session import build_session  # noqa: E402

HEADLINE = (
    "gold_campaign_metrics",
    "gold_campaign_daily",
    "gold_monthly_metrics",
    "cross_source_spend",
    "silver_union",
    "latest_wins_lineitem",
    "late_restatement_silver",
    "restated_gold_delta",
    "micros_to_currency",
    "grain_uniqueness",
    "null_audit",
    "conservation_check",
    "table_fingerprint",
    "product_split",
    "bronze_reload_idempotent",
    "late_restatement_replayed",
    "gold_month_pruned",
    "late_restatement_gold",
    "daily_restatement_gold",
    "reconciliation_by_month",
    "drop_partition",
)


def run(spark, directory: str, name: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
            # As the baseline was measured: on one machine idle cores cost more than small files.
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, directory, name)
        seconds[name] = round(run(spark, directory, name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(directory).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
