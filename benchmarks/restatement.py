"""Time the lake operations on generated reports; print one JSON line.

    python benchmarks/restatement.py --days 60 --accounts 50 --campaigns 20

Reports of all days land as one extraction, a fifth of the products comes back restated.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reledger.fixed_values import GOOGLE_ADS  # noqa: E402
from reledger.functions.calendar import in_months  # noqa: E402
from reledger.lake import GOLD, GOOGLE_RAW, LOADS, SILVER, scratch_lake  # noqa: E402
from reledger.operators.rollup import campaign_daily  # noqa: E402
from reledger.plans.publish import (  # noqa: E402
    build_gold,
    build_silver,
    reload_extraction,
    restate,
    silver_rows,
)
from reledger.session import build_session  # noqa: E402
from reledger.sources.landing import write_object  # noqa: E402
from reledger.sources.synthetic import campaign_days, google_reports  # noqa: E402

FIRST = date(2026, 1, 1)


def stored_bytes(spark, path: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(path)
    return files.agg(F.sum("length")).first()[0]


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--days", type=int, default=60)
    parser.add_argument("--accounts", type=int, default=50)
    parser.add_argument("--campaigns", type=int, default=20)
    parser.add_argument("--cpus", default="8")
    size = parser.parse_args()
    spark = build_session(
        "restatement",
        master=f"local[{size.cpus}]",
        extra={
            "spark.sql.shuffle.partitions": str(4 * int(size.cpus)),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(4 * int(size.cpus)),
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = scratch_lake(spark)
    reports = google_reports(
        campaign_days(
            spark, first_day=FIRST, days=size.days, accounts=size.accounts,
            campaigns=size.campaigns, tasks=4 * int(size.cpus),
        )
    )
    seconds: dict[str, float] = {}

    def timed(label, action):
        started = time.perf_counter()
        result = action()
        seconds[label] = round(time.perf_counter() - started, 2)
        return result

    def discard(rows):
        rows.write.format("noop").mode("overwrite").save()

    timed("land", lambda: write_object(reports, lake.landing, GOOGLE_ADS, "2027-01-01", "base"))
    restated = reports.filter("product_id < 'sku_20'").withColumn(
        "conversions", F.col("conversions") + 1
    )
    write_object(restated, lake.landing, GOOGLE_ADS, "2027-02-01", "late")
    write_object(
        restated.filter(F.month("segments_date") == 1), lake.landing, GOOGLE_ADS,
        "2027-03-01", "late",
    )
    for load in (1, 2, 3):
        timed(f"reload, load {load}", lambda: reload_extraction(lake, GOOGLE_ADS, "2027-01-01"))
    reload_extraction(lake, GOOGLE_ADS, "2027-02-01")
    months = timed("silver, all months", lambda: build_silver(lake))
    timed("gold, all months", lambda: build_gold(lake))
    timed("restate one month", lambda: restate(lake, GOOGLE_ADS, "2027-03-01"))
    # What a reader pays: Gold from Silver as stored, against latest-wins at read time.
    timed("read, latest kept at write", lambda: discard(campaign_daily(lake.table(SILVER))))
    timed("read, latest found at read", lambda: discard(campaign_daily(silver_rows(lake))))
    one = months[0]
    timed(
        "read one month", lambda: discard(campaign_daily(in_months(lake.table(SILVER), [one])))
    )
    plain = f"{lake.root}/plain"
    lake.table(SILVER).repartition("product_id").write.option("compression", "snappy").parquet(
        plain
    )
    print(
        json.dumps(
            {
                "rows": {
                    "bronze": lake.table(GOOGLE_RAW).count(),
                    "silver": lake.table(SILVER).count(),
                    "gold": lake.table(GOLD).count(),
                },
                "months": len(months),
                "seconds": seconds,
                "silver_bytes": {
                    "unsorted snappy": stored_bytes(spark, plain),
                    "sorted zstd delta": stored_bytes(spark, f"{lake.location(SILVER)}/{LOADS}"),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
