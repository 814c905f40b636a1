"""Run one step of the flow: `spark-submit -m reledger`, or `python -m reledger`.

    python -m reledger ROOT fixture
    python -m reledger ROOT ingest google_ads 2026-07-16
    python -m reledger ROOT publish
    python -m reledger ROOT query "SELECT count(*) FROM silver.ads_daily"
"""

from __future__ import annotations

import argparse

from reledger.fixed_values import DEFAULT_SEED
from reledger.lake import Lake
from reledger.plans.publish import (
    build_gold,
    build_silver,
    load_baseline,
    publish,
    reload_extractions,
    restate_days,
)
from reledger.session import build_session
from reledger.sources.synthetic import write_fixture


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="reledger", description=__doc__)
    parser.add_argument("root", help="folder of the lake, on any file system Spark can reach")
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("ddl", "seed", "silver", "gold", "publish"):
        steps.add_parser(name)
    steps.add_parser("fixture").add_argument("--seed", type=int, default=DEFAULT_SEED)
    for name in ("ingest", "restate"):
        step = steps.add_parser(name)
        step.add_argument("source")
        step.add_argument("extracted_at", nargs="+")
    steps.add_parser("query").add_argument("sql")
    chosen = parser.parse_args(arguments)

    spark = build_session()
    lake = Lake(spark, chosen.root.rstrip("/"))
    lake.ensure_tables()
    match chosen.step:
        case "seed":
            load_baseline(lake)
        case "fixture":
            write_fixture(spark, lake.landing, chosen.seed)
        case "ingest":
            print(reload_extractions(lake, chosen.source, chosen.extracted_at))
        case "restate":
            print(restate_days(lake, chosen.source, chosen.extracted_at))
        case "silver":
            print("months", build_silver(lake))
        case "gold":
            print("months", build_gold(lake))
        case "publish":
            print("months", publish(lake))
        case "query":
            spark.sql(chosen.sql).show(truncate=False)


if __name__ == "__main__":
    main()
