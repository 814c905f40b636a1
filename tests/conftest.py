from __future__ import annotations

import shutil
from datetime import timedelta

import pytest

from reledger import fixed_values as fixed
from reledger.fixed_values import GOOGLE_ADS, META_ADS
from reledger.lake import scratch_lake
from reledger.plans.publish import publish, reload_extraction
from reledger.session import build_session
from reledger.sources.synthetic import write_fixture

DAYS = tuple(
    str(fixed.FIRST_REPORT_DAY + timedelta(days=day + fixed.EXTRACTION_LAG_DAYS))
    for day in range(fixed.REPORT_DAY_COUNT)
)
RESTATED = str(fixed.RESTATEMENT_EXTRACTION_DAY)
PIVOT = (
    f"source = '{GOOGLE_ADS}' AND account_id = '{fixed.PIVOT_ACCOUNT}'"
    f" AND campaign_id = '{fixed.PIVOT_CAMPAIGN}' AND report_date = '{fixed.PIVOT_REPORT_DAY}'"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        extra={
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def empty_lake(spark):
    return scratch_lake(spark)


@pytest.fixture(scope="session")
def landing(spark):
    """The seven synthetic extractions, written once."""
    origin = f"{scratch_lake(spark).root}/raw"
    write_fixture(spark, origin)
    return origin


@pytest.fixture
def landed(empty_lake, landing):
    """A lake with the synthetic extractions in its landing area, none loaded."""
    shutil.copytree(landing, empty_lake.landing)
    return empty_lake


@pytest.fixture(scope="session")
def published(spark, landing):
    """The three regular days of both sources loaded and published; not to be changed."""
    lake = scratch_lake(spark)
    shutil.copytree(landing, lake.landing)
    load_days(lake)
    publish(lake)
    return lake


def load_days(lake):
    for source in (GOOGLE_ADS, META_ADS):
        for day in DAYS:
            reload_extraction(lake, source, day)


def value(lake, sql: str, **names):
    """The single value of a query; `{silver}` and the like name the tables."""
    row = lake.spark.sql(sql.format(**names)).collect()[0]
    return row[0] if len(row) == 1 else tuple(row)
