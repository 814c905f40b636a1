"""Every registered query against its SQL on the smallest data set, and a few plans."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from reledger.plans.oracles import ORACLES
from reledger.plans.queries import REGISTRY
from tests.compare import compare, duck

SMALL = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(
    not Path(SMALL).is_dir(), reason="the sample tables are not on this machine"
)


@pytest.fixture(scope="module")
def second_engine():
    return duck(SMALL)


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert REGISTRY.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()


@needs_tables
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_rows_as_sql(spark, second_engine, name):
    got = entry_point.queries()[name](spark, SMALL)
    rows, difference = compare(got, second_engine, entry_point.oracle_sql()[name])
    assert difference == ""
    assert rows > 0


@needs_tables
def test_the_flagship_reads_only_its_columns_and_shuffles_twice(spark):
    plan = entry_point.entry(spark)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "l_orderkey" not in scans[0].split("ReadSchema")[1]
    assert plan.count("Exchange hashpartitioning") == 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@needs_tables
def test_one_stored_month_is_read_alone(spark):
    plan = entry_point.queries()["gold_month_pruned"](spark, SMALL)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "(report_month" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert all("report_month=199803" in name for name in plan.inputFiles())
