"""Checks on groups that are missing on one side and all zero on the other."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reledger.operators import quality
from reledger.operators.rollup import AMOUNTS, COMPONENTS, change_between
from reledger.session import SETTINGS

GRAIN = ["report_month"]


@pytest.fixture
def zeros(spark):
    row = spark.range(1).select(F.lit(202607).alias("report_month"))
    return row.select(
        "report_month",
        *[F.lit(0).cast("decimal(18,6)" if c in AMOUNTS else "bigint").alias(c) for c in COMPONENTS],
    )


@pytest.mark.parametrize("missing", ["left", "right"])
def test_zero_group_does_not_reconcile_with_nothing(zeros, missing):
    sides = (zeros.limit(0), zeros) if missing == "left" else (zeros, zeros.limit(0))
    assert [r.reconciles for r in quality.reconcile(*sides, GRAIN).collect()] == [False]
    assert [r.is_conserved for r in quality.conservation(*sides, GRAIN).collect()] == [False]


def test_equal_zero_groups_agree(zeros):
    assert [r.reconciles for r in quality.reconcile(zeros, zeros, GRAIN).collect()] == [True]
    assert [r.is_conserved for r in quality.conservation(zeros, zeros, GRAIN).collect()] == [True]


def test_zero_group_that_appears_or_vanishes_is_a_change(zeros):
    none = zeros.limit(0)
    assert [r.row_change for r in change_between(none, zeros, GRAIN).collect()] == [1]
    assert [r.row_change for r in change_between(zeros, none, GRAIN).collect()] == [-1]
    assert change_between(zeros, zeros, GRAIN).collect() == []


def test_shuffles_start_with_many_reducers():
    assert int(SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 4096


def test_column_audit_tells_a_wrong_and_a_missing_column(spark):
    declared = T.StructType.fromDDL("a bigint, b string")
    found = quality.column_audit(spark.createDataFrame([(1, 2.0)], "a int, c double"), declared)
    assert sorted(tuple(row) for row in found.collect()) == [
        ("a", "int", False, 1), ("b", None, False, 0), ("c", "double", False, 1)
    ]
