from __future__ import annotations

import random

from pyspark.sql import functions as F

from reledger.operators.latest import latest_wins
from reledger.plans.publish import NEWEST_FIRST, WINDOW_KEY, silver_rows


def brute_force(rows):
    best = {}
    for key, version, value in rows:
        best[key] = max(best.get(key, (version, value)), (version, value))
    return {(key, *winner) for key, winner in best.items()}


def test_matches_brute_force_with_a_hot_key_and_ties(spark):
    draw = random.Random(7)
    rows = [(draw.randrange(40), draw.randrange(5), draw.randrange(9)) for _ in range(2000)]
    rows += [(1, draw.randrange(5), draw.randrange(9)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "key long, version long, value long").repartition(7)
    got = latest_wins(df, ["key"], ["version", "value"]).collect()
    assert {tuple(row) for row in got} == brute_force(rows)
    assert len(got) == 40


def test_equal_rows_collapse_to_one(spark):
    df = spark.range(100).select(F.lit("k").alias("key"), F.lit(1).alias("version"))
    assert latest_wins(df, ["key"], ["version"]).count() == 1


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_are_limited_before_the_shuffle(empty_lake):
    """A key with many versions must not travel whole."""
    lines = plan_of(silver_rows(empty_lake)).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    shuffles = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(limits) == 2 and len(shuffles) == 1
    assert limits[0] < shuffles[0] < limits[1]
    assert "Partial" in lines[limits[1]]


def test_rows_leave_the_window_in_file_order(empty_lake):
    """The sort in front of the write is dropped, as the window already provides it."""
    from reledger.lake import SILVER

    rows = silver_rows(empty_lake, [202607]).select(*SILVER.column_order)
    order = [*SILVER.partitions, *SILVER.clustering]
    bare, ordered = plan_of(rows), plan_of(rows.sortWithinPartitions(*order))
    assert bare.count("Sort ") == ordered.count("Sort ")


def test_the_order_of_versions_is_total():
    assert WINDOW_KEY[1:] == ("source", "account_id", "report_date", "campaign_id", "product_id")
    assert NEWEST_FIRST[0] == "_extracted_at"
    assert set(NEWEST_FIRST[3:]) == {
        "spend_eur", "clicks", "impressions", "conversions", "revenue_eur"
    }
