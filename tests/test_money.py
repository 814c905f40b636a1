from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reledger.functions.money import (
    amount_text,
    cents_to_amount,
    micros_to_amount,
    rounded_ratio,
    truncated_ratio,
)


def one(df, column):
    return df.select(column.alias("v")).collect()[0]["v"]


def amounts(spark, spend, count):
    return spark.sql(f"SELECT CAST('{spend}' AS DECIMAL(18,6)) spend, {count}L n")


@pytest.mark.parametrize(
    ("micros", "expected"),
    [
        (1_234_500_000, "1234.500000"),
        (1, "0.000001"),
        (-1, "-0.000001"),
        (0, "0.000000"),
        (999_999_999_999_999_999, "999999999999.999999"),
    ],
)
def test_micros_become_exact_amounts(spark, micros, expected):
    df = spark.sql(f"SELECT {micros}L AS m")
    assert one(df, micros_to_amount("m")) == Decimal(expected)
    assert one(df, amount_text(micros_to_amount("m"))) == expected


def test_an_amount_beyond_the_type_raises(spark):
    df = spark.sql("SELECT 1000000000000000000L AS m")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(micros_to_amount("m")).collect()


@pytest.mark.parametrize(
    ("spend", "count", "expected"),
    [
        ("20", 3, "6.666666"),  # a rounding division would say 6.666667
        ("-20", 3, "-6.666666"),
        ("12345", 407, "30.331695"),
        ("999999999999.999999", 1, "999999999999.999999"),
        ("0.000001", 2, "0.000000"),
    ],
)
def test_a_truncated_ratio_drops_digits(spark, spend, count, expected):
    df = amounts(spark, spend, count)
    assert one(df, truncated_ratio("spend", "n")) == Decimal(expected)


@pytest.mark.parametrize(
    ("revenue", "spend", "expected"),
    [
        ("62802.5", "12345", "5.0873"),
        ("1.00005", "1", "1.0001"),
        ("1.000049", "1", "1.0000"),
        ("-1.00005", "1", "-1.0001"),
        ("2", "3", "0.6667"),
    ],
)
def test_a_rounded_ratio_rounds_half_away_from_zero(spark, revenue, spend, expected):
    df = spark.sql(
        f"SELECT CAST('{revenue}' AS DECIMAL(18,6)) r, CAST('{spend}' AS DECIMAL(18,6)) s"
    )
    assert one(df, rounded_ratio("r", "s")) == Decimal(expected)


def test_a_ratio_over_zero_is_unknown(spark):
    df = amounts(spark, "5", 0)
    assert one(df, truncated_ratio("spend", "n")) is None
    assert one(df, rounded_ratio("spend", "cast(n as decimal(18,6))")) is None


def test_cents_become_amounts_with_two_digits(spark):
    df = spark.sql("SELECT 617250L AS c")
    assert str(one(df, cents_to_amount(F.col("c")))) == "6172.50"
