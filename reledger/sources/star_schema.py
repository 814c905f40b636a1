"""Reports of both networks derived from a star schema of orders and events.

`lineitem`, which spans seven years, plays the network that reports micro-units per product.
`events`, which spans one month, plays the one that reports currency and no product, and is
also summed per user in the form of the first network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reledger.fixed_values import REPORTED_AMOUNT
from reledger.functions.money import cents_to_amount

# What the derived reports are stamped with.
FILE_A = "lake/lineitem.parquet"
FILE_B = "lake/events.parquet"
EXTRACTED_A = "2002-01-01"
EXTRACTED_B = "2024-02-01"
RESTATED_A = "2002-03-01"
EXTRACTED_E = "2024-02-01"
RESTATED_E = "2024-03-01"
CORRECTION_LAG_DAYS = 31
INGESTED_AT = "2026-07-17 03:00:00"


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def _hundredths(price: Column) -> Column:
    """A double with two digits as a whole number, so that sums of it are exact."""
    return F.rint(price * 100).cast("bigint")


def google_report(lineitem: DataFrame) -> DataFrame:
    """One row per line item; cost is the discount granted, zero for a tenth of them."""
    cents = _hundredths(F.col("l_extendedprice"))
    discount_points = _hundredths(F.col("l_discount"))
    tax_points = _hundredths(F.col("l_tax"))
    quantity = F.col("l_quantity").cast("bigint")
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("account_id"),
        F.concat("l_returnflag", "l_linestatus").alias("campaign_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("segments_date"),
        (cents * discount_points * 100).alias("cost_micros"),
        quantity.alias("clicks"),
        (quantity * tax_points * 10).alias("impressions"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("conversions"),
        cents_to_amount(cents).alias("revenue_eur"),
    )


def meta_report(events: DataFrame) -> DataFrame:
    """Events summed to one row per account, campaign and day."""
    cents = _hundredths(F.col("value"))
    earned = F.when(F.col("event_type").isin("purchase", "signup"), cents).otherwise(F.lit(0))
    return (
        events.groupBy(
            (F.col("user_id") % 10).cast("string").alias("account_id"),
            F.col("event_type").alias("campaign_id"),
            F.col("ts").cast("date").alias("date_start"),
        )
        .agg(
            cents_to_amount(F.sum(cents)).alias("spend"),
            F.count_if(F.col("event_type") != "view").alias("clicks"),
            F.count(F.lit(1)).alias("impressions"),
            F.count_if(F.col("event_type") == "purchase").alias("conversions"),
            cents_to_amount(F.sum(earned)).alias("revenue_eur"),
        )
    )


def google_event_report(events: DataFrame) -> DataFrame:
    """Events summed per user and day in the form of the network that reports products."""
    cents = _hundredths(F.col("value"))
    return events.groupBy(
        (F.col("user_id") % 10).cast("string").alias("account_id"),
        F.col("event_type").alias("campaign_id"),
        F.col("user_id").cast("string").alias("product_id"),
        F.col("ts").cast("date").alias("segments_date"),
    ).agg(
        (F.sum(cents) * 10_000).alias("cost_micros"),
        F.count_if(F.col("event_type") != "view").alias("clicks"),
        F.count(F.lit(1)).alias("impressions"),
        F.count_if(F.col("event_type") == "purchase").alias("conversions"),
        cents_to_amount(F.sum(cents)).alias("revenue_eur"),
    )


def restated_report(report: DataFrame) -> DataFrame:
    """A late correction: returned items and purchases come back with higher figures."""
    corrected = F.col("campaign_id").startswith("R") | (F.col("campaign_id") == "purchase")
    return report.filter(corrected).withColumns(
        {
            "conversions": F.col("conversions") + 7,
            "revenue_eur": (F.col("revenue_eur") + F.expr("100.00BD")).cast(REPORTED_AMOUNT),
        }
    )
