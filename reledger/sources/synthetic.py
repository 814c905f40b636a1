"""Synthetic reports, generated by tasks that share nothing but a seed.

Every draw is a hash of the seed and of what is drawn for, so a report comes out the same
however many tasks build it. Rows are decoded from a range of numbers: no join, no shuffle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reledger import fixed_values as fixed
from reledger.functions.money import cents_to_amount
from reledger.sources.landing import write_reports

CAMPAIGN_DAY_KEYS = ("account_id", "campaign_id", "report_date")


def account_name(number: Column) -> Column:
    return F.format_string("acct_%02d", number)


def campaign_name(number: Column) -> Column:
    return F.format_string("camp_%03d", number)


def campaign_days(
    spark: SparkSession,
    *,
    first_day: date = fixed.FIRST_REPORT_DAY,
    days: int = fixed.REPORT_DAY_COUNT,
    accounts: int = fixed.ACCOUNT_COUNT,
    campaigns: int = fixed.CAMPAIGN_COUNT,
    tasks: int | None = None,
) -> DataFrame:
    """One row per account, campaign and day, in day order."""
    number = F.col("id")
    decoded = {
        "account_id": account_name(F.expr(f"id div {campaigns}") % accounts + 1),
        "campaign_id": campaign_name(number % campaigns + 1),
        "report_date": F.date_add(
            F.lit(first_day), F.expr(f"id div {accounts * campaigns}").cast("int")
        ),
    }
    rows = spark.range(0, days * accounts * campaigns, 1, tasks)
    return rows.select(*[value.alias(name) for name, value in decoded.items()])


def share_points(
    days: DataFrame, seed: int, *, products: int = fixed.PRODUCT_COUNT
) -> DataFrame:
    """Split the points of each campaign-day over the products.

    The flagship has a fixed share; the other points are dealt one by one to the others.
    """
    if products <= fixed.FLAGSHIP_PRODUCT:
        raise ValueError(f"product {fixed.FLAGSHIP_PRODUCT} must be one of {products}")
    others = products - 1
    dealt = fixed.SHARE_POINTS - fixed.FLAGSHIP_POINTS
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(dealt - 1)),
        lambda draw: F.pmod(
            F.xxhash64(F.lit(seed), *CAMPAIGN_DAY_KEYS, draw), F.lit(others)
        ).cast("int"),
    )
    # One histogram a campaign-day: each draw raises its own entry, products are not searched.
    won = F.aggregate(
        draws,
        F.array_repeat(F.lit(0), others),
        lambda points, draw: F.concat(
            F.slice(points, F.lit(1), draw),
            F.array(F.get(points, draw) + 1),
            F.slice(points, draw + 2, F.lit(others)),
        ),
    )
    # The others are numbered without the flagship.
    before = F.slice("won", 1, fixed.FLAGSHIP_PRODUCT)
    after = F.slice("won", fixed.FLAGSHIP_PRODUCT + 1, others)
    points = F.concat(before, F.array(F.lit(fixed.FLAGSHIP_POINTS)), after)
    # The explode of a single array keeps the histogram from being folded into every product row.
    drawn = days.select("*", F.explode(F.array(won)).alias("won"))
    return drawn.select(*days.columns, F.posexplode(points).alias("n", "points")).select(
        *days.columns, F.format_string("sku_%02d", "n").alias("product_id"), "points"
    )


def slice_of(whole: str | int) -> Column:
    """The part of a whole number owed to the `points` of a row, rounded down."""
    return F.expr(f"cast({whole} as bigint) * points div {fixed.SHARE_POINTS}")


def google_reports(
    days: DataFrame, seed: int = fixed.DEFAULT_SEED, *, products: int = fixed.PRODUCT_COUNT
) -> DataFrame:
    """Reports in micro-units, one row per product of every campaign-day."""
    return share_points(days, seed, products=products).select(
        "account_id",
        "campaign_id",
        "product_id",
        F.col("report_date").alias("segments_date"),
        slice_of(fixed.GOOGLE_COST_MICROS).alias("cost_micros"),
        slice_of(fixed.GOOGLE_CLICKS).alias("clicks"),
        slice_of(fixed.GOOGLE_IMPRESSIONS).alias("impressions"),
        slice_of(fixed.GOOGLE_CONVERSIONS).alias("conversions"),
        cents_to_amount(slice_of(fixed.GOOGLE_REVENUE_CENTS)).alias("revenue_eur"),
    )


def scale_factor(seed: int) -> Column:
    """How many times the pivot a campaign-day is worth; the pivot itself counts once."""
    drawn = F.pmod(
        F.xxhash64(F.lit(seed), *CAMPAIGN_DAY_KEYS), F.lit(fixed.LARGEST_SCALE_FACTOR)
    )
    is_pivot = (
        (F.col("account_id") == fixed.PIVOT_ACCOUNT)
        & (F.col("campaign_id") == fixed.PIVOT_CAMPAIGN)
        & (F.col("report_date") == F.lit(fixed.PIVOT_REPORT_DAY))
    )
    return F.when(is_pivot, F.lit(1)).otherwise(drawn + 1).cast("bigint")


def meta_reports(days: DataFrame, seed: int = fixed.DEFAULT_SEED) -> DataFrame:
    """Reports in currency, one row per campaign-day and no product."""
    scaled = days.withColumn("factor", scale_factor(seed))
    return scaled.select(
        "account_id",
        "campaign_id",
        F.col("report_date").alias("date_start"),
        cents_to_amount(F.col("factor") * fixed.META_SPEND_CENTS).alias("spend"),
        (F.col("factor") * fixed.META_CLICKS).alias("clicks"),
        (F.col("factor") * fixed.META_IMPRESSIONS).alias("impressions"),
        (F.col("factor") * fixed.META_CONVERSIONS).alias("conversions"),
        cents_to_amount(F.col("factor") * fixed.META_REVENUE_CENTS).alias("revenue_eur"),
    )


def restatement(reports: DataFrame) -> DataFrame:
    """The late correction of the flagship row: two figures change, the others stay."""
    return reports.filter(
        (F.col("account_id") == fixed.PIVOT_ACCOUNT)
        & (F.col("campaign_id") == fixed.PIVOT_CAMPAIGN)
        & (F.col("product_id") == f"sku_{fixed.FLAGSHIP_PRODUCT}")
        & (F.col("segments_date") == F.lit(fixed.PIVOT_REPORT_DAY))
    ).withColumns(
        {
            "conversions": F.lit(fixed.RESTATED_CONVERSIONS).cast("bigint"),
            "revenue_eur": cents_to_amount(F.lit(fixed.RESTATED_REVENUE_CENTS)),
        }
    )


def write_fixture(spark: SparkSession, landing: str, seed: int = fixed.DEFAULT_SEED) -> None:
    """Publish three days of both sources and the late correction of one of them."""
    days = campaign_days(spark, tasks=1)
    google = google_reports(days, seed)
    write_reports(published_next_day(google, "segments_date"), landing, fixed.GOOGLE_ADS)
    write_reports(
        published_next_day(meta_reports(days, seed), "date_start"), landing, fixed.META_ADS
    )
    late = F.lit(fixed.RESTATEMENT_EXTRACTION_DAY)
    write_reports(
        restatement(google).withColumn("extracted_at", late), landing, fixed.GOOGLE_ADS
    )


def published_next_day(reports: DataFrame, day_column: str) -> DataFrame:
    """Stamp reports with the extraction day their network publishes them on."""
    return reports.withColumn(
        "extracted_at", F.date_add(day_column, fixed.EXTRACTION_LAG_DAYS)
    )


def baseline_rows(numbers: DataFrame) -> DataFrame:
    """Baseline Bronze rows from a column `n` of whole numbers; no clock, no chance."""
    return numbers.select(
        F.lit(fixed.GOOGLE_ADS).alias("_source"),
        F.lit(fixed.BASELINE_SOURCE_FILE).alias("_source_file"),
        F.to_date(F.lit(fixed.BASELINE_EXTRACTED_AT)).alias("_extracted_at"),
        F.to_timestamp(F.lit(fixed.BASELINE_INGESTED_AT)).alias("_ingested_at"),
        account_name(F.col("n") % fixed.ACCOUNT_COUNT + 1).alias("account_id"),
        campaign_name(
            F.expr(f"n div {fixed.ACCOUNT_COUNT}") % fixed.CAMPAIGN_COUNT + 1
        ).alias("campaign_id"),
        F.date_add(
            F.lit(fixed.FIRST_REPORT_DAY),
            F.expr(f"cast(n div {fixed.ACCOUNT_COUNT * fixed.CAMPAIGN_COUNT} as int)"),
        ).alias("report_date"),
        ((F.col("n") + 1) * 1_000_000).cast("bigint").alias("cost_micros"),
        (F.col("n") * 10).cast("bigint").alias("clicks"),
        (F.col("n") * 1000).cast("decimal(20,0)").alias("impressions"),
        F.col("n").cast("bigint").alias("conversions"),
    )
