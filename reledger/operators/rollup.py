"""Sums of components at a grain, and the ratios derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reledger.functions.calendar import REPORT_MONTH, report_month
from reledger.functions.money import rounded_ratio_sql, truncated_ratio_sql

COMPONENTS = ("spend_eur", "clicks", "impressions", "conversions", "revenue_eur")
AMOUNTS = ("spend_eur", "revenue_eur")
CAMPAIGN_DAY = ("source", "account_id", "campaign_id", "report_date")

METRICS = {
    "roas": rounded_ratio_sql("revenue_eur", "spend_eur"),
    "cpa": truncated_ratio_sql("spend_eur", "conversions"),
    "ctr": truncated_ratio_sql("clicks", "impressions"),
    "cpc": truncated_ratio_sql("spend_eur", "clicks"),
}


def total(component: str):
    """The sum of a component in the type the component is stored with."""
    summed = F.sum(component)
    if component in AMOUNTS:
        summed = summed.cast("decimal(18,6)")
    return summed.alias(component)


def sum_components(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The five components summed per `grain`.

    Partial sums are taken before the shuffle, so a hot group arrives as one row per task.
    """
    return df.groupBy(*grain).agg(*[total(component) for component in COMPONENTS])


def campaign_daily(silver: DataFrame) -> DataFrame:
    """The campaign-day table: components only, never a ratio."""
    return sum_components(silver, CAMPAIGN_DAY).withColumn(
        REPORT_MONTH, report_month(F.col("report_date"))
    )


def with_metrics(df: DataFrame) -> DataFrame:
    """Add the ratios of the summed components of each row, whatever its grain."""
    return df.select("*", *[F.expr(sql).alias(name) for name, sql in METRICS.items()])


def metrics_select_sql(table: str, columns: Sequence[str]) -> str:
    """The same ratios as the text of a view over `table`."""
    ratios = [f"{sql} AS {name}" for name, sql in METRICS.items()]
    return f"SELECT {', '.join([*columns, *ratios])} FROM {table}"


def change_between(before: DataFrame, after: DataFrame, grain: Sequence[str]) -> DataFrame:
    """What each component gained from `before` to `after`, where anything changed.

    One aggregation over both sides, the earlier one negated: rows present on one side only
    count in full, and no join is needed. `row_change` is the rows gained, so a group of zeros
    that appeared or vanished shows up as well.
    """
    negated = before.select(
        *grain, *[(-F.col(name)).alias(name) for name in COMPONENTS], F.lit(-1).alias("_sign")
    )
    signed = after.select(*grain, *COMPONENTS, F.lit(1).alias("_sign")).unionByName(negated)
    changed = F.col("row_change") != 0
    for name in COMPONENTS:
        changed = changed | (F.col(name) != 0)
    return (
        signed.groupBy(*grain)
        .agg(*[total(name) for name in COMPONENTS], F.sum("_sign").alias("row_change"))
        .filter(changed)
    )


def change_of_versions(versions: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The same change where each row holds both versions, the structs `before` and `now`."""

    def gained(name: str):
        now, before = (F.coalesce(F.sum(f"{side}.{name}"), F.lit(0)) for side in ("now", "before"))
        change = now - before
        return (change.cast("decimal(18,6)") if name in AMOUNTS else change).alias(name)

    exists = [(F.count(side) > 0).cast("bigint") for side in ("now", "before")]
    changed = F.col("row_change") != 0
    for name in COMPONENTS:
        changed = changed | (F.col(name) != 0)
    return (
        versions.groupBy(*grain)
        .agg(*[gained(name) for name in COMPONENTS], (exists[0] - exists[1]).alias("row_change"))
        .filter(changed)
    )
