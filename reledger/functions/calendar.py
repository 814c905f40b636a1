"""Calendar helpers around the month partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_MONTH = "report_month"


def report_month(day: Column) -> Column:
    """The month of a date as an int such as 202607."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def between_days(
    df: DataFrame, first: date, last: date, day_column: str = "report_date"
) -> DataFrame:
    """Rows of a day range, with the month range spelled out so that partitions prune.

    Spark cannot derive a predicate on the stored month from one on the date.
    """
    return df.filter(
        F.col(REPORT_MONTH).between(_month_of(first), _month_of(last))
        & F.col(day_column).between(F.lit(first), F.lit(last))
    )


def in_months(df: DataFrame, months: list[int] | None) -> DataFrame:
    """Rows of the given months; None means every month."""
    return df if months is None else df.filter(F.col(REPORT_MONTH).isin(months))


def _month_of(day: date) -> int:
    return day.year * 100 + day.month
