"""Exact decimal money. No float appears on any path from a report to a metric.

Each formula is written once, as a SQL expression, so that the DataFrame operators and the
stored metrics view share it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reledger.fixed_values import (
    CONFORMED_AMOUNT,
    MICROS_PER_UNIT,
    REPORTED_AMOUNT,
    ROAS_TYPE,
)


def micros_to_amount_sql(micros: str) -> str:
    """Whole micro-units as an exact amount; beyond 10^12 units the cast raises."""
    return f"cast(cast({micros} as decimal(19,0)) * 0.000001BD as {CONFORMED_AMOUNT})"


def truncated_ratio_sql(numerator: str, denominator: str) -> str:
    """`numerator / denominator` to six digits, further digits dropped; NULL over zero.

    `div` on whole micro-units truncates towards zero and stays in long arithmetic, where
    a decimal division would carry 38 digits and round on the way back.
    """
    micros = f"cast(cast({numerator} as {CONFORMED_AMOUNT}) * {MICROS_PER_UNIT} as bigint)"
    return micros_to_amount_sql(f"({micros} div nullif({denominator}, 0))")


def rounded_ratio_sql(numerator: str, denominator: str) -> str:
    """`numerator / denominator` rounded half away from zero to four digits; NULL over zero."""
    return f"cast(round({numerator} / nullif({denominator}, 0), 4) as {ROAS_TYPE})"


def micros_to_amount(column: str) -> Column:
    """Column form of `micros_to_amount_sql`."""
    return F.expr(micros_to_amount_sql(column))


def truncated_ratio(numerator: str, denominator: str) -> Column:
    """Column form of `truncated_ratio_sql`."""
    return F.expr(truncated_ratio_sql(numerator, denominator))


def rounded_ratio(numerator: str, denominator: str) -> Column:
    """Column form of `rounded_ratio_sql`."""
    return F.expr(rounded_ratio_sql(numerator, denominator))


def cents_to_amount(cents: Column) -> Column:
    """Whole cents as an exact amount with two digits."""
    return (cents.cast("decimal(18,0)") * F.expr("0.01BD")).cast(REPORTED_AMOUNT)


def amount_text(amount: Column) -> Column:
    """An amount as text that keeps every digit of its scale: `12345.000000`."""
    return amount.cast("string")
