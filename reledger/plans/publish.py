"""Reload an extraction, publish the months it touched.

Silver is a pure function of Bronze and Gold one of Silver: a month is always recomputed
from its rows, never adjusted by a difference, so a corrected file replaces what it corrects
and a replay changes nothing. For the same reason no file is ever skipped as already seen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reledger.fixed_values import BASELINE_ROWS
from reledger.functions.calendar import REPORT_MONTH, in_months
from reledger.lake import BASELINE, GOLD, SILVER, Lake, Table
from reledger.operators.latest import latest_wins
from reledger.operators.quality import require_values
from reledger.operators.rollup import COMPONENTS, campaign_daily
from reledger.sources.landing import (
    extraction_day,
    object_path,
    read_extractions,
    to_bronze,
)
from reledger.sources.networks import conform, network_named, networks
from reledger.sources.synthetic import baseline_rows

BUSINESS_KEY = ("source", "account_id", "report_date", "campaign_id", "product_id")
# The month follows from the report date, so it adds nothing to the key.
WINDOW_KEY = (REPORT_MONTH, *BUSINESS_KEY)
# After the version come the columns that make the order total.
NEWEST_FIRST = ("_extracted_at", "_ingested_at", "_object", *COMPONENTS)
# Stored rows that one job of a publication takes; its shuffles are about ten times as large.
SLICE_BYTES_PER_CORE = 64 << 20


@dataclass(frozen=True)
class Reload:
    """What a reload left: the rows loaded, the months it held before or holds now, and the
    partitions that only record that it once held a month."""

    rows: int
    months: list[int]
    emptied: list[dict[str, str]]


def reload_extractions(lake: Lake, source: str, days: Iterable[date | str]) -> Reload:
    """Rebuild some extractions of one source from all their objects, in one load.

    Day and object of a row come from the path it was read from, and one write replaces all
    days, so the number of jobs does not depend on theirs. The rows are gathered by day and
    month on their way into files, and a hot month is split over several tasks. The old rows
    stay in place until every task has succeeded; then all days change at once. Loading once or
    many times leaves the same rows; other extractions are not read or written.
    """
    network = network_named(source)
    days = sorted({date.fromisoformat(str(day)) for day in days})
    if not days:
        raise ValueError("no extraction day was given")
    rows = to_bronze(
        read_extractions(lake.spark, lake.landing, network, days),
        network,
        extraction_day(),
        source_file=object_path(),
        ingested_at=F.date_trunc("second", F.current_timestamp()),
    )
    required = [name for name, _ in network.report_columns] + ["_extracted_at"]

    wanted = {day.isoformat() for day in days}
    leading = {"_source": source} | ({"_extracted_at": min(wanted)} if len(wanted) == 1 else {})
    held = lake.partitions(network.bronze, leading)
    before = [spec for spec in held if spec["_extracted_at"] in wanted]
    label = f"{source} {days[0]}" + (f" to {days[-1]}" if len(days) > 1 else "")
    replaced = lake.replace_partitions(
        network.bronze, require_values(rows, required, label), before
    )
    months = {int(spec[REPORT_MONTH]) for spec in before + replaced.written}
    return Reload(replaced.rows, sorted(months), replaced.emptied)


def reload_extraction(lake: Lake, source: str, day: date | str) -> Reload:
    """Rebuild one extraction; see `reload_extractions`."""
    return reload_extractions(lake, source, [day])


def latest_version(conformed: DataFrame) -> DataFrame:
    """Conformed rows reduced to the latest version of each business key."""
    latest = latest_wins(conformed, WINDOW_KEY, NEWEST_FIRST)
    return latest.drop("_ingested_at", "_object")


def silver_rows(lake: Lake, months: list[int] | None = None) -> DataFrame:
    """What Silver should hold: every source conformed, one row per business key.

    The month filter reaches the Bronze partitions before anything is read.
    """
    conformed = None
    for network in networks().values():
        rows = conform(network, in_months(lake.table(network.bronze), months))
        # Checked before the window: a check on its output would hide that it is in order.
        rows = require_values(rows, [name for name, _ in SILVER.columns], "silver")
        conformed = rows if conformed is None else conformed.unionByName(rows)
    return latest_version(conformed)


def month_slices(lake: Lake, tables: Sequence[Table], months: list[int]) -> list[list[int]]:
    """Months in runs that one job can publish: small ones together, none cut.

    A job keeps its shuffles on disk until it ends, so all months at once would take several
    times the table. A run holds at most so much of the stored tables as keeps every core busy.
    """
    limit = SLICE_BYTES_PER_CORE * lake.spark.sparkContext.defaultParallelism
    if len(months) < 2 or sum(lake.stored_bytes(one, months) for one in tables) <= limit:
        return [months]
    half = len(months) // 2
    return [
        run
        for part in (months[:half], months[half:])
        for run in month_slices(lake, tables, part)
    ]


def build_silver(lake: Lake, months: list[int] | None = None) -> list[int]:
    """Rebuild Silver for the given months, or for all; return the months in scope."""
    stored = [network.bronze for network in networks().values()]
    if months is None:
        held = {month for table in stored for month in lake.months(table)}
        months = sorted(held | set(lake.months(SILVER)))
    slices = month_slices(lake, stored, months)
    _replace_months(lake, SILVER, (silver_rows(lake, some) for some in slices), months)
    return months


def build_gold(lake: Lake, months: list[int] | None = None) -> list[int]:
    """Rebuild Gold for the given months, or for those in Silver.

    Months outside the scope keep whatever they hold.
    """
    if months is None:
        months = lake.months(SILVER)
    slices = month_slices(lake, [SILVER], months)
    silver = (in_months(lake.table(SILVER), some) for some in slices)
    _replace_months(lake, GOLD, map(campaign_daily, silver), months)
    return months


def publish(lake: Lake, months: list[int] | None = None) -> list[int]:
    """Rebuild Silver, then Gold from the Silver just written."""
    return build_gold(lake, build_silver(lake, months))


def restate_days(lake: Lake, source: str, days: Iterable[date | str]) -> Reload:
    """Reload some extractions and publish the months they touched, and only those.

    Months they held before count too: a key may have moved to another month or vanished. A
    restatement that fails anywhere can simply be run again.
    """
    reloaded = reload_extractions(lake, source, days)
    publish(lake, reloaded.months)
    lake.drop_partitions(network_named(source).bronze, reloaded.emptied)
    return reloaded


def restate(lake: Lake, source: str, day: date | str) -> Reload:
    """Reload one extraction and publish the months it touched; see `restate_days`."""
    return restate_days(lake, source, [day])


def load_baseline(lake: Lake) -> None:
    """Load the deterministic baseline rows, replacing what the table holds."""
    lake.truncate(BASELINE)
    numbers = lake.spark.range(0, BASELINE_ROWS, 1, 1).withColumnRenamed("id", "n")
    lake.append(BASELINE, baseline_rows(numbers))


def _replace_months(
    lake: Lake, table: Table, rows: Iterable[DataFrame], months: list[int]
) -> None:
    wanted = set(months)
    scope = [spec for spec in lake.partitions(table) if int(spec[REPORT_MONTH]) in wanted]
    replaced = lake.replace_partitions(table, rows, scope)
    lake.drop_partitions(table, replaced.emptied)
