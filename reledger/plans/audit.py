"""What a table held at some time, kept beside the lake and compared with what it holds now."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reledger.lake import Lake, Table
from reledger.operators.quality import fingerprint, fingerprint_changes

#: Columns that a replay fills anew.
VOLATILE = ("_ingested_at",)


def partition_prints(lake: Lake, table: Table) -> DataFrame:
    """Rows and checksum of each partition of a table, in one aggregation."""
    ignored = (*VOLATILE, *table.partitions)
    return fingerprint(lake.table(table), ignored, table.partitions)


def remember(lake: Lake, table: Table, label: str) -> None:
    """Keep the prints of a table under a label, replacing earlier ones of that name."""
    partition_prints(lake, table).write.mode("overwrite").parquet(_place(lake, table, label))


def changes_since(lake: Lake, table: Table, label: str) -> DataFrame:
    """Per partition the rows it had and has, and whether their content is the same."""
    before = lake.spark.read.parquet(_place(lake, table, label))
    return fingerprint_changes(before, partition_prints(lake, table), table.partitions)


def _place(lake: Lake, table: Table, label: str) -> str:
    return f"{lake.root}/audit/prints/table={table.layer}.{table.name}/label={label}"
