"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("dec", str(value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    names = [columns[position] for position in order]
    return names, Counter(tuple(_value(row[position]) for position in order) for row in rows)


def compare(spark_df, connection, sql: str) -> tuple[int, str]:
    """Rows compared, and a description of the first difference (empty when equal)."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected_names, expected = rows_of(names, result.fetchall())
    got_names, got = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if got_names != expected_names:
        return 0, f"columns {got_names} instead of {expected_names}"
    missing, extra = expected - got, got - expected
    if missing or extra:
        return sum(got.values()), (
            f"{sum(missing.values())} missing e.g. {next(iter(missing), None)}; "
            f"{sum(extra.values())} extra e.g. {next(iter(extra), None)}"
        )
    return sum(got.values()), ""
