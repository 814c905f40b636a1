"""Checks on the layers. Each returns a small DataFrame; none collects rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reledger.operators.rollup import COMPONENTS, METRICS


def require_values(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Fail the job that reads these rows as soon as one required value is NULL.

    Parquet tables accept a NULL in a NOT NULL column. Checking inside the projection costs
    no pass of its own, and a write that fails this way swaps nothing in.
    """
    types = dict(df.dtypes)

    def checked(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        failure = F.raise_error(F.lit(f"{label}: {name} is NULL")).cast(types[name])
        return F.coalesce(F.col(name), failure).alias(name)

    return df.select(*[checked(name) for name in df.columns])


def null_audit(df: DataFrame) -> DataFrame:
    """The number of NULLs per column, one row per column."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counted.unpivot([], df.columns, "column_name", "null_rows")


def grain_uniqueness(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, and whether there is exactly one row per key."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
    ).withColumn("is_unique", F.col("row_count") == F.col("key_count"))


def reconcile(left: DataFrame, right: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Component sums of two layers per group, and whether all of them agree exactly.

    Both sides go through one aggregation, so a group missing on one side shows up as a
    difference instead of dropping out of a join. Its sums there are NULL, so a group of zeros
    on the other side differs from it too.
    """
    empty = F.lit(None)

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        columns = [F.col(name).alias(f"left_{name}") if is_left else
                   empty.alias(f"left_{name}") for name in COMPONENTS]
        columns += [empty.alias(f"right_{name}") if is_left else
                    F.col(name).alias(f"right_{name}") for name in COMPONENTS]
        return df.select(*grain, *columns)

    both = side(left, True).unionByName(side(right, False))
    sums = both.groupBy(*grain).agg(
        *[F.sum(f"{prefix}_{name}").alias(f"{prefix}_{name}")
          for name in COMPONENTS for prefix in ("left", "right")]
    )
    agrees = [F.col(f"left_{name}").eqNullSafe(F.col(f"right_{name}")) for name in COMPONENTS]
    return sums.withColumn("reconciles", reduce(lambda a, b: a & b, agrees))


def object_trace(
    bronze: DataFrame, landed: DataFrame, source: str, extracted_at: Column | None = None
) -> DataFrame:
    """Per extraction and object, the rows that lie in it and the rows loaded from it.

    `landed` has one row per object that exists: `_extracted_at`, `_source_file` and its
    `landed_rows`. An object is traced if every row of it was loaded once, and every row that
    names it carries the expected source, day and an instant. An object that was never read, or
    that rows name but which does not exist, has no rows on one side and is not traced.

    Rows are first counted per file and instant: counting distinct instants over the rows
    themselves would have Spark copy each row once per distinct count.
    """
    day = F.col("_extracted_at") if extracted_at is None else extracted_at
    expected = (
        (F.col("_source") == source)
        & F.col("_extracted_at").eqNullSafe(day)
        & F.col("_ingested_at").isNotNull()
    )
    key = ["_extracted_at", "_source_file"]
    loaded = bronze.groupBy(*key, "_ingested_at").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.count_if(expected).alias("expected_rows")
    )
    none = F.lit(0).cast("bigint")
    exists = landed.select(*key, "landed_rows").withColumns(
        {"loaded_rows": none, "expected_rows": none, "_ingested_at": F.lit(None).cast("timestamp")}
    )
    both = exists.unionByName(loaded.withColumn("landed_rows", none))
    per_object = both.groupBy(*key).agg(
        *[F.sum(name).alias(name) for name in ("landed_rows", "loaded_rows", "expected_rows")],
        F.count_distinct("_ingested_at").alias("instants"),
        F.min("_ingested_at").alias("_ingested_at"),
    )
    whole = (F.col("landed_rows") == F.col("loaded_rows")) & (
        F.col("loaded_rows") == F.col("expected_rows")
    )
    return per_object.withColumn("is_traced", whole & (F.col("instants") <= 1))


def provenance(trace: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """The rows of `object_trace` summed up: rows, objects, instants, and whether all is traced."""
    unread = (F.col("loaded_rows") == 0) & (F.col("landed_rows") > 0)
    foreign = (F.col("landed_rows") == 0) & (F.col("loaded_rows") > 0)
    return trace.groupBy(*group_by).agg(
        F.sum("loaded_rows").alias("row_count"),
        F.count_if(F.col("loaded_rows") > 0).alias("file_count"),
        F.count_distinct("_ingested_at").alias("instant_count"),
        F.count_if(unread).alias("unread_count"),
        F.count_if(foreign).alias("foreign_count"),
        F.every("is_traced").alias("is_traced"),
    )


def rows_per_extraction(bronze: DataFrame) -> DataFrame:
    """Rows of every extraction: compare before and after to see neighbours untouched."""
    return bronze.groupBy("_source", "_extracted_at").agg(F.count(F.lit(1)).alias("row_count"))


def row_print(df: DataFrame, ignore: Sequence[str] = (), **replaced: Column) -> Column:
    """A 64-bit hash of the values of a row as a decimal, since sums of longs would overflow.

    A hash leaves out NULLs, so which nullable columns are NULL is hashed as well. `replaced`
    gives other values for some columns.
    """
    columns = sorted(name for name in df.columns if name not in ignore)
    nullable = {field.name for field in df.schema if field.nullable} | set(replaced)
    values = [replaced.get(name, F.col(f"`{name}`")) for name in columns]
    nulls = [
        value.isNull() for name, value in zip(columns, values, strict=True) if name in nullable
    ]
    return F.xxhash64(*values, *nulls).cast("decimal(20,0)")


def _checksum(prints: Column) -> Column:
    return F.coalesce(F.sum(prints), F.lit(0)).cast("decimal(38,0)").alias("checksum")


def fingerprint(
    df: DataFrame, ignore: Sequence[str] = (), group_by: Sequence[str] = ()
) -> DataFrame:
    """Row count and checksum of a table, or of each of its groups: blind to order, not to
    duplicates.

    Both are sums over rows, so the prints of groups add up to those of the whole, and one
    aggregation takes them all.
    """
    return df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("row_count"), _checksum(row_print(df, ignore))
    )


def fingerprint_changes(before: DataFrame, after: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Per group of two states its rows in both, and whether its print is the same.

    One aggregation over both states, the earlier one negated: a group that only one state has
    differs, and nothing is joined.
    """
    earlier = before.select(
        *group_by, F.col("row_count").alias("rows_before"), F.lit(0).alias("rows_after"),
        (-F.col("checksum")).alias("checksum"),
    )
    later = after.select(
        *group_by, F.lit(0).alias("rows_before"), F.col("row_count").alias("rows_after"), "checksum"
    )
    sums = earlier.unionByName(later).groupBy(*group_by).agg(
        F.sum("rows_before").alias("rows_before"),
        F.sum("rows_after").alias("rows_after"),
        F.sum("checksum").alias("difference"),
    )
    same = (F.col("difference") == 0) & (F.col("rows_before") == F.col("rows_after"))
    return sums.withColumn("is_same", same).drop("difference")


def fingerprint_states(
    df: DataFrame,
    states: dict[str, tuple[Column, dict[str, Column]]],
    ignore: Sequence[str] = (),
    parts: str | None = None,
) -> DataFrame:
    """The prints of several states of a table in one pass, one row a state.

    A state says how often each row counts, and which columns have other values. Summed is what
    it adds to the print of the table as it is. The state `base` is that table itself; with
    `parts`, the state `merged` is the sum of the prints of its groups by that column.
    """
    base = row_print(df, ignore)
    sums = [F.count(F.lit(1)).alias("rows"), _checksum(base).alias("print")]
    for label, (times, replaced) in states.items():
        other = row_print(df, ignore, **replaced) if replaced else base
        # Decimals of twenty digits times a count stay within thirty-eight.
        gained = other * times.cast("decimal(10,0)") - base
        sums.append(F.coalesce(F.sum(times - 1), F.lit(0)).alias(f"rows_{label}"))
        sums.append(_checksum(gained).alias(f"print_{label}"))

    def row(label: str, count: Column, checksum: Column) -> Column:
        return F.struct(
            F.lit(label).alias("state"),
            count.cast("bigint").alias("row_count"),
            checksum.cast("decimal(38,0)").alias("checksum"),
        )

    if parts is None:
        one = df.agg(*sums)
    else:
        names = [name for label in states for name in (f"rows_{label}", f"print_{label}")]
        grouped = df.rollup(parts).agg(F.grouping(parts).alias("whole"), *sums)
        whole, part = F.col("whole") == 1, F.col("whole") == 0
        one = grouped.agg(
            *[F.max(F.when(whole, F.col(name))).alias(name) for name in ("rows", "print", *names)],
            *[F.sum(F.when(part, F.col(name))).alias(f"{name}_merged") for name in ("rows", "print")],
        )
    rows = [row("base", F.col("rows"), F.col("print"))] + [
        row(label, F.col("rows") + F.col(f"rows_{label}"), F.col("print") + F.col(f"print_{label}"))
        for label in states
    ]
    if parts is not None:
        rows.append(row("merged", F.col("rows_merged"), F.col("print_merged")))
    return one.select(F.inline(F.array(*rows)))


def schema_differences(
    df: DataFrame, declared: T.StructType, forbidden: Sequence[str] = ()
) -> list[str]:
    """What keeps a report from having its declared schema; empty when it conforms."""
    actual = {field.name: field.dataType for field in df.schema}
    found = [
        f"{field.name}: missing"
        if field.name not in actual
        else f"{field.name}: {actual[field.name].simpleString()}"
        f" instead of {field.dataType.simpleString()}"
        for field in declared
        if actual.get(field.name) != field.dataType
    ]
    return found + [f"{name}: not allowed" for name in forbidden if name in actual]


def column_audit(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Per declared or found column its type, whether that is the declared one, and its values.

    A declared column that is missing has no type and no values.
    """
    wanted = {field.name: field.dataType for field in declared}
    actual = {field.name: field.dataType for field in df.schema}
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in actual])
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(actual[name].simpleString() if name in actual else None)
            .cast("string")
            .alias("found_type"),
            F.lit(actual.get(name) == wanted.get(name)).alias("conforms"),
            (F.col(f"`{name}`") if name in actual else F.lit(0).cast("bigint")).alias("filled"),
        )
        for name in [*wanted, *(name for name in actual if name not in wanted)]
    ]
    return counts.select(F.inline(F.array(*rows)))


def stores_components_only(df: DataFrame) -> bool:
    """Whether a table holds every component and none of the ratios."""
    return set(COMPONENTS) <= set(df.columns) and not set(METRICS) & set(df.columns)


def conservation(parts: DataFrame, whole: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Per group, whether the parts add up to the whole in every shared measure column."""
    measures = [name for name in whole.columns if name not in grain]
    negated = whole.select(*grain, *[(-F.col(name)).alias(name) for name in measures])
    # A group of zeros balances against nothing at all, so the sides' rows are counted as well.
    both = (
        parts.select(*grain, *measures, F.lit(1).alias("_part"), F.lit(0).alias("_whole"))
    ).unionByName(negated.withColumns({"_part": F.lit(0), "_whole": F.lit(1)}))
    sums = both.groupBy(*grain).agg(
        *[F.sum(name).alias(name) for name in (*measures, "_part", "_whole")]
    )
    present = (F.col("_part") > 0) & (F.col("_whole") > 0)
    balanced = reduce(lambda a, b: a & b, [F.col(name) == 0 for name in measures], present)
    return sums.select(*grain, balanced.alias("is_conserved"))
