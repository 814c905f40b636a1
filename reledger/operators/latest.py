"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, key: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per `key`: the greatest by `newest_first`, compared column by column.

    `newest_first` starts with the version and should go on until ties can only be between
    equal rows, so that the result does not depend on how the input was read.

    Because only rank one is kept, Spark limits every group before the shuffle as well as
    after it. A key that holds a third of all rows therefore reaches its reducer as at most
    one row per input task.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.col(name).desc() for name in newest_first])
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_twice(
    df: DataFrame, key: Sequence[str], newest_first: Sequence[str], earlier: Column
) -> DataFrame:
    """Per `key` the latest version of all, `now`, and of the rows that are `earlier`, `before`.

    Both are structs of the `newest_first` columns, NULL where the key had no version. One
    grouping with partial maxima takes both, so rows are read and shuffled once.
    """
    version = F.struct(*newest_first)
    return df.groupBy(*key).agg(
        F.max(version).alias("now"), F.max(F.when(earlier, version)).alias("before")
    )
