"""A SparkSession with the settings this library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Skew splitting and file-size balancing of the rebalanced writes rely on AQE.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Aim at the advisory size instead of at many small tasks: it is also the file size.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # AQE joins small reducers but splits none under a window, so start with many of them:
    # 4,096 reducers of the advisory size hold 512 GB of one shuffle. Raise it for larger ones.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "reledger",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
