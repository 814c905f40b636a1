"""The landing area: Parquet objects grouped by source, report and extraction day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reledger.fixed_values import CAMPAIGN_DAILY_REPORT
from reledger.functions.calendar import REPORT_MONTH, report_month
from reledger.sources.footers import footers, stamped, writer_note
from reledger.sources.networks import Network
from reledger.storage import Files, shuffles_freed

LANDING_KEYS = ("source", "report", "extracted_at")

# One writer for every landed object. Row groups stay small enough to skip within a file and
# large enough to compress.
OBJECT_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.block.size": str(64 << 20),
}
LANDING_OPTIONS = {**OBJECT_OPTIONS, "partitionOverwriteMode": "dynamic"}


def extraction_prefix(landing: str, source: str, day: date | str) -> str:
    """The directory that holds every object one source published on one day."""
    return f"{landing}/source={source}/report={CAMPAIGN_DAILY_REPORT}/extracted_at={day}"


def read_extractions(
    spark: SparkSession, landing: str, network: Network, days: Sequence[date | str]
) -> DataFrame:
    """All objects of some extractions, by column name. A day without any object is an error."""
    prefixes = [extraction_prefix(landing, network.name, day) for day in days]
    return spark.read.schema(network.report_ddl).parquet(*[f"{one}/*.parquet" for one in prefixes])


def extraction_days(spark: SparkSession, landing: str, source: str) -> list[str]:
    """The days on which a source published, from a listing of its folders."""
    folder = extraction_prefix("", source, "").lstrip("/").rsplit("/", 1)[0]
    found = Files(spark, landing).matches(folder, "extracted_at=*")
    return [name.split("=", 1)[1] for name in found]


def extraction_day() -> Column:
    """The day a row's object was published, as its key says."""
    return F.regexp_extract("_metadata.file_path", "/extracted_at=([0-9-]+)/", 1).cast("date")


def object_path() -> Column:
    """The object a row was read from.

    An object written by Spark is a directory of part files; its name is the directory's.
    """
    return F.regexp_replace(F.col("_metadata.file_path"), r"(\.parquet)/[^/]+$", "$1")


def landed_objects(
    spark: SparkSession, landing: str, source: str, days: Sequence[date | str] = ("*",)
) -> DataFrame:
    """The objects that lie in the landing area: `_extracted_at`, `_source_file`, `landed_rows`.

    Counting the rows of a Parquet object reads its footers only.
    """
    prefixes = [extraction_prefix(landing, source, day) for day in days]
    rows = spark.read.parquet(*[f"{one}/*.parquet" for one in prefixes])
    key = {"_extracted_at": extraction_day(), "_source_file": object_path()}
    return rows.select(*[value.alias(name) for name, value in key.items()]).groupBy(*key).agg(
        F.count(F.lit(1)).alias("landed_rows")
    )


def to_bronze(
    report: DataFrame,
    network: Network,
    day: date | str | Column,
    source_file: Column,
    ingested_at: Column,
) -> DataFrame:
    """Report rows as Bronze rows: copied as they come, plus the technical columns."""
    columns = [name for name, _ in network.report_columns]
    return report.select(
        F.lit(network.name).alias("_source"),
        source_file.alias("_source_file"),
        (day if isinstance(day, Column) else F.lit(str(day)).cast("date")).alias("_extracted_at"),
        ingested_at.alias("_ingested_at"),
        *columns,
        report_month(F.col(network.day_column)).alias(REPORT_MONTH),
    )


def write_reports(reports: DataFrame, landing: str, source: str, *, append: bool = False) -> None:
    """Publish reports that carry an `extracted_at` column, all days in one job.

    Days present in `reports` replace what was published for them unless `append` is set. The
    rows of a day are gathered into objects of the advisory size.
    """
    with shuffles_freed(reports.sparkSession):
        (
            stamped(reports, OBJECT_OPTIONS)
            .withColumn("source", F.lit(source))
            .withColumn("report", F.lit(CAMPAIGN_DAILY_REPORT))
            .hint("rebalance", "extracted_at")
            .write.mode("append" if append else "overwrite")
            .options(**LANDING_OPTIONS)
            .partitionBy(*LANDING_KEYS)
            .parquet(landing)
        )


def write_object(rows: DataFrame, landing: str, source: str, day: date | str, name: str) -> str:
    """Publish rows as one named object of an extraction, replacing an earlier one.

    The object is a directory of part files, so its size is not bound to one task.
    """
    path = f"{extraction_prefix(landing, source, day)}/{name}.parquet"
    with shuffles_freed(rows.sparkSession):
        stamped(rows, OBJECT_OPTIONS).write.mode("overwrite").options(**OBJECT_OPTIONS).parquet(path)
    return path


def copy_object(spark: SparkSession, origin: str, target: str) -> None:
    """Copy an object to another key, replacing what was there."""
    rows = stamped(spark.read.parquet(origin), OBJECT_OPTIONS)
    rows.write.mode("overwrite").options(**OBJECT_OPTIONS).parquet(target)


def landed_files(
    spark: SparkSession,
    landing: str,
    source: str,
    options: dict[str, str] = OBJECT_OPTIONS,
    days: Sequence[date | str] = ("*",),
) -> DataFrame:
    """The files of landed objects, and whether each was written as `options` say.

    Codec and the size of the row groups are what the footers show; the level, which no footer
    holds, is what the writer noted there.
    """
    found = footers(spark, [extraction_prefix(landing, source, day) for day in days])
    as_declared = (
        (F.col("codecs") == options["compression"])
        & F.col("writer").eqNullSafe(F.lit(writer_note(options)))
        & (F.col("largest_group_bytes") <= int(options["parquet.block.size"]))
    )
    day = F.regexp_extract("path", "/extracted_at=([0-9-]+)/", 1).cast("date")
    return found.withColumns({"_extracted_at": day, "conforms": as_declared})
