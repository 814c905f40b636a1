"""Replacing partitions: reload, failure, nothing, neighbours; attaching existing files."""

from __future__ import annotations

import glob
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reledger.fixed_values import GOOGLE_ADS
from reledger.functions.calendar import REPORT_MONTH, between_days
from reledger.lake import BASELINE, GOLD, GOOGLE_RAW, META_RAW, SILVER, TABLES, Lake
from reledger.operators.quality import fingerprint, rows_per_extraction
from reledger.plans.publish import load_baseline, reload_extraction, restate
from reledger.plans.queries import REGISTRY
from reledger.sources.landing import copy_object, extraction_prefix, write_object
from tests.conftest import DAYS, load_days


def loaded(lake):
    counts = rows_per_extraction(lake.table(GOOGLE_RAW)).collect()
    return {str(row["_extracted_at"]): row["row_count"] for row in counts}


def test_reloading_changes_nothing_and_spares_neighbours(landed):
    load_days(landed)
    bronze = landed.table(GOOGLE_RAW)
    before = fingerprint(bronze, ignore=["_ingested_at"]).collect()
    for _ in range(3):
        assert reload_extraction(landed, GOOGLE_ADS, DAYS[1]).rows == 1000
    assert loaded(landed) == dict.fromkeys(DAYS, 1000)
    day = landed.table(GOOGLE_RAW).filter(F.col("_extracted_at") == DAYS[1])
    assert day.agg(F.count_distinct("_ingested_at")).collect()[0][0] == 1
    assert fingerprint(landed.table(GOOGLE_RAW), ignore=["_ingested_at"]).collect() == before


def test_every_object_of_an_extraction_is_read(landed):
    prefix = extraction_prefix(landed.landing, GOOGLE_ADS, DAYS[2])
    (first,) = glob.glob(f"{prefix}/*.parquet")
    for _ in range(2):  # the copy replaces an earlier copy
        copy_object(landed.spark, first, f"{prefix}/part-0002.parquet")
    assert reload_extraction(landed, GOOGLE_ADS, DAYS[2]).rows == 2000
    files = landed.table(GOOGLE_RAW).select("_source_file").distinct().collect()
    assert len(files) == 2
    assert any(row[0].endswith("/part-0002.parquet") for row in files)


def test_a_failed_reload_keeps_the_old_rows(landed):
    load_days(landed)
    report = landed.spark.read.parquet(extraction_prefix(landed.landing, GOOGLE_ADS, DAYS[0]))
    broken = report.withColumn(
        "clicks", F.when(F.col("product_id") != "sku_50", F.col("clicks"))
    )
    write_object(broken, landed.landing, GOOGLE_ADS, DAYS[0], "part-0009")
    with pytest.raises(Exception, match="clicks is NULL"):
        reload_extraction(landed, GOOGLE_ADS, DAYS[0])
    assert loaded(landed) == dict.fromkeys(DAYS, 1000)


def test_an_extraction_without_objects_fails_before_it_touches_anything(landed):
    load_days(landed)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        reload_extraction(landed, GOOGLE_ADS, "2026-01-01")
    assert loaded(landed) == dict.fromkeys(DAYS, 1000)


@pytest.mark.parametrize("arguments", [("nobody", DAYS[0]), (GOOGLE_ADS, ""), ("", DAYS[0])])
def test_a_missing_or_unknown_argument_is_refused(landed, arguments):
    with pytest.raises(ValueError):
        reload_extraction(landed, *arguments)


def test_an_empty_reload_empties_its_partition_only(landed):
    load_days(landed)
    report = landed.spark.read.parquet(extraction_prefix(landed.landing, GOOGLE_ADS, DAYS[0]))
    write_object(report, landed.landing, GOOGLE_ADS, "2026-07-20", "part-0001")
    assert reload_extraction(landed, GOOGLE_ADS, "2026-07-20").rows == 1000
    write_object(report.limit(0), landed.landing, GOOGLE_ADS, "2026-07-20", "part-0001")
    reloaded = reload_extraction(landed, GOOGLE_ADS, "2026-07-20")
    assert (reloaded.rows, reloaded.months) == (0, [202607])
    assert loaded(landed) == dict.fromkeys(DAYS, 1000)
    assert restate(landed, GOOGLE_ADS, "2026-07-20").months == [202607]
    left = f"{landed.location(GOOGLE_RAW)}/**/_extracted_at=2026-07-20/*/*.parquet"
    assert not glob.glob(left, recursive=True)
    assert landed.partitions(GOOGLE_RAW, {"_extracted_at": "2026-07-20"}) == []


def test_another_session_catalog_sees_what_is_stored(landed):
    load_days(landed)
    again = Lake(landed.spark, landed.root, prefix=f"again_{landed.prefix}")
    again.ensure_tables()
    again.ensure_tables()
    assert again.table(GOOGLE_RAW).count() == 3000
    assert again.table(META_RAW).count() == 30
    assert sorted(map(str, again.partitions(GOOGLE_RAW))) == sorted(
        map(str, landed.partitions(GOOGLE_RAW))
    )


def test_definitions_converge(empty_lake):
    def defined():
        layers = ("bronze", "silver", "gold")
        return {
            (layer, table.name)
            for layer in layers
            for table in empty_lake.spark.catalog.listTables(empty_lake.database(layer))
        }

    first = defined()
    empty_lake.ensure_tables()
    assert defined() == first
    assert len(first) == len(TABLES) + 1  # and the view
    types = dict(empty_lake.table(GOOGLE_RAW).dtypes)
    assert types["cost_micros"] == "bigint" and types["segments_date"] == "date"
    assert types["revenue_eur"] == "decimal(18,2)"


def test_the_baseline_is_reproducible(empty_lake):
    load_baseline(empty_lake)
    first = fingerprint(empty_lake.table(BASELINE)).collect()
    load_baseline(empty_lake)
    assert fingerprint(empty_lake.table(BASELINE)).collect() == first
    sums = empty_lake.table(BASELINE).agg(
        F.count(F.lit(1)), F.sum("cost_micros"), F.sum("clicks"), F.sum("impressions"),
        F.sum("conversions"),
    )
    assert tuple(map(int, sums.collect()[0])) == (30, 465_000_000, 4350, 435_000, 435)


def test_truncate_and_clone(landed):
    load_days(landed)
    clone = landed.clone_structure(GOOGLE_RAW, "google_ads_raw_copy")
    assert landed.spark.table(clone).schema == landed.table(GOOGLE_RAW).schema
    assert landed.spark.table(clone).count() == 0
    landed.truncate(GOOGLE_RAW)
    assert landed.table(GOOGLE_RAW).count() == 0 and landed.partitions(GOOGLE_RAW) == []
    assert not glob.glob(f"{landed.location(GOOGLE_RAW)}/**/*.parquet", recursive=True)
    assert landed.table(META_RAW).count() == 30


def test_round_trip_of_a_thousand_rows(empty_lake):
    spark = empty_lake.spark
    name = f"{empty_lake.database('gold')}.witness"
    spark.sql(f"CREATE TABLE {name} (n BIGINT) USING parquet LOCATION '{empty_lake.root}/w'")
    spark.range(1000).write.insertInto(name)
    assert spark.table(name).groupBy().sum("n").collect()[0][0] == 499500
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_day_filter_prunes_months(published):
    days = between_days(published.table(GOLD), date(2026, 7, 14), date(2026, 7, 15))
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_month" in plan
    assert days.count() == 40


def test_a_hot_month_is_written_by_several_tasks(empty_lake):
    """One month with nearly all rows must not end up in one task when rebalanced."""
    spark = empty_lake.spark
    rows = spark.range(0, 300_000, 1, 8).select(
        F.lit("google_ads").alias("source"),
        F.col("id").cast("string").alias("account_id"),
        F.to_date(F.lit("2026-01-01")).alias("report_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("campaign_id"),
        F.lit("p").alias("product_id"),
        F.lit(1).cast("decimal(18,6)").alias("spend_eur"),
        *[F.col("id").alias(name) for name in ("clicks", "impressions", "conversions")],
        F.lit(1).cast("decimal(18,6)").alias("revenue_eur"),
        F.to_date(F.lit("2026-01-02")).alias("_extracted_at"),
        F.when(F.col("id") % 100 == 0, 202512).otherwise(202601).alias(REPORT_MONTH),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    normal = spark.conf.get(key)
    spark.conf.set(key, "2m")
    try:
        written = empty_lake.replace_partitions(SILVER, rows, [])
    finally:
        spark.conf.set(key, normal)
    months = sorted(spec[REPORT_MONTH] for spec in written.written)
    assert (written.rows, months, written.emptied) == (300_000, ["202512", "202601"], [])
    assert empty_lake.table(SILVER).count() == 300_000
    files = glob.glob(f"{empty_lake.location(SILVER)}/**/*.parquet", recursive=True)
    hot = [name for name in files if "/report_month=202601/" in name]
    cold = [name for name in files if "/report_month=202512/" in name]
    assert len(hot) > 3 and len(cold) == 1


def test_silver_files_are_sorted_by_key(published):
    key = ["source", "account_id", "report_date", "campaign_id", "product_id"]
    names = glob.glob(f"{published.location(SILVER)}/**/*.parquet", recursive=True)
    assert names
    for name in names:
        frame = pq.ParquetFile(name).read(columns=key).to_pandas()
        assert frame.equals(frame.sort_values(key, kind="stable").reset_index(drop=True))


def test_baseline_totals_beyond_64_bits_are_whole(spark, tmp_path):
    first = 20_000_000_000
    spark.range(first, first + 600).toDF("o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    (totals,) = REGISTRY["baseline_reload"](spark, str(tmp_path)).collect()
    numbers = range(first, first + 600)
    assert int(totals["cost_micros"]) == sum((n + 1) * 1_000_000 for n in numbers) > 1 << 63
    assert (totals["row_count"], totals["clicks"]) == (600, sum(n * 10 for n in numbers))


def test_baseline_totals_that_fit_are_longs(spark, tmp_path):
    spark.range(30).toDF("o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    assert {kind for _, kind in REGISTRY["baseline_reload"](spark, str(tmp_path)).dtypes} == {"bigint"}
