"""Commits of a table: many days at once, merging, statements of others, other catalogs."""

from __future__ import annotations

import glob
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

import reledger.lake
import reledger.plans.publish
from reledger.fixed_values import GOOGLE_ADS, META_ADS
from reledger.lake import GOLD, GOOGLE_RAW, META_RAW, SILVER, Lake
from reledger.plans.publish import publish, reload_extraction, reload_extractions, restate_days
from reledger.sources.landing import extraction_days, write_reports
from reledger.sources.synthetic import campaign_days, meta_reports, published_next_day
from reledger.storage import FREE_SHUFFLES
from tests.conftest import DAYS, RESTATED


def test_some_days_in_one_load(landed):
    assert extraction_days(landed.spark, landed.landing, GOOGLE_ADS) == [*DAYS, RESTATED]
    reloaded = reload_extractions(landed, GOOGLE_ADS, [*DAYS, RESTATED, DAYS[0]])
    assert (reloaded.rows, reloaded.months, reloaded.emptied) == (3001, [202607], [])
    counts = landed.table(GOOGLE_RAW).groupBy("_extracted_at").count().collect()
    assert {str(row[0]): row[1] for row in counts} == {**dict.fromkeys(DAYS, 1000), RESTATED: 1}
    days = landed.table(GOOGLE_RAW).filter(
        ~F.col("_source_file").contains(F.concat(F.lit("/extracted_at="), "_extracted_at", F.lit("/")))
    )
    assert days.count() == 0
    again = reload_extractions(landed, GOOGLE_ADS, DAYS[1:])
    assert again.rows == 2000 and landed.table(GOOGLE_RAW).count() == 3001
    for wrong in ([], [DAYS[0], "2026-01-01"], ["yesterday"]):
        with pytest.raises(Exception, match="no extraction|PATH_NOT_FOUND|isoformat"):
            reload_extractions(landed, GOOGLE_ADS, wrong)
    assert landed.table(GOOGLE_RAW).count() == 3001


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_the_number_of_jobs_does_not_depend_on_the_days(empty_lake):
    spark = empty_lake.spark
    reports = meta_reports(campaign_days(spark, first_day=date(2026, 1, 1), days=120))
    write_reports(published_next_day(reports, "date_start"), empty_lake.landing, META_ADS)
    days = extraction_days(spark, empty_lake.landing, META_ADS)
    assert len(days) == 120

    def jobs(label, some):
        return jobs_of(spark, label, lambda: restate_days(empty_lake, META_ADS, some))

    few, many = jobs("few", days[:40]), jobs("many", days)
    assert few == many
    assert empty_lake.table(SILVER).count() == 1200
    assert empty_lake.months(GOLD) == [202601, 202602, 202603, 202604]


def commits(lake, table):
    return sorted(glob.glob(f"{lake.location(table)}/_commits/0*"))


def test_commits_are_merged_and_another_catalog_reads_them(landed, monkeypatch):
    monkeypatch.setattr(reledger.lake, "MERGED_COMMITS", 3)
    for _ in range(3):
        for day in DAYS:
            reload_extraction(landed, GOOGLE_ADS, day)
    assert len(commits(landed, GOOGLE_RAW)) <= 4
    assert len(glob.glob(f"{landed.location(GOOGLE_RAW)}/_loads/*")) == 3
    again = Lake(landed.spark, landed.root, prefix=f"again_{landed.prefix}")
    again.ensure_tables()
    assert again.table(GOOGLE_RAW).count() == landed.table(GOOGLE_RAW).count() == 3000
    # What one catalog loads, the other sees.
    reload_extraction(again, GOOGLE_ADS, RESTATED)
    reload_extraction(landed, META_ADS, DAYS[0])
    assert landed.table(GOOGLE_RAW).count() == 3001 and again.table(META_RAW).count() == 10


def test_rows_that_a_statement_adds_to_a_dropped_month_stay(landed):
    reload_extraction(landed, META_ADS, DAYS[0])
    publish(landed)
    add = (
        f"INSERT INTO {landed.name(GOLD)} VALUES"
        " ('probe', 'a', 'c', DATE'2026-01-01', 0, 0, 0, 0, 0, 202601)"
    )
    landed.spark.sql(add)
    landed.drop_partitions(GOLD, [{"report_month": "202601"}])
    assert landed.months(GOLD) == [202607]
    landed.spark.sql(add)
    again = Lake(landed.spark, landed.root, prefix=f"again_{landed.prefix}")
    again.ensure_tables()
    for lake in (landed, again):
        assert lake.months(GOLD) == [202601, 202607]
        assert lake.table(GOLD).filter("source = 'probe'").count() == 1


def test_a_failed_write_leaves_no_folder(landed):
    reload_extraction(landed, META_ADS, DAYS[0])
    broken = landed.table(META_RAW).withColumn("clicks", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        landed.replace_partitions(META_RAW, broken, landed.partitions(META_RAW))
    assert len(glob.glob(f"{landed.location(META_RAW)}/_loads/*")) == 1
    assert landed.table(META_RAW).count() == 10


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_loads_leave_no_shuffle_files(landed, monkeypatch):
    """The disk of the executors holds the shuffles of one load, not those of the whole flow."""
    spark, commit, left = landed.spark, Lake._commit, []

    def looked(lake, table, placed, dropped):
        until = time.monotonic() + 5  # they are deleted in the background
        while (found := shuffle_files(spark) - before) and time.monotonic() < until:
            time.sleep(0.1)
        left.append(len(found))
        commit(lake, table, placed, dropped)

    before = shuffle_files(spark)
    monkeypatch.setattr(Lake, "_commit", looked)
    reload_extractions(landed, GOOGLE_ADS, DAYS)
    publish(landed)
    restate_days(landed, GOOGLE_ADS, [RESTATED])
    assert left == [0] * 6 and spark.conf.get(FREE_SHUFFLES, None) is None
    broken = landed.table(GOLD).withColumn("clicks", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        landed.replace_partitions(GOLD, broken, [])
    assert spark.conf.get(FREE_SHUFFLES, None) is None
    assert landed.table(GOLD).count() == 30


def by_month(lake, table):
    counts = lake.table(table).groupBy("report_month").agg(F.count(F.lit(1)), F.sum("clicks"))
    return sorted(map(tuple, counts.collect()))


def test_a_large_publication_is_written_in_slices_of_months(empty_lake, monkeypatch):
    """Only the shuffles of one slice are on disk at a time; all slices are one commit."""
    spark = empty_lake.spark
    reports = meta_reports(campaign_days(spark, first_day=date(2026, 1, 1), days=150))
    write_reports(published_next_day(reports, "date_start"), empty_lake.landing, META_ADS)
    days = extraction_days(spark, empty_lake.landing, META_ADS)
    restate_days(empty_lake, META_ADS, days)
    whole = [by_month(empty_lake, table) for table in (SILVER, GOLD)]
    assert [row[1] for row in whole[0]] == [310, 280, 310, 300, 300]

    write, wrote = Lake._write, []

    def counted(lake, table, rows, folder):
        wrote.append((table.name, write(lake, table, rows, folder)))
        return wrote[-1][1]

    monkeypatch.setattr(Lake, "_write", counted)
    months = [202601, 202602, 202603, 202604, 202605]
    size = empty_lake.stored_bytes(META_RAW, months)
    assert size == sum(empty_lake.stored_bytes(META_RAW, [month]) for month in months) > 0
    monkeypatch.setattr(reledger.plans.publish, "SLICE_BYTES_PER_CORE", 1)
    assert publish(empty_lake) == months
    slices = [310, 280, 310, 300, 300]
    assert wrote == [(table.name, rows) for table in (SILVER, GOLD) for rows in slices]
    assert [by_month(empty_lake, table) for table in (SILVER, GOLD)] == whole
    assert empty_lake.remove_abandoned(SILVER) == [] and len(commits(empty_lake, SILVER)) == 2

    def second_fails(lake, table, rows, folder):
        if any(name == table.name for name, _ in wrote):
            raise RuntimeError("the second slice failed")
        return counted(lake, table, rows, folder)

    wrote.clear()
    monkeypatch.setattr(Lake, "_write", second_fails)
    with pytest.raises(RuntimeError, match="second slice"):
        publish(empty_lake)
    assert len(wrote) == 1 and empty_lake.remove_abandoned(SILVER) == []
    assert [by_month(empty_lake, table) for table in (SILVER, GOLD)] == whole
