"""Audits turn false when something is wrong: prints, lineage, files, catalog; and their plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reledger.fixed_values import FLAGSHIP_POINTS, GOOGLE_ADS, META_ADS, SHARE_POINTS
from reledger.functions.calendar import REPORT_MONTH
from reledger.lake import GOLD, GOOGLE_RAW, META_RAW, SILVER
from reledger.operators import quality
from reledger.plans.audit import changes_since, remember
from reledger.plans.publish import publish, reload_extraction
from reledger.plans.queries import REGISTRY
from reledger.sources.landing import (
    OBJECT_OPTIONS,
    extraction_prefix,
    landed_files,
    landed_objects,
)
from reledger.sources.synthetic import CAMPAIGN_DAY_KEYS, campaign_days, share_points
from tests.conftest import DAYS
from tests.test_entry import SMALL, needs_tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def checksum(df, **options):
    return quality.fingerprint(df, **options).collect()


def test_a_fingerprint_ignores_order_and_notices_values(spark):
    rows = [("a", 1, None), ("b", 2, 5), ("c", 3, 6), ("c", 3, 6)]
    df = spark.createDataFrame(rows, "k string, x int, y int")
    assert checksum(df.repartition(3, "x")) == checksum(df)
    for changed in (
        rows[:3],  # a duplicate less
        [("a", 2, None), ("b", 1, 5), *rows[2:]],  # values that changed places
        [("a", None, 1), *rows[1:]],  # a NULL that changed its column
        [*rows[:2], ("c", 4, 6), ("c", 2, 6)],  # equal sums
    ):
        assert checksum(spark.createDataFrame(changed, df.schema)) != checksum(df)
    groups = quality.fingerprint(df, group_by=["k"])
    merged = groups.agg(F.sum("row_count"), F.sum("checksum")).collect()[0]
    assert tuple(merged) == tuple(checksum(df)[0])
    empty = checksum(df.limit(0))[0]
    assert tuple(empty) == (0, 0)


def test_states_of_one_pass_are_those_of_many(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("g"), (F.col("id") % 3).alias("v"))
    chosen = (F.col("v") == 2).cast("bigint")
    states = {"doubled": (1 + chosen, {}), "revised": (F.lit(1), {"v": F.col("v") + chosen})}
    expected = {
        "base": df,
        "merged": df,
        "doubled": df.unionByName(df.filter("v = 2")),
        "revised": df.withColumn("v", F.col("v") + chosen),
    }
    found = quality.fingerprint_states(df, states, parts="g").collect()
    assert {r["state"]: (r["row_count"], r["checksum"]) for r in found} == {
        name: tuple(checksum(rows)[0]) for name, rows in expected.items()
    }
    plain = quality.fingerprint_states(df.limit(0), states).collect()
    assert {(r["row_count"], r["checksum"]) for r in plain} == {(0, 0)}


@needs_tables
@pytest.mark.parametrize("name,scans,shuffles", [("restated_gold_delta", 2, 2), ("table_fingerprint", 1, 1)])
def test_plans_read_and_shuffle_no_more_than_needed(spark, name, scans, shuffles):
    plan = plan_of(REGISTRY[name](spark, SMALL))
    assert plan.count("FileScan") == scans
    assert plan.count("Exchange hashpartitioning") == shuffles


def test_a_changed_partition_is_named(landed):
    reload_extraction(landed, META_ADS, DAYS[0])
    reload_extraction(landed, META_ADS, DAYS[1])
    remember(landed, META_RAW, "before")
    path = extraction_prefix(landed.landing, META_ADS, DAYS[0])
    report = landed.spark.read.parquet(path)
    swapped = report.withColumns({"clicks": F.col("impressions"), "impressions": F.col("clicks")})
    swapped.write.mode("append").parquet(f"{path}/part-0002.parquet")
    reload_extraction(landed, META_ADS, DAYS[0])
    reload_extraction(landed, META_ADS, DAYS[2])
    found = changes_since(landed, META_RAW, "before").collect()
    assert {str(r["_extracted_at"]): (r["rows_before"], r["rows_after"], r["is_same"]) for r in found} == {
        DAYS[0]: (10, 20, False), DAYS[1]: (10, 10, True), DAYS[2]: (0, 10, False)
    }


def test_rows_of_another_source_or_twice_loaded_are_not_traced(landed):
    reload_extraction(landed, META_ADS, DAYS[0])
    bronze, landed_now = landed.table(META_RAW), landed_objects(landed.spark, landed.landing, META_ADS, [DAYS[0]])

    def traced(rows):
        return [r["is_traced"] for r in quality.provenance(quality.object_trace(rows, landed_now, META_ADS)).collect()]

    assert traced(bronze) == [True]
    assert traced(bronze.unionByName(bronze)) == [False]
    assert traced(bronze.limit(9)) == [False]
    assert traced(bronze.withColumn("_source", F.lit(GOOGLE_ADS))) == [False]
    assert traced(bronze.withColumn("_source_file", F.lit("elsewhere.parquet"))) == [False]
    counts = quality.provenance(quality.object_trace(bronze.limit(0), landed_now, META_ADS)).collect()[0]
    assert (counts["unread_count"], counts["is_traced"]) == (1, False)


def test_files_written_otherwise_do_not_conform(landed):
    spark, landing = landed.spark, landed.landing

    def conforms(options=OBJECT_OPTIONS):
        files = landed_files(spark, landing, GOOGLE_ADS, options, [DAYS[0]])
        return files.agg(F.every("conforms")).collect()[0][0]

    assert conforms()
    assert not conforms({**OBJECT_OPTIONS, "parquet.compression.codec.zstd.level": "9"})
    assert not conforms({**OBJECT_OPTIONS, "parquet.block.size": "100"})
    assert not conforms({**OBJECT_OPTIONS, "compression": "snappy"})
    path = extraction_prefix(landing, GOOGLE_ADS, DAYS[0])
    spark.read.schema("account_id string").parquet(path).write.option("compression", "zstd").parquet(
        f"{path}/unmarked.parquet"
    )
    assert not conforms()


def test_the_catalog_audit_notices_an_altered_column_and_foreign_files(landed):
    reload_extraction(landed, META_ADS, DAYS[0])
    publish(landed)

    def faults():
        return {(r["table_name"], r["column_name"]) for r in landed.columns().filter("not conforms").collect()}

    assert faults() == set()
    landed.spark.sql(f"ALTER TABLE {landed.name(GOLD)} ADD COLUMNS (note STRING)")
    loads = f"{landed.location(SILVER)}/_loads"
    landed.spark.range(1).select(F.lit(1).alias("clicks")).write.mode("append").parquet(f"{loads}/x/report_month=202607")
    assert faults() == {("gold.campaign_daily", "note"), ("silver.ads_daily", "clicks")}


def test_a_lookup_reads_a_part_of_a_month(empty_lake):
    spark = empty_lake.spark
    rows = spark.range(0, 200_000, 1, 4).select(
        F.lit(GOOGLE_ADS).alias("source"),
        F.lpad(F.expr("cast(id div 20 as string)"), 6, "0").alias("account_id"),
        F.to_date(F.lit("2026-01-01")).alias("report_date"),
        F.lit("c").alias("campaign_id"),
        F.concat(F.lit("p"), (F.col("id") * 2).cast("string")).alias("product_id"),
        *[F.lit(1).cast("decimal(18,6)").alias(name) for name in ("spend_eur", "revenue_eur")],
        *[F.col("id").alias(name) for name in ("clicks", "impressions", "conversions")],
        F.to_date(F.lit("2026-01-02")).alias("_extracted_at"),
        F.lit(202601).alias(REPORT_MONTH),
    )
    empty_lake.replace_partitions(SILVER, rows, [])

    def scanned(condition):
        found = empty_lake.table(SILVER).filter(condition).select("clicks")
        execution = found._jdf.queryExecution()
        result = found.collect()  # plans anew, so the metric is read from a plan run here
        physical = execution.executedPlan()
        physical.executeCollectPublic()
        leaf = physical
        while leaf.children().size():
            leaf = leaf.children().head()
        return len(result), leaf.metrics().apply("numOutputRows").value()

    kept, read = scanned("account_id = '004321'")
    assert kept == 20 and read <= 40_000  # the page index
    kept, read = scanned("product_id = 'p100001'")  # within every page's range, in no file
    assert (kept, read) == (0, 0)  # the bloom filter


def test_points_are_the_draws_counted(spark):
    days = campaign_days(spark, days=3)
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(SHARE_POINTS - FLAGSHIP_POINTS - 1)),
        lambda draw: F.pmod(F.xxhash64(F.lit(42), *CAMPAIGN_DAY_KEYS, draw), F.lit(99)),
    )
    number = F.substring("product_id", 5, 3).cast("int")
    other = number - (number > 77).cast("int")
    won = F.size(F.filter(draws, lambda draw: draw == other))
    shared = share_points(days, 42).withColumn("won", won)
    assert shared.filter("product_id <> 'sku_77' and points <> won").count() == 0
    assert shared.filter("product_id = 'sku_77' and points <> 10").count() == 0
    with pytest.raises(ValueError, match="must be one of"):
        share_points(days, 42, products=77)
