"""The synthetic reports and the schemas of the two sources."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reledger.fixed_values import GOOGLE_ADS, META_ADS, PIVOT_REPORT_DAY
from reledger.operators import quality
from reledger.sources.landing import extraction_prefix, read_extractions
from reledger.sources.networks import network_named
from reledger.sources.synthetic import (
    campaign_days,
    google_reports,
    meta_reports,
    restatement,
    share_points,
)
from tests.conftest import DAYS, RESTATED

PIVOT_KEY = "account_id = 'acct_01' AND campaign_id = 'camp_003'"


def report(spark, landing, source, day):
    return spark.read.parquet(extraction_prefix(landing, source, day))


def test_volumes_and_layout(spark, landing):
    for day in DAYS:
        assert report(spark, landing, GOOGLE_ADS, day).count() == 1000
        assert report(spark, landing, META_ADS, day).count() == 10
    assert report(spark, landing, GOOGLE_ADS, RESTATED).count() == 1


def test_pivot_values(spark, landing):
    pivot = report(spark, landing, GOOGLE_ADS, DAYS[1]).filter(PIVOT_KEY)
    measures = ("cost_micros", "clicks", "impressions", "conversions", "revenue_eur")
    sums = pivot.agg(F.count(F.lit(1)), *[F.sum(name) for name in measures]).collect()[0]
    assert tuple(sums) == (
        100, 12_345_000_000, 20_000, 1_000_000, 400, Decimal("61725.00")
    )
    flagship = pivot.filter("product_id = 'sku_77'").select(*measures).collect()[0]
    assert tuple(flagship) == (1_234_500_000, 2_000, 100_000, 40, Decimal("6172.50"))
    meta = report(spark, landing, META_ADS, DAYS[1]).filter(PIVOT_KEY)
    row = meta.select("spend", "clicks", "impressions", "conversions", "revenue_eur").collect()
    assert [tuple(one) for one in row] == [
        (Decimal("987.65"), 1500, 80_000, 25, Decimal("3950.60"))
    ]
    late = report(spark, landing, GOOGLE_ADS, RESTATED).collect()[0]
    assert (late["product_id"], late["segments_date"]) == ("sku_77", PIVOT_REPORT_DAY)
    assert (late["conversions"], late["revenue_eur"]) == (47, Decimal("7250.00"))
    assert late["cost_micros"] == 1_234_500_000


def test_points_always_total_one_hundred(spark):
    days = campaign_days(spark, days=7, accounts=3, campaigns=4, tasks=3)
    shared = share_points(days, seed=1)
    per_day = shared.groupBy("account_id", "campaign_id", "report_date").agg(
        F.sum("points").alias("points"), F.count_distinct("product_id").alias("products")
    )
    assert per_day.filter("points = 100 AND products = 100").count() == 84
    flagship = shared.filter("product_id = 'sku_77'").select("points").distinct().collect()
    assert [row[0] for row in flagship] == [10]


def test_a_seed_gives_the_same_rows_on_any_number_of_tasks(spark):
    def prints(tasks, seed):
        days = campaign_days(spark, days=4, tasks=tasks)
        return [
            quality.fingerprint(rows).collect()
            for rows in (google_reports(days, seed), meta_reports(days, seed))
        ]

    assert prints(1, 42) == prints(5, 42)
    assert prints(1, 42) != prints(1, 43)


def test_generating_needs_no_shuffle_and_no_join(spark):
    google = google_reports(campaign_days(spark))
    for rows in (google, meta_reports(campaign_days(spark)), restatement(google)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_each_source_keeps_its_own_schema(spark, landing):
    google, meta = (
        report(spark, landing, GOOGLE_ADS, DAYS[0]), report(spark, landing, META_ADS, DAYS[0])
    )
    declared = {
        name: T.StructType.fromDDL(network_named(name).report_ddl)
        for name in (GOOGLE_ADS, META_ADS)
    }
    assert quality.schema_differences(google, declared[GOOGLE_ADS]) == []
    forbidden = ["product_id", "cost_micros"]
    assert quality.schema_differences(meta, declared[META_ADS], forbidden) == []
    assert quality.schema_differences(google, declared[META_ADS], forbidden) == [
        "date_start: missing",
        "spend: missing",
        "product_id: not allowed",
        "cost_micros: not allowed",
    ]
    wrong = google.withColumn("clicks", F.col("clicks").cast("int"))
    assert quality.schema_differences(wrong, declared[GOOGLE_ADS]) == [
        "clicks: int instead of bigint"
    ]


def test_columns_are_read_by_name_and_only_those_asked_for(spark, landing):
    rows = read_extractions(spark, landing, network_named(GOOGLE_ADS), DAYS[:1])
    assert rows.columns == [name for name, _ in network_named(GOOGLE_ADS).report_columns]
    plan = rows.select("clicks")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<clicks:bigint>" in plan


def test_quality_checks_find_faults(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', 1L), ('a', 2L), (NULL, 3L) AS t(k, n)"
    )
    unique = quality.grain_uniqueness(df, ["k"]).collect()[0]
    assert (unique["row_count"], unique["key_count"], unique["is_unique"]) == (3, 2, False)
    assert {tuple(row) for row in quality.null_audit(df).collect()} == {("k", 1), ("n", 0)}
    whole = spark.sql("SELECT * FROM VALUES ('a', 3L), ('b', 1L) AS t(k, n)")
    kept = quality.conservation(df.filter("k IS NOT NULL"), whole, ["k"]).collect()
    assert {row["k"]: row["is_conserved"] for row in kept} == {"a": True, "b": False}
    empty = quality.grain_uniqueness(df.limit(0), ["k"]).collect()[0]
    assert (empty["row_count"], empty["is_unique"]) == (0, True)


def test_reconciliation_localises_a_break(spark):
    columns = "m INT, spend_eur DECIMAL(18,6), clicks LONG, impressions LONG," \
        " conversions LONG, revenue_eur DECIMAL(18,6)"
    one = Decimal(1)
    left = spark.createDataFrame([(1, one, 1, 1, 1, one), (2, one, 1, 1, 1, one)], columns)
    right = spark.createDataFrame([(1, one, 1, 1, 1, one), (2, one, 2, 1, 1, one),
                                   (3, one, 1, 1, 1, one)], columns)
    found = quality.reconcile(left, right, ["m"]).collect()
    assert {row["m"]: row["reconciles"] for row in found} == {1: True, 2: False, 3: False}
