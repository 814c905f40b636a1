"""The whole flow on the synthetic reports, against the values it must give."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reledger.fixed_values import GOOGLE_ADS, META_ADS, UNKNOWN_PRODUCT
from reledger.lake import GOLD, GOOGLE_RAW, SILVER, Lake
from reledger.operators import quality
from reledger.operators.rollup import (
    CAMPAIGN_DAY,
    METRICS,
    change_between,
    sum_components,
    with_metrics,
)
from reledger.plans.publish import (
    BUSINESS_KEY,
    build_gold,
    build_silver,
    publish,
    reload_extraction,
    restate,
)
from reledger.sources.landing import copy_object, extraction_prefix, write_object
from tests.conftest import DAYS, PIVOT, RESTATED, load_days


def rows(df):
    return sorted(map(str, df.collect()))


def pivot(lake, *columns):
    row = lake.spark.table(lake.metrics_view).filter(PIVOT).select(*columns).collect()[0]
    return tuple(map(str, row))


def flagship(lake):
    row = lake.table(SILVER).filter(f"{PIVOT} AND product_id = 'sku_77'")
    return tuple(map(str, row.select("conversions", "revenue_eur", "spend_eur").collect()[0]))


def test_published_values(published):
    silver = published.table(SILVER)
    assert silver.count() == 3030
    assert published.table(GOLD).count() == 60
    assert flagship(published) == ("40", "6172.500000", "1234.500000")
    assert pivot(published, "spend_eur", "revenue_eur", "conversions", "clicks") == (
        "12345.000000", "61725.000000", "400", "20000"
    )
    assert pivot(published, *METRICS) == ("5.0000", "30.862500", "0.020000", "0.617250")
    both = silver.filter(PIVOT.split(" AND ", 1)[1])
    assert both.agg(F.sum("spend_eur")).collect()[0][0] == Decimal("13332.650000")


def test_a_missing_product_is_a_sentinel_and_nothing_is_null(published):
    meta = published.table(SILVER).filter("source = 'meta_ads' AND report_date = '2026-07-15'")
    assert meta.agg(
        F.count(F.lit(1)), F.count_if(F.col("product_id") == UNKNOWN_PRODUCT)
    ).collect()[0] == (10, 10)
    audit = quality.null_audit(published.table(SILVER)).collect()
    assert [row["column_name"] for row in audit if row["null_rows"]] == []


def test_gold_reconciles_and_keeps_components_only(published):
    compared = quality.reconcile(
        published.table(GOLD), published.table(SILVER), ["report_month"]
    ).collect()
    assert [row["reconciles"] for row in compared] == [True]
    assert quality.stores_components_only(published.table(GOLD))
    assert not quality.stores_components_only(with_metrics(published.table(GOLD)))


def test_the_same_formula_at_every_grain(published):
    month = with_metrics(sum_components(published.table(GOLD), ["source", "report_month"]))
    days = published.table(GOLD).filter("source = 'google_ads'")
    spend, conversions = days.agg(F.sum("spend_eur"), F.sum("conversions")).collect()[0]
    got = month.filter("source = 'google_ads'").collect()[0]
    assert got["cpa"] == (spend / conversions).quantize(Decimal("0.000001"), "ROUND_DOWN")
    assert month.columns[-4:] == ["roas", "cpa", "ctr", "cpc"]


def test_a_zero_denominator_is_unknown_and_its_month_can_be_dropped(landed):
    load_days(landed)
    publish(landed)
    landed.spark.sql(
        f"INSERT INTO {landed.name(GOLD)} VALUES"
        " ('probe', 'acct_01', 'camp_003', DATE'2026-01-01', 0, 0, 0, 0, 0, 202601)"
    )
    probe = landed.spark.table(landed.metrics_view).filter("source = 'probe'")
    assert tuple(probe.select(*METRICS).collect()[0]) == (None,) * 4
    publish(landed)  # a month that never was in Silver is nobody's business
    assert probe.count() == 1
    landed.drop_partitions(GOLD, [{"report_month": "202601"}])
    assert landed.months(GOLD) == [202607] and landed.table(GOLD).count() == 60


def test_a_late_restatement_replaces_and_replays_change_nothing(landed):
    prefix = extraction_prefix(landed.landing, GOOGLE_ADS, DAYS[2])
    copy_object(landed.spark, f"{prefix}", f"{prefix}/part-0002.parquet")
    load_days(landed)
    assert landed.table(GOOGLE_RAW).count() == 4000  # one day holds two equal objects
    publish(landed)
    assert landed.table(SILVER).count() == 3030
    before = rows(landed.table(GOLD))
    reloaded = restate(landed, GOOGLE_ADS, RESTATED)
    assert (reloaded.rows, reloaded.months) == (1, [202607])
    assert landed.table(SILVER).count() == 3030
    assert flagship(landed) == ("47", "7250.000000", "1234.500000")
    assert pivot(landed, "revenue_eur", "conversions", "roas", "spend_eur") == (
        "62802.500000", "407", "5.0873", "12345.000000"
    )
    silver, gold = rows(landed.table(SILVER)), rows(landed.table(GOLD))
    assert len(set(gold) - set(before)) == 1
    for _ in range(2):
        restate(landed, GOOGLE_ADS, RESTATED)
    assert (rows(landed.table(SILVER)), rows(landed.table(GOLD))) == (silver, gold)
    late = landed.table(SILVER).filter(f"_extracted_at = '{RESTATED}'")
    assert [str(row["report_date"]) for row in late.collect()] == ["2026-07-15"]
    unique = quality.grain_uniqueness(landed.table(SILVER), BUSINESS_KEY).collect()[0]
    assert (unique["row_count"], unique["key_count"], unique["is_unique"]) == (3030, 3030, True)


@pytest.fixture
def monthly(landed):
    """Two published months, the second from an extraction that can be rewritten."""
    reload_extraction(landed, GOOGLE_ADS, DAYS[0])
    report = landed.spark.read.parquet(extraction_prefix(landed.landing, GOOGLE_ADS, DAYS[0]))
    moved = report.withColumn("segments_date", F.to_date(F.lit("2026-09-02")))
    write_object(moved, landed.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    reload_extraction(landed, GOOGLE_ADS, "2026-09-03")
    publish(landed)
    assert landed.months(SILVER) == landed.months(GOLD) == [202607, 202609]
    return landed, moved


def full_rebuild_agrees(lake):
    silver, gold = rows(lake.table(SILVER)), rows(lake.table(GOLD))
    publish(lake)
    return (rows(lake.table(SILVER)), rows(lake.table(GOLD))) == (silver, gold)


def test_a_key_that_vanishes_leaves_silver_and_gold(monthly):
    lake, report = monthly
    fewer = report.filter("campaign_id <> 'camp_005'")
    write_object(fewer, lake.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    assert restate(lake, GOOGLE_ADS, "2026-09-03").months == [202609]
    assert lake.table(SILVER).filter("report_month = 202609").count() == 800
    assert lake.table(GOLD).filter("report_month = 202609").count() == 8
    assert full_rebuild_agrees(lake)


def test_rows_that_move_to_another_month_leave_the_old_one(monthly):
    lake, report = monthly
    later = report.withColumn("segments_date", F.to_date(F.lit("2026-08-31")))
    write_object(later, lake.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    assert restate(lake, GOOGLE_ADS, "2026-09-03").months == [202608, 202609]
    assert lake.months(SILVER) == lake.months(GOLD) == [202607, 202608]
    assert full_rebuild_agrees(lake)


def test_a_restatement_that_failed_before_publishing_can_be_run_again(monthly):
    """The reload went through and moved rows out of a month, then the driver was lost."""
    lake, report = monthly
    later = report.withColumn("segments_date", F.to_date(F.lit("2026-08-31")))
    write_object(later, lake.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    reload_extraction(lake, GOOGLE_ADS, "2026-09-03")
    again = Lake(lake.spark, lake.root, prefix=f"again_{lake.prefix}")
    again.ensure_tables()
    assert restate(again, GOOGLE_ADS, "2026-09-03").months == [202608, 202609]
    assert again.months(SILVER) == again.months(GOLD) == [202607, 202608]
    assert again.months(GOOGLE_RAW) == [202607, 202608]
    assert full_rebuild_agrees(again)


def test_a_partial_publication_leaves_other_months_alone(monthly):
    lake, report = monthly
    fewer = report.limit(0)
    write_object(fewer, lake.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    reload_extraction(lake, GOOGLE_ADS, "2026-09-03")
    publish(lake, [202607])
    assert lake.months(GOLD) == [202607, 202609]
    assert publish(lake) == [202607, 202609]  # a full one drops what Bronze no longer holds
    assert lake.months(SILVER) == lake.months(GOLD) == [202607]


def test_a_later_object_of_the_same_extraction_wins(landed):
    report = landed.spark.read.parquet(extraction_prefix(landed.landing, META_ADS, DAYS[0]))
    lower = report.withColumn("clicks", F.lit(1).cast("bigint"))
    write_object(report, landed.landing, META_ADS, "2026-07-21", "part-0001")
    write_object(lower, landed.landing, META_ADS, "2026-07-21", "part-0002")
    reload_extraction(landed, META_ADS, "2026-07-21")
    build_gold(landed, build_silver(landed))
    assert landed.table(SILVER).agg(F.count(F.lit(1)), F.sum("clicks")).collect()[0] == (10, 10)


def test_an_extraction_that_spans_many_months(landed):
    """Wide extractions are rebalanced on loading: same rows, one file per small month."""
    report = landed.spark.read.parquet(extraction_prefix(landed.landing, META_ADS, DAYS[0]))
    wide = report.withColumn(
        "date_start",
        F.add_months("date_start", F.pmod(F.xxhash64("campaign_id"), F.lit(12)).cast("int")),
    ).withColumn("clicks", F.col("clicks") + F.xxhash64("account_id") % 7)
    write_object(wide, landed.landing, META_ADS, "2027-08-01", "part-0001")
    reloaded = restate(landed, META_ADS, "2027-08-01")
    assert reloaded.rows == 10
    assert landed.months(SILVER) == landed.months(GOLD) == reloaded.months
    assert landed.table(GOLD).agg(F.sum("clicks")).collect() == wide.agg(
        F.sum("clicks")
    ).collect()


def test_changes_between_two_states(spark):
    schema = "source string, account_id string, campaign_id string, report_date string," \
        " spend_eur decimal(18,6), clicks long, impressions long, conversions long," \
        " revenue_eur decimal(18,6)"
    one, two = Decimal("1"), Decimal("2")
    before = spark.createDataFrame(
        [("s", "a", "c", "d1", one, 1, 1, 1, one), ("s", "a", "c", "d2", one, 1, 1, 1, one)],
        schema,
    )
    after = spark.createDataFrame(
        [("s", "a", "c", "d1", one, 1, 1, 1, two), ("s", "a", "c", "d3", one, 5, 1, 1, one)],
        schema,
    )
    found = change_between(before, after, CAMPAIGN_DAY).collect()
    changed = {row["report_date"]: row for row in found}
    assert {day: row["clicks"] for day, row in changed.items()} == {"d1": 0, "d2": -1, "d3": 5}
    assert changed["d1"]["revenue_eur"] == 1


def lost(*_, **__):
    raise RuntimeError("the driver was lost")


@pytest.mark.parametrize(
    "step,moved", [("_commit", False), ("_apply", True), ("_mark_seen", True), ("_sweep", True)]
)
def test_a_driver_lost_anywhere_never_leaves_rows_counted_twice(monthly, monkeypatch, step, moved):
    """Rows move from a month to another: whatever step is lost, one state or the other is left."""
    lake, report = monthly
    later = report.withColumn("segments_date", F.to_date(F.lit("2026-08-31")))
    write_object(later, lake.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    with monkeypatch.context() as patched:
        patched.setattr(Lake, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            reload_extraction(lake, GOOGLE_ADS, "2026-09-03")
    expected = {202607: 1000, 202608 if moved else 202609: 1000}
    again = Lake(lake.spark, lake.root, prefix=f"again_{lake.prefix}")
    again.ensure_tables()
    for one in (lake, again):
        publish(one)
        for table in (GOOGLE_RAW, SILVER):
            months = one.table(table).groupBy("report_month").count().collect()
            assert {row["report_month"]: row["count"] for row in months} == expected
    assert restate(lake, GOOGLE_ADS, "2026-09-03").rows == 1000
    assert lake.months(GOLD) == [202607, 202608] and full_rebuild_agrees(lake)
    assert lake.remove_abandoned(GOOGLE_RAW) and lake.remove_abandoned(GOOGLE_RAW) == []
    assert lake.table(GOOGLE_RAW).count() == 2000


@pytest.mark.parametrize("step", ["_apply", "_sweep"])
def test_a_publication_lost_anywhere_is_made_good_by_the_next(monthly, monkeypatch, step):
    lake, report = monthly
    write_object(report.limit(0), lake.landing, GOOGLE_ADS, "2026-09-03", "part-0001")
    reload_extraction(lake, GOOGLE_ADS, "2026-09-03")
    with monkeypatch.context() as patched:
        patched.setattr(Lake, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            publish(lake)
    publish(lake)
    assert lake.months(SILVER) == lake.months(GOLD) == [202607]
    assert lake.table(SILVER).count() == 1000
