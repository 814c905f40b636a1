"""The registered queries: each runs one operator or flow over whole tables.

A query that writes does so in a lake of its own and returns a DataFrame over it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reledger.fixed_values import DEFAULT_SEED, GOOGLE_ADS, META_ADS
from reledger.functions.calendar import REPORT_MONTH, report_month
from reledger.functions.money import amount_text, cents_to_amount, micros_to_amount
from reledger.lake import BASELINE, GOLD, GOOGLE_RAW, META_RAW, SILVER, Lake, scratch_lake
from reledger.operators import quality
from reledger.operators.latest import latest_twice, latest_wins
from reledger.operators.rollup import (
    AMOUNTS,
    CAMPAIGN_DAY,
    COMPONENTS,
    campaign_daily,
    change_of_versions,
    sum_components,
    with_metrics,
)
from reledger.plans.audit import changes_since, remember
from reledger.plans.publish import (
    NEWEST_FIRST,
    WINDOW_KEY,
    build_silver,
    latest_version,
    publish,
    reload_extraction,
    reload_extractions,
    restate,
    restate_days,
    silver_rows,
)
from reledger.sources import star_schema as star
from reledger.sources import synthetic
from reledger.sources.landing import (
    copy_object,
    extraction_days,
    extraction_prefix,
    landed_files,
    landed_objects,
    to_bronze,
    write_object,
    write_reports,
)
from reledger.sources.networks import conform, network_named
from reledger.storage import Files

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    REGISTRY[function.__name__] = function
    return function


# --- inputs ---------------------------------------------------------------------------------


def _bronze(report: DataFrame, source: str, day: str, file: str | Column) -> DataFrame:
    return to_bronze(
        report,
        network_named(source),
        day,
        source_file=F.lit(file) if isinstance(file, str) else file,
        ingested_at=F.to_timestamp(F.lit(star.INGESTED_AT)),
    )


def _bronze_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    return _bronze(report, GOOGLE_ADS, star.EXTRACTED_A, star.FILE_A)


def _restated_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    return _bronze(star.restated_report(report), GOOGLE_ADS, star.RESTATED_A, star.FILE_A)


def _bronze_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = star.meta_report(star.read(spark, sf_dir, "events"))
    return _bronze(report, META_ADS, star.EXTRACTED_B, star.FILE_B)


def _conformed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(network_named(GOOGLE_ADS), _bronze_a(spark, sf_dir))


def _conformed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(network_named(META_ADS), _bronze_b(spark, sf_dir))


def _silver_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(_conformed_a(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(
        _conformed_a(spark, sf_dir).unionByName(_conformed_b(spark, sf_dir))
    )


def _silver_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    restated = conform(network_named(GOOGLE_ADS), _restated_a(spark, sf_dir))
    return latest_version(_conformed_a(spark, sf_dir).unionByName(restated))


def _reports(lake: Lake, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The reports of both networks, both from the events."""
    events = star.read(lake.spark, sf_dir, "events")
    return star.google_event_report(events), star.meta_report(events)


def _loaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Both networks loaded from the events, a correction of the first one landed."""
    lake = scratch_lake(spark)
    google, meta = _reports(lake, sf_dir)
    write_object(google, lake.landing, GOOGLE_ADS, star.EXTRACTED_E, "part-0001")
    write_object(meta, lake.landing, META_ADS, star.EXTRACTED_B, "part-0001")
    corrected = star.restated_report(google)
    write_object(corrected, lake.landing, GOOGLE_ADS, star.RESTATED_E, "restated")
    reload_extraction(lake, GOOGLE_ADS, star.EXTRACTED_E)
    reload_extraction(lake, META_ADS, star.EXTRACTED_B)
    return lake


def _published_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = _loaded_lake(spark, sf_dir)
    publish(lake)
    return lake


def _long_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The first network loaded from the line items, which span many months."""
    lake = scratch_lake(spark)
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    write_object(report, lake.landing, GOOGLE_ADS, star.EXTRACTED_A, "part-0001")
    reload_extraction(lake, GOOGLE_ADS, star.EXTRACTED_A)
    return lake


def _daily_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Reports of both networks published day by day, all days of a network in one load."""
    lake = scratch_lake(spark)
    google, meta = _reports(lake, sf_dir)
    published = synthetic.published_next_day
    write_reports(published(google, "segments_date"), lake.landing, GOOGLE_ADS)
    write_reports(published(meta, "date_start"), lake.landing, META_ADS)
    for source in (GOOGLE_ADS, META_ADS):
        reload_extractions(lake, source, extraction_days(spark, lake.landing, source))
    return lake


# --- Bronze ---------------------------------------------------------------------------------


def _as_text_instant(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn(
        "_ingested_at", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss")
    )


@query
def bronze_projection_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text_instant(_bronze_a(spark, sf_dir))


@query
def bronze_projection_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text_instant(_bronze_b(spark, sf_dir))


@query
def source_file_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two objects in one extraction: both read whole, every row traced to one that exists."""
    lake = _loaded_lake(spark, sf_dir)
    prefix = extraction_prefix(lake.landing, GOOGLE_ADS, star.EXTRACTED_E)
    copy_object(spark, f"{prefix}/part-0001.parquet", f"{prefix}/part-0002.parquet")
    reload_extraction(lake, GOOGLE_ADS, star.EXTRACTED_E)
    landed = landed_objects(spark, lake.landing, GOOGLE_ADS, [star.EXTRACTED_E])
    trace = quality.object_trace(lake.table(GOOGLE_RAW), landed, GOOGLE_ADS)
    return quality.provenance(trace.withColumn("_source", F.lit(GOOGLE_ADS)), ["_source"])


@query
def lineage_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects deleted, rewritten and published since the load do not pass for traced."""
    lake = _loaded_lake(spark, sf_dir)
    prefix = extraction_prefix(lake.landing, GOOGLE_ADS, star.EXTRACTED_E)
    for name in ("part-0002", "part-0003"):
        copy_object(spark, f"{prefix}/part-0001.parquet", f"{prefix}/{name}.parquet")
    reload_extraction(lake, GOOGLE_ADS, star.EXTRACTED_E)
    Files(spark, prefix).delete("part-0002.parquet")
    google, _ = _reports(lake, sf_dir)
    fewer = star.restated_report(google)
    write_object(fewer, lake.landing, GOOGLE_ADS, star.EXTRACTED_E, "part-0003")
    landed = landed_objects(spark, lake.landing, GOOGLE_ADS)
    trace = quality.object_trace(lake.table(GOOGLE_RAW), landed, GOOGLE_ADS)
    name = F.substring_index("_source_file", "/", -1).alias("object_name")
    return trace.select("_extracted_at", name, "landed_rows", "loaded_rows", "is_traced")


@query
def bronze_reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of one extraction leave what one load leaves, value by value."""
    lake = _loaded_lake(spark, sf_dir)
    remember(lake, GOOGLE_RAW, "first")
    for _ in range(2):
        reload_extraction(lake, GOOGLE_ADS, star.EXTRACTED_E)
    partition = list(GOOGLE_RAW.partitions)
    instants = lake.table(GOOGLE_RAW).groupBy(*partition, "_ingested_at").count()
    per_partition = instants.groupBy(*partition).agg(F.count(F.lit(1)).alias("instant_count"))
    return changes_since(lake, GOOGLE_RAW, "first").join(per_partition, partition)


@query
def daily_extractions_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's reports published the day after; all extractions loaded by one load."""
    lake = _daily_lake(spark, sf_dir)
    key = F.regexp_extract("_source_file", "source=[^/]+/report=[^/]+/extracted_at=[^/]+", 0)
    return lake.table(GOOGLE_RAW).withColumn("object_key", key).drop("_source_file", "_ingested_at")


@query
def moved_value_noticed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One click moved from a row to another: all sums of the month agree, the prints do not."""
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    report = report.withColumn(REPORT_MONTH, report_month(F.col("segments_date")))
    row = F.struct(*report.columns)
    ends = report.groupBy(REPORT_MONTH).agg(F.min(row).alias("first"), F.max(row).alias("last"))
    # One row a month.
    moved = report.join(F.broadcast(ends), REPORT_MONTH).withColumn(
        "clicks", F.col("clicks") + (row == F.col("first")).cast("int") - (row == F.col("last")).cast("int")
    )
    totals = [F.sum(name).alias(name) for name in ("clicks", "impressions", "cost_micros")]

    def state(rows: DataFrame) -> DataFrame:
        kept = rows.select(*report.columns)
        return quality.fingerprint(kept, (), [REPORT_MONTH]).join(
            kept.groupBy(REPORT_MONTH).agg(F.struct(*totals).alias("sums")), REPORT_MONTH
        )

    before, after = state(report), state(moved)
    changes = quality.fingerprint_changes(before, after, [REPORT_MONTH])
    sums = before.select(REPORT_MONTH, "sums").join(
        after.select(REPORT_MONTH, F.col("sums").alias("moved")), REPORT_MONTH
    )
    return changes.join(sums, REPORT_MONTH).select(
        REPORT_MONTH,
        F.col("rows_after").alias("row_count"),
        (F.col("sums") == F.col("moved")).alias("same_sums"),
        F.col("is_same").alias("same_print"),
    )


@query
def bronze_reload_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extraction reloaded with no row ends up empty; its neighbour does not."""
    lake = _loaded_lake(spark, sf_dir)
    reload_extraction(lake, GOOGLE_ADS, star.RESTATED_E)
    google, _ = _reports(lake, sf_dir)
    none = google.filter(F.col("impressions") < 0)
    write_object(none, lake.landing, GOOGLE_ADS, star.RESTATED_E, "restated")
    reload_extraction(lake, GOOGLE_ADS, star.RESTATED_E)
    return quality.rows_per_extraction(lake.table(GOOGLE_RAW))


@query
def bronze_reload_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reloading one extraction with other rows leaves its neighbours as they were."""
    lake = _loaded_lake(spark, sf_dir)
    reload_extraction(lake, GOOGLE_ADS, star.RESTATED_E)
    google, _ = _reports(lake, sf_dir)
    fewer = star.restated_report(google).filter(F.col("cost_micros") > 20_000_000)
    write_object(fewer, lake.landing, GOOGLE_ADS, star.RESTATED_E, "restated")
    reload_extraction(lake, GOOGLE_ADS, star.RESTATED_E)
    return quality.rows_per_extraction(lake.table(GOOGLE_RAW)).unionByName(
        quality.rows_per_extraction(lake.table(META_RAW))
    )


@query
def baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline formulas over every order number."""
    numbers = star.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"))
    return _as_text_instant(synthetic.baseline_rows(numbers))


def _totals(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows and sums of whole numbers: exact at any size, longs unless 64 bits do not hold them."""
    exact = [F.sum(F.col(name).cast("decimal(28,0)")).alias(name) for name in names]
    totals = rows.agg(F.count(F.lit(1)).alias("row_count"), *exact)
    known = totals.first()
    longs = {name: F.col(name).cast("bigint") for name in names if abs(known[name] or 0) < 1 << 63}
    return totals.withColumns(longs)


@query
def baseline_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncate and append twice: the totals of one load."""
    lake = scratch_lake(spark)
    numbers = star.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"))
    for _ in range(2):
        lake.truncate(BASELINE)
        lake.append(BASELINE, synthetic.baseline_rows(numbers))
    return _totals(lake.table(BASELINE), ("cost_micros", "clicks", "impressions", "conversions"))


@query
def lake_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a table to the lake, read it back, sum it."""
    lake = scratch_lake(spark)
    clone = lake.clone_structure(GOOGLE_RAW, "round_trip")
    rows = _bronze_a(spark, sf_dir).select(*GOOGLE_RAW.column_order)
    rows.sortWithinPartitions(*GOOGLE_RAW.partitions).write.insertInto(clone, overwrite=True)
    return spark.table(clone).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("cost_micros").alias("cost_micros")
    )


# --- Silver ---------------------------------------------------------------------------------


@query
def micros_to_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    return report.select(
        "account_id",
        "product_id",
        "cost_micros",
        micros_to_amount("cost_micros").alias("spend_eur"),
        amount_text(micros_to_amount("cost_micros")).alias("spend_text"),
        cents_to_amount(F.expr("cost_micros div 10000")).alias("whole_cents"),
    )


@query
def silver_conform_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformed_a(spark, sf_dir).drop("_ingested_at", "_object")


@query
def silver_conform_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformed_b(spark, sf_dir).drop("_ingested_at", "_object")


@query
def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@query
def latest_wins_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest shipment of each order line; the other columns make the order total."""
    lineitem = star.read(spark, sf_dir, "lineitem")
    others = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    latest = latest_wins(
        lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", *others),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", *others],
    )
    return latest.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query
def latest_event_per_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    latest = latest_wins(events, ["user_id", "event_type"], ["ts", "event_id"])
    return latest.drop("ts")


@query
def late_restatement_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base reports and a later correction of some keys: the correction replaces them."""
    return _silver_restated(spark, sf_dir)


@query
def slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional and distinct counts over slices picked by equality, IN and LIKE.

    Days are grouped first, then accounts: each level counts the one below, no row is copied.
    """
    silver = _conformed_a(spark, sf_dir)
    is_open = F.col("campaign_id").like("%O")
    slices = silver.filter(
        F.col("campaign_id").isin("AF", "NO", "RF", "RO") & (F.col("clicks") > 1)
    )
    days = slices.groupBy("campaign_id", "account_id", "report_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(is_open & (F.col("conversions") == 0)).alias("open_without_conversion"),
    )
    sums = [F.sum(c).alias(c) for c in ("row_count", "open_without_conversion")]
    accounts = days.groupBy("campaign_id", "account_id").agg(
        *sums, F.count("account_id").alias("day_count"), F.min("report_date").alias("first_day")
    )
    return accounts.groupBy("campaign_id").agg(
        *sums,
        F.count("account_id").alias("account_count"),
        F.sum("day_count").alias("account_day_count"),
        F.min("first_day").alias("first_day"),
    )


@query
def campaign_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaigns of each account, six at most, as one sorted list.

    Duplicates go before anything is collected.
    """
    silver = _conformed_a(spark, sf_dir)
    pairs = silver.select("account_id", "campaign_id").distinct()
    listed = F.sort_array(F.collect_list("campaign_id"))
    return pairs.groupBy("account_id").agg(F.array_join(listed, ",").alias("campaigns"))


# --- Gold -----------------------------------------------------------------------------------


@query
def gold_campaign_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_daily(_silver(spark, sf_dir))


@query
def gold_campaign_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw line items to campaign-day ratios: conform, latest version, sums, ratios."""
    return with_metrics(campaign_daily(_silver_a(spark, sf_dir)))


@query
def gold_monthly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ratios at the grain of a campaign month."""
    grain = ["source", "campaign_id", REPORT_MONTH]
    return with_metrics(sum_components(_silver(spark, sf_dir), grain))


@query
def gold_account_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_metrics(sum_components(_silver(spark, sf_dir), ["source", "account_id"]))


@query
def cross_source_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Once conformed, the two sources add up: totals per month over both."""
    silver = _conformed_a(spark, sf_dir).unionByName(_conformed_b(spark, sf_dir))
    return sum_components(latest_version(silver), [REPORT_MONTH])


@query
def gold_month_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of Gold from stored Silver, by parameterised SQL; other months unread."""
    lake = _long_lake(spark, sf_dir)
    build_silver(lake)
    sums = ", ".join(f"{_summed(name)} AS {name}" for name in COMPONENTS)
    grain = ", ".join(CAMPAIGN_DAY)
    return spark.sql(
        f"SELECT {grain}, {sums} FROM IDENTIFIER(:silver) "
        f"WHERE {REPORT_MONTH} = :month GROUP BY {grain}",
        args={"silver": lake.name(SILVER), "month": 199803},
    )


def _summed(component: str) -> str:
    """The sum of a component as SQL text, amounts in the type they are stored with."""
    return f"CAST(sum({component}) AS DECIMAL(18,6))" if component in AMOUNTS else f"sum({component})"


@query
def gold_metrics_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored view over the stored table, after a full publication."""
    return spark.table(_published_lake(spark, sf_dir).metrics_view)


@query
def zero_denominators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios at the grain of a report row, where zero denominators do occur."""
    return with_metrics(_silver_a(spark, sf_dir)).groupBy("campaign_id").agg(
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_unknown")
          for name in ("roas", "cpa", "ctr", "cpc")],
        F.sum("cpa").cast("decimal(28,6)").alias("cpa_sum"),
        F.sum("ctr").cast("decimal(28,6)").alias("ctr_sum"),
    )


@query
def restated_gold_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the correction changed, per campaign-day: the latest of all against the latest of
    the extractions before it."""
    restated = conform(network_named(GOOGLE_ADS), _restated_a(spark, sf_dir))
    rows = _conformed_a(spark, sf_dir).unionByName(restated)
    earlier = F.col("_extracted_at") < F.lit(star.RESTATED_A).cast("date")
    return change_of_versions(latest_twice(rows, WINDOW_KEY, NEWEST_FIRST, earlier), CAMPAIGN_DAY)


@query
def late_restatement_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load and publish seven years, then load a correction and publish its months."""
    lake = _long_lake(spark, sf_dir)
    publish(lake)
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    corrected = star.restated_report(report)
    write_object(corrected, lake.landing, GOOGLE_ADS, star.RESTATED_A, "restated")
    restate(lake, GOOGLE_ADS, star.RESTATED_A)
    return lake.table(GOLD)


@query
def late_restatement_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction loaded three times: Gold holds it once."""
    lake = _published_lake(spark, sf_dir)
    for _ in range(3):
        restate(lake, GOOGLE_ADS, star.RESTATED_E)
    return lake.table(GOLD)


@query
def daily_restatement_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily extractions published, then a month of daily corrections restated at once.

    A correction may share its extraction with the reports of another day.
    """
    lake = _daily_lake(spark, sf_dir)
    publish(lake)
    google, _ = _reports(lake, sf_dir)
    late = F.date_add("segments_date", star.CORRECTION_LAG_DAYS)
    corrected = star.restated_report(google).withColumn("extracted_at", late)
    write_reports(corrected, lake.landing, GOOGLE_ADS, append=True)
    days = extraction_days(spark, lake.landing, GOOGLE_ADS)
    restate_days(lake, GOOGLE_ADS, [day for day in days if day >= star.EXTRACTED_E])
    return lake.table(GOLD)


@query
def touched_months_match_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction of one year of seven: publishing the months it touched gives, month by
    month, what a full rebuild gives."""
    lake = _long_lake(spark, sf_dir)
    publish(lake)
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    corrected = star.restated_report(report).filter(F.year("segments_date") == 1995)
    write_object(corrected, lake.landing, GOOGLE_ADS, star.RESTATED_A, "restated")
    touched = restate(lake, GOOGLE_ADS, star.RESTATED_A).months
    full = campaign_daily(silver_rows(lake))
    compared = quality.reconcile(lake.table(GOLD), full, [REPORT_MONTH])
    return compared.select(
        REPORT_MONTH, F.col(REPORT_MONTH).isin(touched).alias("was_touched"), "reconciles"
    )


@query
def drop_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month after one month was dropped."""
    lake = _long_lake(spark, sf_dir)
    build_silver(lake)
    lake.drop_partitions(SILVER, [{REPORT_MONTH: "199803"}])
    return lake.table(SILVER).groupBy(REPORT_MONTH).agg(F.count(F.lit(1)).alias("row_count"))


@query
def months_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _conformed_a(spark, sf_dir).unionByName(_conformed_b(spark, sf_dir))
    return silver.select(REPORT_MONTH).distinct().orderBy(REPORT_MONTH)


# --- quality --------------------------------------------------------------------------------


@query
def grain_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before the latest version is picked the key repeats, afterwards it does not."""
    lineitem = star.read(spark, sf_dir, "lineitem")
    order_line = ["l_orderkey", "l_linenumber"]
    raw = quality.grain_uniqueness(lineitem, order_line)
    silver = quality.grain_uniqueness(_silver(spark, sf_dir), WINDOW_KEY)
    return raw.withColumn("layer", F.lit("raw")).unionByName(
        silver.withColumn("layer", F.lit("silver"))
    )


@query
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_audit(_silver(spark, sf_dir))


@query
def reconciliation_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored Gold against stored Silver, both sides shown."""
    lake = _long_lake(spark, sf_dir)
    publish(lake)
    compared = quality.reconcile(lake.table(GOLD), lake.table(SILVER), [REPORT_MONTH])
    shown = [
        F.col(f"{side}_{name}").cast("decimal(28,6)").alias(f"{side}_{name}")
        for side in ("left", "right")
        for name in COMPONENTS
    ]
    return compared.select(REPORT_MONTH, *shown, "reconciles")


@query
def conservation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices dealt over the products add up to the campaign-days they were dealt from."""
    hundredfold = F.expr("cast(clicks * 100 as bigint)").alias("clicks")
    grain = ["account_id", "campaign_id", "report_date"]
    whole = _event_campaign_days(spark, sf_dir).select(*grain, "whole", hundredfold)
    parts = synthetic.share_points(whole, DEFAULT_SEED).withColumns(
        {name: synthetic.slice_of(name) for name in ("whole", "clicks")}
    )
    return quality.conservation(parts, whole, grain)


@query
def schema_conformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each column of the landed reports: its type, whether it is the declared one, values held."""
    lake = _loaded_lake(spark, sf_dir)
    found = []
    for source, day in ((GOOGLE_ADS, star.EXTRACTED_E), (META_ADS, star.EXTRACTED_B)):
        network = network_named(source)
        prefix = extraction_prefix(lake.landing, source, day)
        landed = spark.read.parquet(f"{prefix}/*.parquet")
        found.append(
            quality.column_audit(landed, T.StructType.fromDDL(network.report_ddl)).withColumn(
                "source", F.lit(source)
            )
        )
    return found[0].unionByName(found[1])


@query
def landed_files_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each landed extraction by its footers, and whether its files are as declared."""
    lake = _loaded_lake(spark, sf_dir)
    found = [
        landed_files(spark, lake.landing, source).withColumn("source", F.lit(source))
        for source in (GOOGLE_ADS, META_ADS)
    ]
    return found[0].unionByName(found[1]).groupBy("source", "_extracted_at").agg(
        F.sum("row_count").alias("row_count"), F.every("conforms").alias("conforms")
    )


@query
def stored_files_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each month of Silver by its footers, its codecs, and whether files are in order."""
    files = _published_lake(spark, sf_dir).files(SILVER)
    return files.groupBy("partition").agg(
        F.sum("row_count").alias("row_count"),
        F.array_join(F.collect_set("codecs"), ",").alias("codecs"),
        F.every("in_order").alias("in_order"),
        F.every(F.col("writer").isNotNull()).alias("is_stamped"),
    )


@query
def catalog_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared, catalogued and stored types of every column, and the rows that hold it."""
    return _published_lake(spark, sf_dir).columns()


@query
def gold_components_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of stored Gold with the values they hold: keys and components, no ratio."""
    gold = _published_lake(spark, sf_dir).table(GOLD)
    audit = quality.column_audit(gold, gold.schema).select("column_name", "filled")
    return audit.withColumn("is_component", F.col("column_name").isin(*COMPONENTS))


@query
def slice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column totals over filtered slices of the raw report."""
    report = star.google_report(star.read(spark, sf_dir, "lineitem"))
    return report.filter(F.col("campaign_id").isin("RF", "RO")).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("cost_micros").alias("cost_micros"),
        F.sum("clicks").alias("clicks"),
        F.sum("revenue_eur").cast("decimal(28,2)").alias("revenue_eur"),
    )


@query
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum is blind to how rows are grouped and notices a duplicate and a changed value."""
    bronze = _bronze_a(spark, sf_dir)
    chosen = (F.col("clicks") == 50).cast("bigint")
    states = {
        "doubled": (1 + chosen, {}),
        "revised": (F.lit(1), {"clicks": F.col("clicks") + chosen}),
    }
    prints = quality.fingerprint_states(bronze, states, ["_ingested_at"], parts="account_id")
    base = F.max(F.when(F.col("state") == "base", F.col("checksum")))

    def sums_to_base(state: str) -> Column:
        return F.max(F.when(F.col("state") == state, F.col("checksum"))) == base

    return prints.agg(
        F.max(F.when(F.col("state") == "base", F.col("row_count"))).alias("row_count"),
        sums_to_base("merged").alias("same_when_shuffled"),
        sums_to_base("doubled").alias("same_when_doubled"),
        sums_to_base("revised").alias("same_when_revised"),
    )


# --- synthetic reports ----------------------------------------------------------------------


def _event_campaign_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign-days found in the events, with a whole that splits into cents per point."""
    report = star.meta_report(star.read(spark, sf_dir, "events"))
    return report.select(
        "account_id",
        "campaign_id",
        F.col("date_start").alias("report_date"),
        (F.col("spend") * 1_000_000).cast("bigint").alias("whole"),
        "clicks",
    )


@query
def product_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign-days dealt out over a hundred products add up to themselves again."""
    shared = synthetic.share_points(_event_campaign_days(spark, sf_dir), DEFAULT_SEED)
    slices = shared.withColumn("part", synthetic.slice_of("whole"))
    is_flagship = F.col("product_id") == "sku_77"
    return slices.groupBy("account_id", "campaign_id", "report_date").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum("points").alias("points"),
        F.sum("part").alias("parts"),
        F.max(F.when(is_flagship, F.col("part"))).alias("flagship_part"),
    )


@query
def scaled_campaign_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaling a campaign-day by a drawn factor leaves its ratio as it was."""
    days = _event_campaign_days(spark, sf_dir)
    scaled = days.withColumn("factor", synthetic.scale_factor(DEFAULT_SEED)).select(
        "account_id",
        "campaign_id",
        "report_date",
        F.col("factor").between(1, 5).alias("factor_in_range"),
        micros_to_amount("whole * factor").alias("spend_eur"),
        (F.col("clicks") * F.col("factor")).alias("clicks"),
        F.lit(0).cast("bigint").alias("impressions"),
        F.lit(0).cast("bigint").alias("conversions"),
        F.lit(0).cast("decimal(18,6)").alias("revenue_eur"),
    )
    return with_metrics(scaled).select(
        "account_id", "campaign_id", "report_date", "factor_in_range", "cpc"
    )
