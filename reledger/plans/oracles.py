"""The registered queries as plain SQL over the same tables, for a second engine to run.

Decimal division is a double there, so truncated ratios are written with whole numbers.
"""

from __future__ import annotations

from reledger import fixed_values as fixed
from reledger.fixed_values import (
    CAMPAIGN_DAILY_REPORT,
    EXTRACTION_LAG_DAYS,
    GOOGLE_ADS,
    META_ADS,
)
from reledger.lake import GOLD, GOOGLE_RAW, META_RAW, SILVER, TABLES, Table
from reledger.sources import star_schema as star

REPORT_A = """
SELECT CAST(l_suppkey AS VARCHAR) AS account_id,
       l_returnflag || l_linestatus AS campaign_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_shipdate AS DATE) AS segments_date,
       CAST(round(l_extendedprice * 100) AS BIGINT)
         * CAST(round(l_discount * 100) AS BIGINT) * 100 AS cost_micros,
       CAST(l_quantity AS BIGINT) AS clicks,
       CAST(l_quantity AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) * 10 AS impressions,
       CAST(l_linenumber - 1 AS BIGINT) AS conversions,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue_eur
FROM lineitem
"""

REPORT_B = """
SELECT CAST(user_id % 10 AS VARCHAR) AS account_id,
       event_type AS campaign_id,
       CAST(ts AS DATE) AS date_start,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS spend,
       count(*) FILTER (event_type <> 'view') AS clicks,
       count(*) AS impressions,
       count(*) FILTER (event_type = 'purchase') AS conversions,
       CAST(sum(CASE WHEN event_type IN ('purchase', 'signup')
                     THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2))
         AS revenue_eur
FROM events GROUP BY 1, 2, 3
"""

REPORT_E = """
SELECT CAST(user_id % 10 AS VARCHAR) AS account_id,
       event_type AS campaign_id,
       CAST(user_id AS VARCHAR) AS product_id,
       CAST(ts AS DATE) AS segments_date,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) * 10000 AS BIGINT) AS cost_micros,
       count(*) FILTER (event_type <> 'view') AS clicks,
       count(*) AS impressions,
       count(*) FILTER (event_type = 'purchase') AS conversions,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue_eur
FROM events GROUP BY 1, 2, 3, 4
"""

RESTATED = """
SELECT * REPLACE (conversions + 7 AS conversions,
                  CAST(revenue_eur + 100.00 AS DECIMAL(18,2)) AS revenue_eur)
FROM {0} WHERE campaign_id LIKE 'R%' OR campaign_id = 'purchase'
"""

MICROS = "CAST(CAST({0} AS DECIMAL(19,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6))"
MONTH = "CAST(year({0}) * 100 + month({0}) AS INTEGER)"


def _conformed_a(report: str, day: str) -> str:
    return f"""
SELECT 'google_ads' AS source, account_id, segments_date AS report_date, campaign_id,
       product_id, {MICROS.format("cost_micros")} AS spend_eur, clicks, impressions,
       conversions, CAST(revenue_eur AS DECIMAL(18,6)) AS revenue_eur,
       DATE '{day}' AS _extracted_at, {MONTH.format("segments_date")} AS report_month
FROM {report}
"""


CONFORMED_B = f"""
SELECT 'meta_ads' AS source, account_id, date_start AS report_date, campaign_id,
       '__unknown__' AS product_id, CAST(spend AS DECIMAL(18,6)) AS spend_eur, clicks,
       impressions, conversions, CAST(revenue_eur AS DECIMAL(18,6)) AS revenue_eur,
       DATE '{star.EXTRACTED_B}' AS _extracted_at, {MONTH.format("date_start")} AS report_month
FROM report_b
"""


def _latest(rows: str) -> str:
    return f"""
SELECT * FROM ({rows})
QUALIFY row_number() OVER (
    PARTITION BY source, account_id, report_date, campaign_id, product_id
    ORDER BY _extracted_at DESC, spend_eur DESC, clicks DESC, impressions DESC,
             conversions DESC, revenue_eur DESC) = 1
"""


def _union(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM {name}" for name in names)


WITH = f"""
WITH report_a AS ({REPORT_A}),
     report_b AS ({REPORT_B}),
     report_e AS ({REPORT_E}),
     restated_a AS ({RESTATED.format("report_a")}),
     restated_e AS ({RESTATED.format("report_e")}),
     conformed_a AS ({_conformed_a("report_a", star.EXTRACTED_A)}),
     conformed_ra AS ({_conformed_a("restated_a", star.RESTATED_A)}),
     conformed_b AS ({CONFORMED_B}),
     conformed_e AS ({_conformed_a("report_e", star.EXTRACTED_E)}),
     conformed_re AS ({_conformed_a("restated_e", star.RESTATED_E)}),
     silver_a AS ({_latest(_union("conformed_a"))}),
     silver AS ({_latest(_union("conformed_a", "conformed_b"))}),
     silver_ra AS ({_latest(_union("conformed_a", "conformed_ra"))}),
     silver_eb AS ({_latest(_union("conformed_e", "conformed_b"))}),
     silver_reb AS ({_latest(_union("conformed_e", "conformed_re", "conformed_b"))})
"""

SUMS = """
CAST(sum(spend_eur) AS DECIMAL(18,6)) AS spend_eur, CAST(sum(clicks) AS BIGINT) AS clicks,
CAST(sum(impressions) AS BIGINT) AS impressions,
CAST(sum(conversions) AS BIGINT) AS conversions,
CAST(sum(revenue_eur) AS DECIMAL(18,6)) AS revenue_eur
"""


def _ratio(numerator: str, denominator: str) -> str:
    micros = f"CAST(CAST({numerator} AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"
    return MICROS.format(f"({micros} // nullif({denominator}, 0))")


# Rounded half up with whole numbers: twice the scaled quotient plus one, halved.
ROAS = (
    "CAST(CAST((2 * CAST(CAST(revenue_eur AS DECIMAL(38,6)) * 1000000 AS HUGEINT) * 10000"
    " // nullif(CAST(CAST(spend_eur AS DECIMAL(38,6)) * 1000000 AS HUGEINT), 0) + 1) // 2"
    " AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4))"
)
METRICS = (
    f"{ROAS} AS roas, {_ratio('spend_eur', 'conversions')} AS cpa,"
    f" {_ratio('clicks', 'impressions')} AS ctr, {_ratio('spend_eur', 'clicks')} AS cpc"
)


def _gold(silver: str) -> str:
    month = MONTH.format("report_date")
    return f"""
SELECT source, account_id, campaign_id, report_date, {SUMS}, {month} AS report_month
FROM {silver} GROUP BY source, account_id, campaign_id, report_date
"""


def _metrics(rows: str) -> str:
    return f"SELECT *, {METRICS} FROM ({rows})"


def _bronze(source: str, file: str, day: str, report: str, day_column: str) -> str:
    return f"""
SELECT '{source}' AS _source, '{file}' AS _source_file, DATE '{day}' AS _extracted_at,
       '{star.INGESTED_AT}' AS _ingested_at, *, {MONTH.format(day_column)} AS report_month
FROM {report}
"""


def _side_sums(side: str) -> str:
    return ", ".join(
        f"CAST(sum({name}) AS DECIMAL(28,6)) AS {side}_{name}"
        for name in ("spend_eur", "clicks", "impressions", "conversions", "revenue_eur")
    )


BASELINE = f"""
SELECT '{fixed.GOOGLE_ADS}' AS _source, '{fixed.BASELINE_SOURCE_FILE}' AS _source_file,
       DATE '{fixed.BASELINE_EXTRACTED_AT}' AS _extracted_at,
       '{fixed.BASELINE_INGESTED_AT}' AS _ingested_at,
       'acct_' || lpad(CAST(n % {fixed.ACCOUNT_COUNT} + 1 AS VARCHAR), 2, '0') AS account_id,
       'camp_' || lpad(CAST(n // {fixed.ACCOUNT_COUNT} % {fixed.CAMPAIGN_COUNT} + 1 AS VARCHAR),
                       3, '0') AS campaign_id,
       CAST(DATE '{fixed.FIRST_REPORT_DAY}'
            + CAST(n // {fixed.ACCOUNT_COUNT * fixed.CAMPAIGN_COUNT} AS INTEGER) AS DATE)
         AS report_date,
       1000000 * (n + 1) AS cost_micros, 10 * n AS clicks,
       CAST(1000 * n AS DECIMAL(20,0)) AS impressions, n AS conversions
FROM (SELECT o_orderkey AS n FROM orders)
"""

PER_EXTRACTION = """
SELECT '{0}' AS _source, DATE '{1}' AS _extracted_at, count(*) AS row_count FROM {2}
"""

# The rows of the published lake behind each table that holds any.
LOADED_ROWS = {
    GOOGLE_RAW.name: "report_e",
    META_RAW.name: "report_b",
    SILVER.name: "silver_eb",
    GOLD.name: f"({_gold('silver_eb')})",
}


def _stored(table: Table, column: str, value: str) -> str:
    """What files say of a column: nothing of partition columns and of tables without rows."""
    in_files = table.name in LOADED_ROWS and column not in table.partitions
    return value if in_files else "NULL"


ORACLES = {
    "bronze_projection_a": WITH
    + _bronze("google_ads", star.FILE_A, star.EXTRACTED_A, "report_a", "segments_date"),
    "bronze_projection_b": WITH
    + _bronze("meta_ads", star.FILE_B, star.EXTRACTED_B, "report_b", "date_start"),
    "source_file_provenance": WITH
    + """
SELECT 'google_ads' AS _source, 2 * count(*) AS row_count, CAST(2 AS BIGINT) AS file_count,
       CAST(1 AS BIGINT) AS instant_count, CAST(0 AS BIGINT) AS unread_count,
       CAST(0 AS BIGINT) AS foreign_count, true AS is_traced FROM report_e
""",
    "lineage_faults": WITH
    + f"""
SELECT DATE '{star.EXTRACTED_E}' AS _extracted_at, name AS object_name,
       CASE name WHEN 'part-0001.parquet' THEN n WHEN 'part-0002.parquet' THEN 0 ELSE m END
         AS landed_rows,
       n AS loaded_rows, name = 'part-0001.parquet' AS is_traced
FROM (SELECT count(*) AS n FROM report_e), (SELECT count(*) AS m FROM restated_e),
     (VALUES ('part-0001.parquet'), ('part-0002.parquet'), ('part-0003.parquet')) names(name)
UNION ALL
SELECT DATE '{star.RESTATED_E}', 'restated.parquet', count(*), 0, false FROM restated_e
""",
    "bronze_reload_idempotent": WITH
    + f"""
SELECT 'google_ads' AS _source, DATE '{star.EXTRACTED_E}' AS _extracted_at,
       {MONTH.format("segments_date")} AS report_month, count(*) AS rows_before,
       count(*) AS rows_after, true AS is_same, CAST(1 AS BIGINT) AS instant_count
FROM report_e GROUP BY ALL
""",
    "daily_extractions_bronze": WITH
    + f"""
SELECT 'google_ads' AS _source, CAST(segments_date + {EXTRACTION_LAG_DAYS} AS DATE) AS _extracted_at,
       'source=google_ads/report={CAMPAIGN_DAILY_REPORT}/extracted_at='
         || strftime(segments_date + {EXTRACTION_LAG_DAYS}, '%Y-%m-%d') AS object_key,
       *, {MONTH.format("segments_date")} AS report_month
FROM report_e
""",
    "moved_value_noticed": WITH
    + f"""
SELECT {MONTH.format("segments_date")} AS report_month, count(*) AS row_count,
       true AS same_sums, count(*) < 2 AS same_print
FROM report_a GROUP BY ALL
""",
    "bronze_reload_empty": WITH
    + PER_EXTRACTION.format("google_ads", star.EXTRACTED_E, "report_e"),
    "bronze_reload_neighbours": WITH
    + PER_EXTRACTION.format("google_ads", star.EXTRACTED_E, "report_e")
    + "UNION ALL"
    + PER_EXTRACTION.format(
        "google_ads", star.RESTATED_E, "restated_e WHERE cost_micros > 20000000"
    )
    + "UNION ALL"
    + PER_EXTRACTION.format("meta_ads", star.EXTRACTED_B, "report_b"),
    "baseline_rows": BASELINE,
    "baseline_reload": f"""
SELECT count(*) AS row_count, CAST(sum(cost_micros) AS BIGINT) AS cost_micros,
       CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(sum(conversions) AS BIGINT) AS conversions FROM ({BASELINE})
""",
    "lake_round_trip": WITH
    + """
SELECT count(*) AS row_count, CAST(sum(cost_micros) AS BIGINT) AS cost_micros FROM report_a
""",
    "micros_to_currency": WITH
    + f"""
SELECT account_id, product_id, cost_micros, {MICROS.format("cost_micros")} AS spend_eur,
       CAST({MICROS.format("cost_micros")} AS VARCHAR) AS spend_text,
       CAST(CAST(cost_micros // 10000 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
            AS DECIMAL(18,2)) AS whole_cents
FROM report_a
""",
    "silver_conform_a": WITH + "SELECT * FROM conformed_a",
    "silver_conform_b": WITH + "SELECT * FROM conformed_b",
    "silver_union": WITH + "SELECT * FROM silver",
    "latest_wins_lineitem": """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_discount
FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY lineitem.l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_extendedprice DESC, l_discount DESC) = 1
""",
    "latest_event_per_user_type": """
SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""",
    "late_restatement_silver": WITH + "SELECT * FROM silver_ra",
    "slice_counts": WITH
    + """
SELECT campaign_id, count(*) AS row_count,
       count(*) FILTER (campaign_id LIKE '%O' AND conversions = 0) AS open_without_conversion,
       count(DISTINCT account_id) AS account_count,
       count(DISTINCT (account_id, report_date)) AS account_day_count,
       min(report_date) AS first_day
FROM conformed_a WHERE campaign_id IN ('AF', 'NO', 'RF', 'RO') AND clicks > 1
GROUP BY campaign_id
""",
    "campaign_sets": WITH
    + """
SELECT account_id, string_agg(campaign_id, ',' ORDER BY campaign_id) AS campaigns
FROM (SELECT DISTINCT account_id, campaign_id FROM conformed_a) GROUP BY account_id
""",
    "gold_campaign_daily": WITH + _gold("silver"),
    "gold_campaign_metrics": WITH + _metrics(_gold("silver_a")),
    "gold_monthly_metrics": WITH
    + _metrics(
        f"SELECT source, campaign_id, report_month, {SUMS} FROM silver"
        " GROUP BY source, campaign_id, report_month"
    ),
    "gold_account_metrics": WITH
    + _metrics(f"SELECT source, account_id, {SUMS} FROM silver GROUP BY source, account_id"),
    "cross_source_spend": WITH + f"SELECT report_month, {SUMS} FROM silver GROUP BY report_month",
    "gold_month_pruned": WITH
    + f"""
SELECT source, account_id, campaign_id, report_date, {SUMS} FROM silver_a
WHERE report_month = 199803 GROUP BY source, account_id, campaign_id, report_date
""",
    "gold_metrics_view": WITH + _metrics(_gold("silver_eb")),
    "zero_denominators": WITH
    + f"""
SELECT campaign_id, count(*) FILTER (roas IS NULL) AS roas_unknown,
       count(*) FILTER (cpa IS NULL) AS cpa_unknown,
       count(*) FILTER (ctr IS NULL) AS ctr_unknown,
       count(*) FILTER (cpc IS NULL) AS cpc_unknown,
       CAST(sum(cpa) AS DECIMAL(28,6)) AS cpa_sum, CAST(sum(ctr) AS DECIMAL(28,6)) AS ctr_sum
FROM (SELECT *, {METRICS} FROM silver_a) GROUP BY campaign_id
""",
    "restated_gold_delta": WITH
    + f"""
SELECT source, account_id, campaign_id, report_date,
       CAST(a.spend_eur - coalesce(b.spend_eur, 0) AS DECIMAL(18,6)) AS spend_eur,
       a.clicks - coalesce(b.clicks, 0) AS clicks,
       a.impressions - coalesce(b.impressions, 0) AS impressions,
       a.conversions - coalesce(b.conversions, 0) AS conversions,
       CAST(a.revenue_eur - coalesce(b.revenue_eur, 0) AS DECIMAL(18,6)) AS revenue_eur,
       CASE WHEN b.clicks IS NULL THEN 1 ELSE 0 END AS row_change
FROM ({_gold("silver_ra")}) a
LEFT JOIN ({_gold("silver_a")}) b USING (source, account_id, campaign_id, report_date)
WHERE b.clicks IS NULL OR a.spend_eur <> coalesce(b.spend_eur, 0) OR a.clicks <> coalesce(b.clicks, 0)
   OR a.impressions <> coalesce(b.impressions, 0)
   OR a.conversions <> coalesce(b.conversions, 0)
   OR a.revenue_eur <> coalesce(b.revenue_eur, 0)
""",
    "late_restatement_gold": WITH + _gold("silver_ra"),
    "late_restatement_replayed": WITH + _gold("silver_reb"),
    "daily_restatement_gold": WITH + _gold("silver_reb"),
    "touched_months_match_full": WITH
    + """
SELECT DISTINCT report_month,
       report_month IN (SELECT report_month FROM conformed_ra WHERE report_month // 100 = 1995)
         AS was_touched,
       true AS reconciles
FROM silver_ra
""",
    "drop_partition": WITH
    + """
SELECT report_month, count(*) AS row_count FROM silver_a WHERE report_month <> 199803
GROUP BY report_month
""",
    "months_present": WITH
    + """
SELECT DISTINCT report_month
FROM (SELECT report_month FROM conformed_a UNION ALL SELECT report_month FROM conformed_b)
""",
    "grain_uniqueness": WITH
    + """
SELECT 'raw' AS layer, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count,
       sum(n) = count(*) AS is_unique
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'silver' AS layer, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count,
       sum(n) = count(*) AS is_unique
FROM (SELECT count(*) AS n FROM silver
      GROUP BY source, account_id, report_date, campaign_id, product_id)
""",
    "null_audit": WITH
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_rows"
        " FROM silver"
        for name in (
            "source", "account_id", "report_date", "campaign_id", "product_id", "spend_eur",
            "clicks", "impressions", "conversions", "revenue_eur", "_extracted_at",
            "report_month",
        )
    ),
    "reconciliation_by_month": WITH
    + f"""
SELECT report_month, {_side_sums("left")}, {_side_sums("right")}, true AS reconciles
FROM silver_a GROUP BY report_month
""",
    "conservation_check": WITH
    + """
SELECT DISTINCT account_id, campaign_id, date_start AS report_date, true AS is_conserved
FROM report_b
""",
    "schema_conformity": WITH
    + """
SELECT 'google_ads' AS source, column_name, found_type, true AS conforms, filled
FROM (VALUES ('account_id', 'string'), ('campaign_id', 'string'), ('product_id', 'string'),
             ('segments_date', 'date'), ('cost_micros', 'bigint'), ('clicks', 'bigint'),
             ('impressions', 'bigint'), ('conversions', 'bigint'),
             ('revenue_eur', 'decimal(18,2)')) columns_a(column_name, found_type),
     (SELECT count(*) AS filled FROM report_e)
UNION ALL
SELECT 'meta_ads', column_name, found_type, true, filled
FROM (VALUES ('account_id', 'string'), ('campaign_id', 'string'), ('date_start', 'date'),
             ('spend', 'decimal(18,2)'), ('clicks', 'bigint'), ('impressions', 'bigint'),
             ('conversions', 'bigint'), ('revenue_eur', 'decimal(18,2)'))
         columns_b(column_name, found_type),
     (SELECT count(*) AS filled FROM report_b)
""",
    "landed_files_audit": WITH
    + " UNION ALL ".join(
        f"SELECT '{source}' AS source, DATE '{day}' AS _extracted_at, count(*) AS row_count,"
        f" true AS conforms FROM {rows}"
        for source, day, rows in (
            (GOOGLE_ADS, star.EXTRACTED_E, "report_e"),
            (GOOGLE_ADS, star.RESTATED_E, "restated_e"),
            (META_ADS, star.EXTRACTED_B, "report_b"),
        )
    ),
    "stored_files_audit": WITH
    + """
SELECT 'report_month=' || report_month AS partition, count(*) AS row_count, 'zstd' AS codecs,
       true AS in_order, true AS is_stamped
FROM silver_eb GROUP BY report_month
""",
    "catalog_audit": WITH
    + " UNION ALL ".join(
        f"SELECT '{table.layer}.{table.name}' AS table_name, '{column}' AS column_name,"
        f" '{kind}' AS declared_type, '{kind}' AS catalogued_type,"
        f" {str(column in table.partitions).lower()} AS is_partition,"
        f" {_stored(table, column, repr(kind))} AS stored_type,"
        f" {_stored(table, column, f'(SELECT count(*) FROM {LOADED_ROWS.get(table.name)})')}"
        " AS stored_rows, true AS conforms"
        for table in TABLES
        for column, kind in table.columns
    ),
    "gold_components_only": WITH
    + f"""
SELECT column_name, filled, is_component
FROM (VALUES ('source', false), ('account_id', false), ('campaign_id', false),
             ('report_date', false), ('report_month', false), ('spend_eur', true),
             ('clicks', true), ('impressions', true), ('conversions', true),
             ('revenue_eur', true)) columns_gold(column_name, is_component),
     (SELECT count(*) AS filled FROM ({_gold("silver_eb")}))
""",
    "slice_totals": WITH
    + """
SELECT account_id, count(*) AS row_count, CAST(sum(cost_micros) AS BIGINT) AS cost_micros,
       CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(revenue_eur) AS DECIMAL(28,2)) AS revenue_eur
FROM report_a WHERE campaign_id IN ('RF', 'RO') GROUP BY account_id
""",
    "table_fingerprint": """
SELECT count(*) AS row_count, true AS same_when_shuffled, false AS same_when_doubled,
       false AS same_when_revised FROM lineitem
""",
    "product_split": WITH
    + """
SELECT account_id, campaign_id, date_start AS report_date,
       CAST(100 AS BIGINT) AS product_count, CAST(100 AS BIGINT) AS points,
       CAST(spend * 1000000 AS BIGINT) AS parts,
       CAST(spend * 1000000 AS BIGINT) * 10 // 100 AS flagship_part
FROM report_b
""",
    "scaled_campaign_days": WITH
    + f"""
SELECT account_id, campaign_id, date_start AS report_date, true AS factor_in_range,
       {_ratio("spend", "clicks")} AS cpc
FROM report_b
""",
}
