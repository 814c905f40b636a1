"""Values that results depend on. They are contracts, not choices of this library."""

from datetime import date

# --- Fixed values: names a query may refer to -------------------------------------------
GOOGLE_ADS = "google_ads"
META_ADS = "meta_ads"
CAMPAIGN_DAILY_REPORT = "campaign_daily"
UNKNOWN_PRODUCT = "__unknown__"

# --- Fixed values: money ----------------------------------------------------------------
MICROS_PER_UNIT = 1_000_000
REPORTED_AMOUNT = "decimal(18,2)"
CONFORMED_AMOUNT = "decimal(18,6)"
ROAS_TYPE = "decimal(18,4)"

# --- Fixed values: dimensions and calendar of the synthetic reports ---------------------
FIRST_REPORT_DAY = date(2026, 7, 14)
REPORT_DAY_COUNT = 3
ACCOUNT_COUNT = 2
CAMPAIGN_COUNT = 5
PRODUCT_COUNT = 100
EXTRACTION_LAG_DAYS = 1
FLAGSHIP_PRODUCT = 77
PIVOT_ACCOUNT = "acct_01"
PIVOT_CAMPAIGN = "camp_003"
PIVOT_REPORT_DAY = date(2026, 7, 15)
RESTATEMENT_EXTRACTION_DAY = date(2026, 8, 20)
DEFAULT_SEED = 42

# --- Fixed values: what one campaign-day of google_ads is worth -------------------------
GOOGLE_COST_MICROS = 12_345_000_000
GOOGLE_CLICKS = 20_000
GOOGLE_IMPRESSIONS = 1_000_000
GOOGLE_CONVERSIONS = 400
GOOGLE_REVENUE_CENTS = 6_172_500
SHARE_POINTS = 100
FLAGSHIP_POINTS = 10

# --- Fixed values: the late correction of the flagship row ------------------------------
RESTATED_CONVERSIONS = 47
RESTATED_REVENUE_CENTS = 725_000

# --- Fixed values: what the pivot campaign-day of meta_ads is worth ---------------------
META_SPEND_CENTS = 98_765
META_CLICKS = 1_500
META_IMPRESSIONS = 80_000
META_CONVERSIONS = 25
META_REVENUE_CENTS = 395_060
LARGEST_SCALE_FACTOR = 5

# --- Fixed values: the baseline rows ----------------------------------------------------
BASELINE_ROWS = 30
BASELINE_SOURCE_FILE = (
    "s3://lake/raw/source=google_ads/report=campaign_daily"
    "/extracted_at=2026-07-17/part-0001.parquet"
)
BASELINE_EXTRACTED_AT = "2026-07-17"
BASELINE_INGESTED_AT = "2026-07-17 03:00:00"
