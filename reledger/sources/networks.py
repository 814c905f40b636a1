"""The two ad networks: what they publish and how each becomes the common model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reledger.fixed_values import CONFORMED_AMOUNT, GOOGLE_ADS, META_ADS, UNKNOWN_PRODUCT
from reledger.functions.calendar import REPORT_MONTH, report_month
from reledger.functions.money import micros_to_amount
from reledger.lake import GOOGLE_RAW, META_RAW, SILVER, TECHNICAL, Table


@dataclass(frozen=True)
class Network:
    """One source: its Bronze table, and where the common model finds its values."""

    name: str
    bronze: Table
    day_column: str
    renamed: dict[str, Column]

    @property
    def report_columns(self) -> list[tuple[str, str]]:
        """The columns the network publishes, without the ones added on loading."""
        added = {REPORT_MONTH, *dict(TECHNICAL)}
        return [column for column in self.bronze.columns if column[0] not in added]

    @property
    def report_ddl(self) -> str:
        return ", ".join(f"{name} {ddl_type}" for name, ddl_type in self.report_columns)


def networks() -> dict[str, Network]:
    """The known sources by name. Columns need a running session, hence a function."""
    google = Network(
        GOOGLE_ADS,
        GOOGLE_RAW,
        "segments_date",
        {
            "report_date": F.col("segments_date"),
            "product_id": F.col("product_id"),
            "spend_eur": micros_to_amount("cost_micros"),
        },
    )
    # A campaign-day without a product is a real measurement: its product is unknown, which
    # a sentinel says and a NULL would leave open.
    meta = Network(
        META_ADS,
        META_RAW,
        "date_start",
        {
            "report_date": F.col("date_start"),
            "product_id": F.lit(UNKNOWN_PRODUCT),
            "spend_eur": F.col("spend").cast(CONFORMED_AMOUNT),
        },
    )
    return {network.name: network for network in (google, meta)}


def network_named(name: str) -> Network:
    known = networks()
    if name not in known:
        raise ValueError(f"unknown source {name!r}, expected one of {sorted(known)}")
    return known[name]


def conform(network: Network, bronze: DataFrame) -> DataFrame:
    """Bronze rows of one source as rows of the common model, one for one.

    Two columns that break ties between versions stay on; `latest_version` drops them. Of
    the source file only the object's own name is kept: within one extraction the rest of
    the path is the same, and it would be carried through the shuffle with every row.
    """
    values = {
        "source": F.lit(network.name),
        "revenue_eur": F.col("revenue_eur").cast(CONFORMED_AMOUNT),
        REPORT_MONTH: report_month(F.col(network.day_column)),
        **network.renamed,
    }
    model = [values.get(name, F.col(name)).alias(name) for name, _ in SILVER.columns]
    object_name = F.substring_index("_source_file", "/", -1).alias("_object")
    return bronze.select(*model, "_ingested_at", object_name)
