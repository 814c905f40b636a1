"""Reporting data that survives late corrections, as Spark jobs."""

from reledger.lake import Lake
from reledger.plans.publish import (
    build_gold,
    build_silver,
    publish,
    reload_extraction,
    reload_extractions,
    restate,
    restate_days,
)
from reledger.session import build_session

__all__ = [
    "Lake",
    "build_gold",
    "build_session",
    "build_silver",
    "publish",
    "reload_extraction",
    "reload_extractions",
    "restate",
    "restate_days",
]
