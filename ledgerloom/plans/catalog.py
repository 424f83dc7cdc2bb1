"""All registered queries; importing the family modules fills the registry."""

from __future__ import annotations

from .families import (  # noqa: F401
    audit_queries,
    core_and_marts,
    dashboard_queries,
    features_and_eda,
    ingest_and_cleaning,
    metric_queries,
    quality_queries,
    segments_and_clusters,
)
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
