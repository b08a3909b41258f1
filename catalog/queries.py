"""Importing this module registers all queries."""

from catalog import (  # noqa: F401
    anomalies,
    cleaning,
    enrichment,
    models,
    notices,
    outage_reports,
    reports,
    series,
    sources,
)
