"""Runnable queries over the test tables, each with the SQL that has to give the same rows."""

from . import (
    ingest_queries,
    maintenance_queries,
    metric_queries,
    quality_queries,
    report_queries,
    stream_queries,
    upsert_queries,
    version_queries,
)

MODULES = [
    report_queries,
    quality_queries,
    ingest_queries,
    upsert_queries,
    version_queries,
    maintenance_queries,
    metric_queries,
    stream_queries,
]
