"""Ingest, quality, maintenance and reporting jobs for a Parquet lake, written for Spark."""
