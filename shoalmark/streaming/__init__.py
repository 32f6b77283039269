"""Structured Streaming forms of the ingest, upsert and rate jobs."""
