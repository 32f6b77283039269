"""Operators of a training-data pipeline: scoring, filtering, deduplication, mixing, search.

Nothing else in the library imports this package. Each module holds one operator with a general
interface; ``queries`` holds the thin registered queries that apply them to whole tables.
"""
