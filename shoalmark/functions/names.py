"""Cleaning of column and table names, for single strings and for columns of strings."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

_NOT_ALLOWED = r"[^a-z0-9]+"
PREFIX = "col_"


def clean_name(raw: str) -> str:
    """Lower case, one underscore per run of other characters, never empty, never digit first.

    >>> clean_name("Unit Price (EUR)")
    'unit_price_eur'
    """
    core = re.sub(_NOT_ALLOWED, "_", raw.lower()).strip("_")
    return core if core[:1].isalpha() else PREFIX + core


def clean_name_column(c: Column) -> Column:
    """The same rule on a string column."""
    core = F.trim(F.regexp_replace(F.lower(c), _NOT_ALLOWED, "_"), F.lit("_"))
    return F.when(core.rlike("^[a-z]"), core).otherwise(F.concat(F.lit(PREFIX), core))


def clean_headers(headers: Iterable[str]) -> list[str]:
    """Clean a header list; a name that came up before gets ``_2``, ``_3`` and so on."""
    taken: set[str] = set()
    names: list[str] = []
    for header in headers:
        base = clean_name(header)
        name, n = base, 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        names.append(name)
    return names


def table_of_key(key: Column) -> Column:
    """Target table of a file key: its first folder, cleaned."""
    return clean_name_column(F.split_part(key, F.lit("/"), F.lit(1)))
