"""Text helpers used by the loaders, the checks and the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as blank at either end of a cell.
WHITESPACE = "".join(
    map(
        chr,
        [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Length limits of the metadata tables.
DETAILS_LIMIT = 1000
ERROR_LIMIT = 500


def fitted(c: Column, limit: int) -> Column:
    """The text as the metadata tables hold it: NULL as empty, at most ``limit`` characters."""
    return F.substring(F.coalesce(c, F.lit("")), 1, limit)


def strip(c: Column) -> Column:
    """Remove blanks of every kind from both ends.

    Most cells begin and end with a visible ASCII character; two comparisons leave those alone.
    """
    last = F.substring(c, -1, 1)
    clean = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def blank_to_null(c: Column) -> Column:
    """NULL when nothing but blanks is left; the untouched cell otherwise."""
    return F.when(strip(c) != "", c)


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def money_label(c: Column) -> Column:
    """Thousands separators and two decimals behind a dollar sign."""
    return F.concat(F.lit("$"), F.format_number(c, 2))


def percent_label(c: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(c, digits), F.lit("%"))
