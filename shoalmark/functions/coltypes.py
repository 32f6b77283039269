"""Recognising and reading typed values in text columns.

Every predicate is a plain Column that is true or false, never NULL, for a non-NULL cell. Regular
expressions decide the shape; ``try_cast`` decides whether the value exists (no 30 February).
No format-driven parser is used: a failing parse there costs a Java exception per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import blank_to_null, strip

# The inferred types in the order they are tried, and the share a type must reach.
BOOLEAN, INTEGER, BIGINT, DOUBLE = "BOOLEAN", "INTEGER", "BIGINT", "DOUBLE"
DATE, TIMESTAMP, VARCHAR = "DATE", "TIMESTAMP(6)", "VARCHAR"
TYPE_ORDER = (BOOLEAN, INTEGER, BIGINT, DOUBLE, DATE, TIMESTAMP)
MATCH_SHARE = 0.90

# Boolean words.
TRUE_WORDS = ("true", "yes", "1")
FALSE_WORDS = ("false", "no", "0")

SPARK_TYPES = {
    BOOLEAN: "boolean",
    INTEGER: "int",
    BIGINT: "bigint",
    DOUBLE: "double",
    DATE: "date",
    TIMESTAMP: "timestamp",
    VARCHAR: "string",
}
TYPE_OF_SPARK = {spark: name for name, spark in SPARK_TYPES.items()}

# Accepted shapes. Dates are Y-m-d, Y/m/d, d/m/Y, m/d/Y, d-m-Y and m-d-Y; timestamps
# are an ISO date, then T or a blank, a time of day, up to six decimals, and after T perhaps a Z.
_WHOLE = r"^-?[0-9]+$"
_REAL = r"^-?[0-9]+(\.[0-9]*([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_YEAR = "(?!0000)[0-9]{4}"
_YEAR_FIRST = rf"^{_YEAR}([-/])[0-9]{{1,2}}\1[0-9]{{1,2}}$"
_YEAR_LAST = rf"^([0-9]{{1,2}})([-/])([0-9]{{1,2}})\2({_YEAR})$"
_CLOCK = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,6})?"
_MOMENT = rf"^{_YEAR}-[0-9]{{1,2}}-[0-9]{{1,2}}(T{_CLOCK}Z?| {_CLOCK})$"


# The functions below take a cell that is stripped already. Their first tests compare bytes, which
# spares most cells the regular expressions.


def _numeric_start(v: Column) -> Column:
    """First character between ``+`` and ``9`` in byte order: sign, point or digit among them."""
    return (v >= "+") & (v < ":")


def _whole(v: Column) -> Column:
    return _numeric_start(v) & v.rlike(_WHOLE)


def _boolean(v: Column) -> Column:
    word = F.lower(v)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def _integer(v: Column) -> Column:
    return F.when(_whole(v), v.try_cast("int"))


def _bigint(v: Column) -> Column:
    return F.when(_whole(v), v.try_cast("bigint"))


def _double(v: Column) -> Column:
    return F.when(_numeric_start(v) & v.rlike(_NUMBER), v.try_cast("double"))


def _date(v: Column) -> Column:
    day_first = F.regexp_replace(v, _YEAR_LAST, "$4-$3-$1").try_cast("date")
    month_first = F.regexp_replace(v, _YEAR_LAST, "$4-$1-$3").try_cast("date")
    possible = _numeric_start(v) & F.length(v).between(8, 10)
    return F.when(
        possible & v.rlike(_YEAR_FIRST), F.translate(v, "/", "-").try_cast("date")
    ).when(possible & v.rlike(_YEAR_LAST), F.coalesce(day_first, month_first))


def _timestamp(v: Column) -> Column:
    possible = _numeric_start(v) & F.contains(v, F.lit(":"))
    return F.when(possible & v.rlike(_MOMENT), F.rtrim(v, F.lit("Z")).try_cast("timestamp"))


_READERS = {
    BOOLEAN: _boolean,
    INTEGER: _integer,
    BIGINT: _bigint,
    DOUBLE: _double,
    DATE: _date,
    TIMESTAMP: _timestamp,
}


def read_stripped(v: Column, type_name: str) -> Column:
    """A stripped cell as ``type_name``; NULL if it does not read as that."""
    return v if type_name == VARCHAR else _READERS[type_name](v)


# Kinds of cells. A cell has one kind, found by a single CASE; a type counts several kinds.
WORD, BIT, INT32, INT64, WHOLE, REAL, NUMBER, DAY, MOMENT = range(1, 10)
MATCHING = {
    BOOLEAN: (WORD, BIT),
    INTEGER: (BIT, INT32),
    BIGINT: (BIT, INT32, INT64, WHOLE),
    DOUBLE: (REAL,),
    DATE: (DAY,),
    TIMESTAMP: (MOMENT,),
}
READABLE = MATCHING | {
    BIGINT: (BIT, INT32, INT64),
    DOUBLE: (BIT, INT32, INT64, WHOLE, REAL, NUMBER),
}


def kind_of(v: Column) -> Column:
    """Kind of a stripped cell; zero for plain text.

    BIT is 0 or 1, WHOLE an integer too large for 64 bits, REAL a number with a decimal point or an
    exponent, NUMBER one that only reads as a number (``+5``, ``.5``).
    """
    word = F.lower(v)
    whole = (
        F.when(v.try_cast("int").isNotNull(), INT32)
        .when(v.try_cast("bigint").isNotNull(), INT64)
        .otherwise(WHOLE)
    )
    day = F.when(_date(v).isNotNull(), DAY).otherwise(0)
    moment = F.when(_timestamp(v).isNotNull(), MOMENT).otherwise(0)
    number = (
        F.when(v.isin("0", "1"), BIT)
        .when(F.contains(v, F.lit(":")), moment)
        .when(F.contains(v, F.lit("/")), day)
        .when(v.rlike(_WHOLE), whole)
        .when(v.rlike(_REAL), REAL)
        .when(v.rlike(_NUMBER), NUMBER)
        .otherwise(day)
    )
    return (
        F.when(_numeric_start(v), number)
        .when(word.isin(*TRUE_WORDS, *FALSE_WORDS), WORD)
        .otherwise(0)
    )


def matches(c: Column, type_name: str) -> Column:
    """Whether a cell counts for ``type_name`` in the inference.

    BIGINT takes any whole number, also one too large to be read, and DOUBLE only a number that
    shows a decimal point or an exponent. The others take what can be read.
    """
    return kind_of(strip(c)).isin(*MATCHING[type_name])


def read_as(c: Column, type_name: str) -> Column:
    """The cell as ``type_name``; blank or unreadable cells become NULL.

    Of a date that can be both, the day comes first. A Z behind a time is part of the text only;
    times are taken in the session zone (UTC). Text is not stripped.
    """
    return blank_to_null(c) if type_name == VARCHAR else read_stripped(strip(c), type_name)
