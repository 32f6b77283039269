"""Declarative data-quality checks.

All row-level checks of a table share one aggregate over one scan. A uniqueness check adds one
shuffle of its column, a custom query runs as written. Everything is a lazy DataFrame with one row
per check; ``run_suite`` adds error isolation around it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import ERROR_LIMIT

log = logging.getLogger(__name__)

# Status words and check types.
PASSED, FAILED, ERROR = "passed", "failed", "error"
UNIQUENESS, CUSTOM_SQL, ROW_COUNT = "uniqueness", "custom_sql", "row_count_range"

# What a faulty check can raise: errors of Spark and of file systems, missing or unexpected parameters.
_PROBLEMS = (PySparkException, Py4JJavaError, KeyError, TypeError)

RESULT_COLUMNS = [
    "check_name",
    "check_type",
    "table_name",
    "column_name",
    "status",
    "failing_rows",
    "total_rows",
    "details",
]


class QualityGateError(RuntimeError):
    """At least one check did not pass."""


@dataclass(frozen=True)
class Check:
    """One check on one table."""

    name: str
    check_type: str
    table_name: str
    column_name: str | None = None
    params: dict[str, Any] = field(default_factory=dict)


# The suite for the sales table.
SALES_COUNTRIES = [
    "Italy",
    "Germany",
    "France",
    "United States",
    "Spain",
    "United Kingdom",
    "Netherlands",
    "Japan",
    "Canada",
    "Brazil",
]
SALES_SUITE = [
    Check("sales_order_id_unique", "uniqueness", "sales", "order_id"),
    Check("sales_order_id_not_null", "not_null", "sales", "order_id"),
    Check("sales_amount_positive", "positive", "sales", "amount"),
    Check(
        "sales_amount_reasonable_range",
        "range",
        "sales",
        "amount",
        {"min_value": 0.01, "max_value": 100000.0},
    ),
    Check(
        "sales_country_accepted", "accepted_values", "sales", "country", {"accepted": SALES_COUNTRIES}
    ),
    Check("sales_ingestion_date_not_future", "no_future_dates", "sales", "ingestion_date"),
    Check(
        "sales_row_count_reasonable",
        "row_count_range",
        "sales",
        None,
        {"min_count": 1, "max_count": 100000},
    ),
    Check("sales_customer_id_not_null", "not_null", "sales", "customer_id"),
]


def _accepted(c: Column, accepted: list[Any]) -> Column:
    return ~c.isin(*accepted) if accepted else c.isNotNull()


def _outside(c: Column, min_value: float, max_value: float) -> Column:
    return ~c.between(F.lit(min_value), F.lit(max_value))


# What makes a row fail. A NULL cell gives NULL, which does not count.
ROW_RULES: dict[str, Callable[..., Column]] = {
    "not_null": lambda c: c.isNull(),
    "accepted_values": _accepted,
    "positive": lambda c: c <= 0,
    "range": _outside,
    "no_future_dates": lambda c: c > F.current_date(),
}

# Detail texts, for passing and for failing checks.
DETAILS = {
    "uniqueness": ("All values unique", "{failing} duplicate value(s) found"),
    "not_null": ("No NULLs", "{failing} NULL value(s)"),
    "accepted_values": (
        "All values in accepted set",
        "{failing} row(s) with values outside accepted set",
    ),
    "positive": ("All values positive", "{failing} row(s) with non-positive values"),
    "range": (
        "All values within [{min_value}, {max_value}]",
        "{failing} row(s) outside range [{min_value}, {max_value}]",
    ),
    "row_count_range": (
        "Row count {total} within [{min_count}, {max_count}]",
        "Row count {total} outside [{min_count}, {max_count}]",
    ),
    "no_future_dates": ("No future dates", "{failing} row(s) with future dates"),
    "custom_sql": ("Custom SQL check passed", "{failing} failing row(s) from custom query"),
}


def _filled_in(template: str, check: Check, failing: Column, total: Column) -> Column:
    """The template with its figures, as a Column."""
    values: dict[str, Column] = {"failing": failing, "total": total}
    values.update({k: F.lit(str(v)) for k, v in check.params.items()})
    pieces: list[Column] = []
    for n, part in enumerate(template.replace("}", "{").split("{")):
        pieces.append(values[part].cast("string") if n % 2 else F.lit(part))
    return F.concat(*pieces)


def _result(position: int, check: Check, failing: Column, total: Column) -> Column:
    passed, failed = DETAILS[check.check_type]
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.check_type).alias("check_type"),
        F.lit(check.table_name).alias("table_name"),
        F.lit(check.column_name or "").alias("column_name"),
        F.when(failing == 0, PASSED).otherwise(FAILED).alias("status"),
        failing.alias("failing_rows"),
        total.alias("total_rows"),
        F.when(failing == 0, _filled_in(passed, check, failing, total))
        .otherwise(_filled_in(failed, check, failing, total))
        .alias("details"),
    )


def _failing(check: Check, total: Column, failed: Column) -> Column:
    """Failing count from the row count of the table and the count of failed rows."""
    if check.check_type != ROW_COUNT:
        return failed
    inside = (total >= check.params["min_count"]) & (total <= check.params["max_count"])
    return F.when(inside, 0).otherwise(1).cast("bigint")


def _fused(checks: list[tuple[int, Check]], table: DataFrame) -> DataFrame:
    """All checks of one table but custom queries, from one scan.

    Row rules are counted in one aggregate. If there is a uniqueness check, they are counted per
    value of its column and then added up, so the table is still read once; values are counted in
    each task first, so a hot value is harmless. Further unique columns take a scan each.
    """
    unique = [(i, c) for i, c in checks if c.check_type == UNIQUENESS]
    plain = [(i, c) for i, c in checks if c.check_type != UNIQUENESS]
    rules = {
        f"f{i}": F.count_if(ROW_RULES[c.check_type](F.col(c.column_name), **c.params))
        for i, c in plain
        if c.check_type != ROW_COUNT
    }
    counts = [F.count("*").alias("total"), *[rule.alias(name) for name, rule in rules.items()]]
    if unique:
        name = unique[0][1].column_name
        repeated = (F.col("total") > 1) & F.col(name).isNotNull()
        counted = (
            table.groupBy(name)
            .agg(*counts)
            .agg(
                F.count_if(repeated).alias("repeated"),
                *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", *rules)],
            )
        )
    else:
        counted = table.agg(*counts)
    total = F.col("total")
    rows = [
        _result(i, c, _failing(c, total, F.col(f"f{i}") if f"f{i}" in rules else total), total)
        for i, c in plain
    ]
    rows += [_result(i, c, F.col("repeated"), total) for i, c in unique[:1]]
    found = counted.select(F.inline(F.array(*rows)))
    for other in unique[1:]:
        found = found.unionByName(_fused([other], table))
    return found


def _custom(spark: SparkSession, position: int, check: Check, table: DataFrame) -> DataFrame:
    """Rows returned by the query are the failing ones. ``args`` fill its named parameters."""
    rows = spark.sql(check.params["sql"], args=check.params.get("args"))
    figures = rows.agg(F.count("*").alias("failing")).withColumn(
        "total", table.agg(F.count("*")).scalar()
    )
    return figures.select(
        F.inline(F.array(_result(position, check, F.col("failing"), F.col("total"))))
    )


def _problem(check: Check, tables: Mapping[str, DataFrame]) -> str | None:
    """Why a check cannot be run at all."""
    if check.check_type not in DETAILS:
        return f"Unknown check type: {check.check_type}"
    if check.table_name not in tables:
        return f"Error: unknown table {check.table_name}"
    needs_column = check.check_type not in (CUSTOM_SQL, ROW_COUNT)
    if needs_column and check.column_name not in tables[check.table_name].columns:
        return f"Error: unknown column {check.column_name}"
    return None


def _planned(
    spark: SparkSession, checks: list[tuple[int, Check]], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Results with the position of their check; names may repeat."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for position, check in checks:
        if check.check_type == CUSTOM_SQL:
            parts.append(_custom(spark, position, check, tables[check.table_name]))
        else:
            by_table.setdefault(check.table_name, []).append((position, check))
    parts.extend(_fused(group, tables[name]) for name, group in by_table.items())
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def plan_suite(
    spark: SparkSession, checks: list[Check], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Results of all checks as one lazy DataFrame; for checks known to be valid."""
    return _planned(spark, list(enumerate(checks)), tables).drop("position")


def _error(check: Check, message: str) -> dict[str, Any]:
    return {
        "check_name": check.name,
        "check_type": check.check_type,
        "table_name": check.table_name,
        "column_name": check.column_name or "",
        "status": ERROR,
        "failing_rows": 0,
        "total_rows": 0,
        "details": message,
    }


def run_suite(
    spark: SparkSession, checks: list[Check], tables: Mapping[str, DataFrame]
) -> list[dict[str, Any]]:
    """Run all checks; one result per check, in the given order.

    Checks that name an unknown type, table or column are errors from the start. Custom queries
    run one by one. The rest run together; only if that fails does each run alone, so that one
    bad check does not spoil others.
    """
    results: dict[int, dict[str, Any]] = {}
    together: list[tuple[int, Check]] = []
    alone: list[tuple[int, Check]] = []
    for position, check in enumerate(checks):
        problem = _problem(check, tables)
        if problem:
            results[position] = _error(check, problem)
        else:
            (alone if check.check_type == CUSTOM_SQL else together).append((position, check))

    def collect(group: list[tuple[int, Check]]) -> None:
        for row in _planned(spark, group, tables).collect():
            found = row.asDict()
            results[found.pop("position")] = found

    try:
        if together:
            collect(together)
    except _PROBLEMS as problem:
        log.warning("checks failed as a whole, running them one by one: %s", problem)
        alone = together + alone
    for position, check in alone:
        try:
            collect([(position, check)])
        except _PROBLEMS as problem:
            log.warning("check %s failed: %s", check.name, problem)
            results[position] = _error(check, f"Error: {str(problem)[:ERROR_LIMIT]}")
    return [results[position] for position in range(len(checks))]


def results_frame(spark: SparkSession, results: list[dict[str, Any]]) -> DataFrame:
    """Results as a DataFrame: one row per check."""
    schema = (
        "check_name string, check_type string, table_name string, column_name string, "
        "status string, failing_rows bigint, total_rows bigint, details string"
    )
    return spark.createDataFrame([tuple(r[c] for c in RESULT_COLUMNS) for r in results], schema)


def tally(results: DataFrame) -> DataFrame:
    """``status, checks, check_names`` over the rows of one run (one per check)."""
    return results.groupBy("status").agg(
        F.count("*").alias("checks"),
        F.array_join(F.array_sort(F.collect_list("check_name")), ", ").alias("check_names"),
    )


def gate(results: list[dict[str, Any]]) -> int:
    """Number of passed checks; raises with the names of the others if there are any."""
    problems = [r["check_name"] for r in results if r["status"] != PASSED]
    if problems:
        raise QualityGateError(
            f"{len(problems)} of {len(results)} checks did not pass: {', '.join(problems)}"
        )
    return len(results)


def failure_trend(history: DataFrame) -> DataFrame:
    """Passed, failed and erroneous checks per day, newest first."""
    return (
        history.groupBy(F.to_date("executed_at").alias("check_date"))
        .agg(
            *[
                F.count_if(F.col("status") == s).alias(s)
                for s in (PASSED, FAILED, ERROR)
            ]
        )
        .orderBy(F.desc("check_date"))
    )
