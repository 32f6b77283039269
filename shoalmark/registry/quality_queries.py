"""Quality checks, single and as a suite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import metadata, quality
from ..operators.quality import SALES_SUITE, Check
from ..plans.quality_run import run_gate
from ..session import scratch_path
from .common import SALES_CTE, load, plain, sales_view

PRICES = {"min_value": 0.01, "max_value": 100000.0}
ROWS = {"min_count": 1, "max_count": 100000}


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = ("orders", "customer", "lineitem", "part")
    tables = {n: load(spark, folder, n) for n in names}
    # A column with NULLs, and dates moved a century ahead.
    tables["gaps"] = tables["orders"].select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    tables["ahead"] = tables["orders"].select(F.add_months("o_orderdate", 1200).alias("day"))
    return tables


def _checks(*checks: Check):
    return lambda spark, folder: quality.plan_suite(spark, list(checks), _tables(spark, folder))


UNIQUENESS = _checks(
    Check("orders_unique", "uniqueness", "orders", "o_orderkey"),
    Check("lines_unique", "uniqueness", "lineitem", "l_orderkey"),
)
NOT_NULL = _checks(
    Check("customer_set", "not_null", "orders", "o_custkey"),
    Check("priority_set", "not_null", "gaps", "priority"),
)
ACCEPTED = _checks(
    Check("status_known", "accepted_values", "orders", "o_orderstatus", {"accepted": ["F", "O", "P"]}),
    Check("status_final", "accepted_values", "orders", "o_orderstatus", {"accepted": ["F", "O"]}),
    Check("priority_known", "accepted_values", "gaps", "priority", {"accepted": ["1-URGENT"]}),
)
POSITIVE = _checks(
    Check("price_positive", "positive", "orders", "o_totalprice"),
    Check("balance_positive", "positive", "customer", "c_acctbal"),
)
RANGE = _checks(
    Check("part_price", "range", "part", "p_retailprice", PRICES),
    Check("order_price", "range", "orders", "o_totalprice", PRICES),
)
ROW_COUNT = _checks(
    Check("orders_count", "row_count_range", "orders", None, ROWS),
    Check("lines_count", "row_count_range", "lineitem", None, {"min_count": 1, "max_count": 10}),
)
NO_FUTURE = _checks(
    Check("dates_past", "no_future_dates", "orders", "o_orderdate"),
    Check("dates_ahead", "no_future_dates", "ahead", "day"),
)


def custom_sql(spark: SparkSession, folder: str) -> DataFrame:
    tables = _tables(spark, folder)
    for name in ("orders", "customer"):
        tables[name].createOrReplaceTempView(f"checked_{name}")
    orphans = (
        "SELECT o_orderkey FROM checked_orders LEFT ANTI JOIN checked_customer "
        "ON o_custkey = c_custkey"
    )
    negative = "SELECT c_custkey FROM checked_customer WHERE c_acctbal < :least"
    checks = [
        Check("orders_have_customer", "custom_sql", "orders", None, {"sql": orphans}),
        Check(
            "no_debts", "custom_sql", "customer", None, {"sql": negative, "args": {"least": 0.0}}
        ),
    ]
    return quality.plan_suite(spark, checks, tables)


def suite(spark: SparkSession, folder: str) -> DataFrame:
    return quality.plan_suite(spark, SALES_SUITE, {"sales": sales_view(spark, folder)})


def suite_isolated(spark: SparkSession, folder: str) -> DataFrame:
    """The suite with three faulty checks among it."""
    faulty = [
        Check("type_unknown", "no_such_type", "sales", "amount"),
        Check("column_unknown", "not_null", "sales", "no_such_column"),
        Check("query_broken", "custom_sql", "sales", None, {"sql": "SELECT FROM WHERE"}),
    ]
    tables = {"sales": sales_view(spark, folder)}
    results = quality.run_suite(spark, [*faulty, *SALES_SUITE], tables)
    return quality.results_frame(spark, results).select(
        "check_name", "status", "failing_rows", "total_rows"
    )


def gate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.tally(suite(spark, folder))


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """A result history made of the sales data: one check per country and day."""
    worst = F.max("amount")
    return (
        sales_view(spark, folder)
        .groupBy("ingestion_date", "country")
        .agg(
            F.when(worst > 450000, quality.FAILED)
            .when(worst < 20000, quality.ERROR)
            .otherwise(quality.PASSED)
            .alias("status")
        )
        .select(
            F.concat(F.col("country"), F.lit("_amount")).alias("check_name"),
            "status",
            F.col("ingestion_date").cast("timestamp").alias("executed_at"),
        )
    )


def failure_trend(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.failure_trend(_history(spark, folder)))


def newest_results(spark: SparkSession, folder: str) -> DataFrame:
    return plain(metadata.newest(_history(spark, folder), "executed_at", 20, "check_name"))


def run_and_store(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run: two checks of one name on two tables, stored, read back, then the gate."""
    lake = scratch_path(spark, "quality")
    checks = [
        Check("is_set", "not_null", "gaps", "priority"),
        Check("is_set", "not_null", "orders", "o_custkey"),
        Check("unknown", "no_such_type", "orders", "o_custkey"),
    ]
    try:
        run_gate(spark, lake, checks, _tables(spark, folder), "run-1")
        passed = True
    except quality.QualityGateError:
        passed = False
    stored = metadata.read(spark, lake, metadata.QUALITY_RESULTS)
    return stored.select(
        "check_name", "table_name", "status", "failing_rows", "total_rows", "run_id",
        F.lit(passed).alias("gate"),
    )


QUERIES = {
    "dq_uniqueness": UNIQUENESS,
    "dq_not_null": NOT_NULL,
    "dq_accepted_values": ACCEPTED,
    "dq_positive": POSITIVE,
    "dq_range": RANGE,
    "dq_row_count_range": ROW_COUNT,
    "dq_no_future_dates": NO_FUTURE,
    "dq_custom_sql_orphans": custom_sql,
    "dq_suite_fused": suite,
    "dq_suite_isolated": suite_isolated,
    "dq_gate_summary": gate_summary,
    "dq_failure_trend": failure_trend,
    "dq_newest_results": newest_results,
    "dq_run_and_store": run_and_store,
}


def _row(
    name: str, kind: str, table: str, column: str, failing: str, total: str, good: str, bad: str
) -> str:
    """One result row from SQL for the failing count, the total and the two detail texts."""
    return f"""
SELECT '{name}' AS check_name, '{kind}' AS check_type, '{table}' AS table_name,
       '{column}' AS column_name,
       CASE WHEN failing = 0 THEN 'passed' ELSE 'failed' END AS status,
       failing AS failing_rows, total AS total_rows,
       CASE WHEN failing = 0 THEN {good} ELSE {bad} END AS details
FROM (SELECT CAST(({failing}) AS BIGINT) AS failing, CAST(({total}) AS BIGINT) AS total)"""


def _unique(name: str, table: str, column: str, source: str) -> str:
    return _row(
        name, "uniqueness", table, column,
        f"SELECT COUNT(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING COUNT(*) > 1)",
        f"SELECT COUNT(*) FROM {source}",
        "'All values unique'", "failing || ' duplicate value(s) found'",
    )


def _where(name: str, kind: str, table: str, column: str, source: str, test: str, good: str, bad: str) -> str:
    return _row(
        name, kind, table, column,
        f"SELECT COUNT(*) FROM {source} WHERE {test}", f"SELECT COUNT(*) FROM {source}", good, bad,
    )


def _rows_between(name: str, table: str, low: int, high: int, source: str) -> str:
    n = f"SELECT COUNT(*) FROM {source}"
    return _row(
        name, "row_count_range", table, "",
        f"SELECT CASE WHEN ({n}) BETWEEN {low} AND {high} THEN 0 ELSE 1 END", n,
        f"'Row count ' || total || ' within [{low}, {high}]'",
        f"'Row count ' || total || ' outside [{low}, {high}]'",
    )


_NULLS = ("'No NULLs'", "failing || ' NULL value(s)'")
_ACCEPTED = (
    "'All values in accepted set'", "failing || ' row(s) with values outside accepted set'"
)
_POSITIVE = ("'All values positive'", "failing || ' row(s) with non-positive values'")
_RANGE = (
    "'All values within [0.01, 100000.0]'", "failing || ' row(s) outside range [0.01, 100000.0]'"
)
_FUTURE = ("'No future dates'", "failing || ' row(s) with future dates'")
_CUSTOM = ("'Custom SQL check passed'", "failing || ' failing row(s) from custom query'")
_GAPS = "(SELECT nullif(o_orderpriority, '5-LOW') AS priority FROM orders)"
_AHEAD = "(SELECT o_orderdate + INTERVAL 100 YEAR AS day FROM orders)"
_KNOWN = ", ".join(f"'{c}'" for c in quality.SALES_COUNTRIES)

_SUITE = f"WITH {SALES_CTE}" + " UNION ALL ".join(
    [
        _unique("sales_order_id_unique", "sales", "order_id", "sales"),
        _where("sales_order_id_not_null", "not_null", "sales", "order_id", "sales",
               "order_id IS NULL", *_NULLS),
        _where("sales_amount_positive", "positive", "sales", "amount", "sales", "amount <= 0",
               *_POSITIVE),
        _where("sales_amount_reasonable_range", "range", "sales", "amount", "sales",
               "amount < 0.01 OR amount > 100000", *_RANGE),
        _where("sales_country_accepted", "accepted_values", "sales", "country", "sales",
               f"country NOT IN ({_KNOWN})", *_ACCEPTED),
        _where("sales_ingestion_date_not_future", "no_future_dates", "sales", "ingestion_date",
               "sales", "ingestion_date > current_date", *_FUTURE),
        _rows_between("sales_row_count_reasonable", "sales", 1, 100000, "sales"),
        _where("sales_customer_id_not_null", "not_null", "sales", "customer_id", "sales",
               "customer_id IS NULL", *_NULLS),
    ]
)
_HISTORY = f"""WITH {SALES_CTE}, history AS (
SELECT country || '_amount' AS check_name,
       CASE WHEN MAX(amount) > 450000 THEN 'failed' WHEN MAX(amount) < 20000 THEN 'error'
            ELSE 'passed' END AS status,
       ingestion_date AS day
FROM sales GROUP BY ingestion_date, country)"""

ORACLES = {
    "dq_run_and_store": """
SELECT 'is_set' AS check_name, 'gaps' AS table_name, 'failed' AS status,
  COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS failing_rows, COUNT(*) AS total_rows,
  'run-1' AS run_id, FALSE AS gate FROM orders
UNION ALL SELECT 'is_set', 'orders', 'passed', 0, COUNT(*), 'run-1', FALSE FROM orders
UNION ALL SELECT 'unknown', 'orders', 'error', 0, 0, 'run-1', FALSE""",
    "dq_uniqueness": _unique("orders_unique", "orders", "o_orderkey", "orders")
    + " UNION ALL "
    + _unique("lines_unique", "lineitem", "l_orderkey", "lineitem"),
    "dq_not_null": _where("customer_set", "not_null", "orders", "o_custkey", "orders",
                          "o_custkey IS NULL", *_NULLS)
    + " UNION ALL "
    + _where("priority_set", "not_null", "gaps", "priority", _GAPS, "priority IS NULL", *_NULLS),
    "dq_accepted_values": " UNION ALL ".join(
        [
            _where("status_known", "accepted_values", "orders", "o_orderstatus", "orders",
                   "o_orderstatus NOT IN ('F', 'O', 'P')", *_ACCEPTED),
            _where("status_final", "accepted_values", "orders", "o_orderstatus", "orders",
                   "o_orderstatus NOT IN ('F', 'O')", *_ACCEPTED),
            _where("priority_known", "accepted_values", "gaps", "priority", _GAPS,
                   "priority IS NOT NULL AND priority NOT IN ('1-URGENT')", *_ACCEPTED),
        ]
    ),
    "dq_positive": _where("price_positive", "positive", "orders", "o_totalprice", "orders",
                          "o_totalprice <= 0", *_POSITIVE)
    + " UNION ALL "
    + _where("balance_positive", "positive", "customer", "c_acctbal", "customer",
             "c_acctbal <= 0", *_POSITIVE),
    "dq_range": _where("part_price", "range", "part", "p_retailprice", "part",
                       "p_retailprice < 0.01 OR p_retailprice > 100000", *_RANGE)
    + " UNION ALL "
    + _where("order_price", "range", "orders", "o_totalprice", "orders",
             "o_totalprice < 0.01 OR o_totalprice > 100000", *_RANGE),
    "dq_row_count_range": _rows_between("orders_count", "orders", 1, 100000, "orders")
    + " UNION ALL "
    + _rows_between("lines_count", "lineitem", 1, 10, "lineitem"),
    "dq_no_future_dates": _where("dates_past", "no_future_dates", "orders", "o_orderdate",
                                 "orders", "o_orderdate > current_date", *_FUTURE)
    + " UNION ALL "
    + _where("dates_ahead", "no_future_dates", "ahead", "day", _AHEAD, "day > current_date",
             *_FUTURE),
    "dq_custom_sql_orphans": _row(
        "orders_have_customer", "custom_sql", "orders", "",
        "SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
        "SELECT COUNT(*) FROM orders", *_CUSTOM,
    )
    + " UNION ALL "
    + _row("no_debts", "custom_sql", "customer", "",
           "SELECT COUNT(*) FROM customer WHERE c_acctbal < 0",
           "SELECT COUNT(*) FROM customer", *_CUSTOM),
    "dq_suite_fused": _SUITE,
    "dq_suite_isolated": f"""SELECT check_name, status, failing_rows, total_rows FROM ({_SUITE})
UNION ALL SELECT name, 'error', 0, 0
FROM (VALUES ('type_unknown'), ('column_unknown'), ('query_broken')) AS t(name)""",
    "dq_gate_summary": f"""SELECT status, COUNT(*) AS checks,
string_agg(check_name, ', ' ORDER BY check_name) AS check_names FROM ({_SUITE}) GROUP BY status""",
    "dq_failure_trend": f"""{_HISTORY} SELECT strftime(day, '%Y-%m-%d') AS check_date,
COUNT(*) FILTER (WHERE status = 'passed') AS passed,
COUNT(*) FILTER (WHERE status = 'failed') AS failed,
COUNT(*) FILTER (WHERE status = 'error') AS error FROM history GROUP BY day""",
    "dq_newest_results": f"""{_HISTORY} SELECT check_name, status,
strftime(CAST(day AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS executed_at
FROM history ORDER BY day DESC, check_name LIMIT 20""",
}
