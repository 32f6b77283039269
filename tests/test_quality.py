import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoalmark.operators import metadata, quality
from shoalmark.operators.quality import Check, QualityGateError
from shoalmark.plans.quality_run import run_and_store, run_gate

TODAY = dt.date.today()


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        ("a", 1.0, "Italy", TODAY - dt.timedelta(days=1)),
        ("a", -1.0, "Mars", TODAY),
        ("b", 0.0, None, TODAY + dt.timedelta(days=2)),
        ("b", 200000.0, "Spain", None),
        (None, None, "Spain", TODAY),
        (None, 5.0, "Spain", TODAY),
    ]
    sales = spark.createDataFrame(
        rows, "order_id string, amount double, country string, ingestion_date date"
    ).withColumn("customer_id", F.lit("c"))
    return {"sales": sales, "empty": sales.limit(0)}


def run(spark, tables, *checks):
    found = quality.run_suite(spark, list(checks), tables)
    return {r["check_name"]: (r["status"], r["failing_rows"], r["total_rows"]) for r in found}


def test_each_rule(spark, tables):
    got = run(
        spark,
        tables,
        Check("u", "uniqueness", "sales", "order_id"),
        Check("n", "not_null", "sales", "order_id"),
        Check("a", "accepted_values", "sales", "country", {"accepted": ["Italy", "Spain"]}),
        Check("p", "positive", "sales", "amount"),
        Check("r", "range", "sales", "amount", {"min_value": 0.0, "max_value": 200000.0}),
        Check("f", "no_future_dates", "sales", "ingestion_date"),
        Check("c", "row_count_range", "sales", None, {"min_count": 6, "max_count": 6}),
        Check("d", "row_count_range", "sales", None, {"min_count": 7, "max_count": 9}),
        Check("e", "uniqueness", "empty", "order_id"),
        Check("z", "not_null", "empty", "order_id"),
    )
    assert got == {
        "u": ("failed", 2, 6),
        "n": ("failed", 2, 6),
        "a": ("failed", 1, 6),
        "p": ("failed", 2, 6),
        "r": ("failed", 1, 6),
        "f": ("failed", 1, 6),
        "c": ("passed", 0, 6),
        "d": ("failed", 1, 6),
        "e": ("passed", 0, 0),
        "z": ("passed", 0, 0),
    }


def test_timestamps_after_midnight_count_as_future(spark):
    df = spark.range(1).select(
        F.date_add(F.current_date(), 0).cast("timestamp").alias("midnight"),
        (F.current_date().cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("later"),
    )
    got = run(
        spark,
        {"t": df},
        Check("m", "no_future_dates", "t", "midnight"),
        Check("l", "no_future_dates", "t", "later"),
    )
    assert (got["m"][0], got["l"][0]) == ("passed", "failed")


def test_details(spark, tables):
    rows = quality.run_suite(
        spark,
        [
            Check("u", "uniqueness", "sales", "order_id"),
            Check("c", "row_count_range", "sales", None, {"min_count": 1, "max_count": 5}),
            Check("r", "range", "sales", "amount", {"min_value": -1, "max_value": 200000.0}),
        ],
        tables,
    )
    assert [r["details"] for r in rows] == [
        "2 duplicate value(s) found",
        "Row count 6 outside [1, 5]",
        "All values within [-1, 200000.0]",
    ]


def test_custom_sql(spark, tables):
    tables["sales"].createOrReplaceTempView("custom_sales")
    sql = "SELECT * FROM custom_sales WHERE amount > :most"
    got = run(
        spark,
        tables,
        Check("few", "custom_sql", "sales", None, {"sql": sql, "args": {"most": 100.0}}),
        Check("none", "custom_sql", "sales", None, {"sql": sql, "args": {"most": 1e9}}),
    )
    assert got == {"few": ("failed", 1, 6), "none": ("passed", 0, 6)}


def test_errors_stay_with_their_check(spark, tables):
    good = Check("good", "not_null", "sales", "country")
    got = run(
        spark,
        tables,
        Check("type", "no_such_type", "sales", "amount"),
        Check("table", "not_null", "no_such_table", "amount"),
        Check("column", "not_null", "sales", "no_such_column"),
        Check("query", "custom_sql", "sales", None, {"sql": "SELECT FROM WHERE"}),
        Check("missing", "range", "sales", "amount", {"min_value": 1}),
        Check("runtime", "positive", "sales", "country"),
        good,
    )
    assert {n for n, r in got.items() if r[0] == "error"} == {
        "type",
        "table",
        "column",
        "query",
        "missing",
        "runtime",
    }
    assert got["good"] == ("failed", 1, 6)


def test_fused_equals_single(spark, tables):
    together = quality.run_suite(spark, quality.SALES_SUITE, tables)
    alone = [quality.run_suite(spark, [c], tables)[0] for c in quality.SALES_SUITE]
    assert together == alone
    assert [r["check_name"] for r in together] == [c.name for c in quality.SALES_SUITE]


def test_row_checks_share_one_scan(spark, path):
    spark.range(100).withColumn("v", F.col("id") * 1.0).write.parquet(path)
    table = spark.read.parquet(path)
    checks = [
        Check("a", "not_null", "t", "id"),
        Check("b", "positive", "t", "v"),
        Check("c", "range", "t", "v", {"min_value": 0, "max_value": 9}),
        Check("d", "row_count_range", "t", None, {"min_count": 1, "max_count": 9}),
    ]
    df = quality.plan_suite(spark, checks, {"t": table})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_results_are_stored_before_the_gate(spark, tables, tmp_path):
    lake = str(tmp_path)
    checks = [
        Check("bad", "positive", "sales", "amount"),
        Check("fine", "row_count_range", "sales", None, {"min_count": 1, "max_count": 9}),
    ]
    with pytest.raises(QualityGateError, match="1 of 2 checks did not pass: bad"):
        run_gate(spark, lake, checks, tables, "run-1")
    run_and_store(spark, lake, checks[1:], tables, "run-2")
    assert run_gate(spark, lake, checks[1:], tables, "run-3") == 1
    stored = metadata.read(spark, lake, metadata.QUALITY_RESULTS)
    assert stored.count() == 4
    assert {r["run_id"] for r in stored.where("status = 'failed'").collect()} == {"run-1"}
    trend = quality.failure_trend(stored).collect()
    assert [(r["passed"], r["failed"], r["error"]) for r in trend] == [(3, 1, 0)]


def test_tally(spark, tables):
    df = quality.results_frame(spark, quality.run_suite(spark, quality.SALES_SUITE, tables))
    rows = {r["status"]: (r["checks"], r["check_names"]) for r in quality.tally(df).collect()}
    assert rows["passed"] == (2, "sales_customer_id_not_null, sales_row_count_reasonable")


def test_long_details_are_cut(spark, tmp_path):
    row = {c: "x" for c in quality.RESULT_COLUMNS} | {
        "failing_rows": 0,
        "total_rows": 0,
        "details": "y" * 5000,
        "column_name": None,
    }
    metadata.append(spark, str(tmp_path), metadata.QUALITY_RESULTS, [row])
    stored = metadata.read(spark, str(tmp_path), metadata.QUALITY_RESULTS).first()
    assert (len(stored["details"]), stored["column_name"]) == (1000, "")


def test_a_namesake_does_not_hide_a_failure(spark):
    a = spark.createDataFrame([(1,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (2,)], "v int")
    checks = [Check("nn", "not_null", "a", "v"), Check("nn", "not_null", "b", "v")]
    results = quality.run_suite(spark, checks, {"a": a, "b": b})
    assert [(r["table_name"], r["status"]) for r in results] == [("a", "failed"), ("b", "passed")]
    with pytest.raises(QualityGateError, match="1 of 2"):
        quality.gate(results)


def test_suite_with_uniqueness_reads_its_table_once(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    checks = [
        Check("u", "uniqueness", "orders", "o_custkey"),
        Check("n", "not_null", "orders", "o_orderkey"),
        Check("c", "row_count_range", "orders", None, {"min_count": 1, "max_count": 10}),
    ]
    plan = quality.plan_suite(spark, checks, {"orders": table})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    n = table.count()
    repeated = table.groupBy("o_custkey").count().where("count > 1").count()
    got = {r["check_name"]: (r["failing_rows"], r["total_rows"]) for r in plan.collect()}
    assert got == {"u": (repeated, n), "n": (0, n), "c": (1, n)}
