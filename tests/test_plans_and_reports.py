import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoalmark.plans import reports
from shoalmark.plans.sales import between_dates, sales_view
from shoalmark.sources import catalog

FOLDER = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("o1", "c1", 10.10, "Italy", dt.date(2024, 1, 1)),
        ("o2", "c1", 20.20, "Italy", dt.date(2024, 1, 2)),
        ("o3", "c2", 30.30, "Spain", dt.date(2024, 2, 1)),
        ("o4", "c3", 30.30, None, dt.date(2024, 2, 1)),
    ]
    return spark.createDataFrame(
        rows, "order_id string, customer_id string, amount double, country string, ingestion_date date"
    )


def test_totals(sales):
    assert reports.total_revenue(sales).first()[0] == 90.9
    assert reports.total_orders(sales).first()[0] == 4
    assert reports.avg_order_value(sales).first()[0] == 90.9 / 4
    assert reports.avg_order_value(sales.limit(0)).first()[0] is None


def test_groups_and_order(sales):
    rows = reports.revenue_by_country(sales).collect()
    assert [(r["country"], r["revenue"]) for r in rows] == [
        (None, 30.3),
        ("Italy", 30.3),
        ("Spain", 30.3),
    ]
    shares = {r["country"]: r["share_percent"] for r in reports.orders_by_country_share(sales).collect()}
    assert shares == {"Italy": 50.0, "Spain": 25.0, None: 25.0}
    top = reports.top_customers(sales, 2).collect()
    assert [(r["customer_id"], r["order_count"]) for r in top] == [("c1", 2), ("c2", 1)]
    months = reports.revenue_by_month(sales).collect()
    assert [(r["month"].month, r["orders"]) for r in months] == [(1, 2), (2, 2)]


def test_filters(sales):
    some = between_dates(sales, dt.date(2024, 1, 2), dt.date(2024, 2, 1), ["Italy", "Spain"])
    assert sorted(r["order_id"] for r in some.collect()) == ["o2", "o3"]
    text = "SELECT order_id FROM {sales} WHERE amount > :least"
    assert reports.parameterised(sales, text, {"least": 25.0}).count() == 2


def test_filter_and_columns_reach_the_scan(spark):
    view = between_dates(sales_view(spark, FOLDER), dt.date(1996, 1, 1))
    plan = physical(reports.revenue_by_country(view))
    orders = [line for line in plan.splitlines() if "orders.parquet" in line][0]
    assert "o_orderdate" in orders.split("PushedFilters")[1]
    schema = orders.split("ReadSchema")[1]
    assert "o_orderpriority" not in schema and "o_orderkey" not in schema


def test_top_customers_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in physical(reports.top_customers(sales_view(spark, FOLDER)))


@pytest.mark.parametrize(
    "report",
    [
        reports.revenue_by_country,
        reports.orders_by_country_share,
        reports.percentiles_by_country,
        reports.revenue_by_day_country,
    ],
)
def test_no_cross_joins_and_no_single_window(spark, report):
    plan = physical(report(sales_view(spark, FOLDER)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_catalog(spark, tmp_path):
    catalog.create_database(spark, "cat_test", str(tmp_path / "db"))
    schema = spark.createDataFrame([], "a int, b string").schema
    for name in ("zeta", "alpha", "_hidden"):
        catalog.create_table(spark, f"cat_test.{name}", schema, str(tmp_path / name), ["b"])
    assert catalog.user_tables(spark, "cat_test") == ["alpha", "zeta"]
    assert "cat_test" in catalog.databases(spark)
    catalog.add_columns(spark, "cat_test.zeta", spark.createDataFrame([], "c double").schema.fields)
    assert catalog.describe(spark, "cat_test.zeta") == {"a": "INT", "c": "DOUBLE", "b": "STRING"}
    assert catalog.read_path(
        spark, f"{FOLDER}/nation.parquet"
    ).select(F.count("*")).first()[0] == 25
