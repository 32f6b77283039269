import pytest
from pyspark.sql import functions as F

from shoalmark.functions.names import clean_headers, clean_name, clean_name_column, table_of_key

CASES = [
    ("Order ID  #", "order_id"),
    ("123abc", "col_123abc"),
    ("", "col_"),
    ("My Data!", "my_data"),
    ("__a--b__", "a_b"),
    ("été", "t"),
    ("_9", "col_9"),
    ("***", "col_"),
]


@pytest.mark.parametrize("raw,expected", CASES)
def test_clean_name(raw, expected):
    assert clean_name(raw) == expected


def test_column_form_equals_plain_form(spark):
    df = spark.createDataFrame([(raw,) for raw, _ in CASES], "raw string")
    rows = df.select("raw", clean_name_column(F.col("raw")).alias("c")).collect()
    assert {r["raw"]: r["c"] for r in rows} == dict(CASES)


def test_clashing_headers_get_numbers():
    assert clean_headers(["a b", "a-b", "A_B", "c"]) == ["a_b", "a_b_2", "a_b_3", "c"]


def test_clash_with_a_numbered_header():
    assert clean_headers(["a", "a_2", "a", "a"]) == ["a", "a_2", "a_3", "a_4"]


def test_table_of_key(spark):
    df = spark.createDataFrame([("My Sales/2024/q1.csv",), ("customers/q1.csv",)], "key string")
    assert [r[0] for r in df.select(table_of_key(F.col("key"))).collect()] == [
        "my_sales",
        "customers",
    ]
