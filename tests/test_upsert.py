import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from shoalmark.operators.partitions import overwrite_partitions
from shoalmark.operators.upsert import latest_per_key, overwrite_by_partition, upsert

D = [dt.date(2024, 1, n) for n in range(1, 10)]
SCHEMA = "order_id string, amount double, country string, day date"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, path):
    return sorted(
        (tuple(r) for r in spark.read.parquet(path).select("order_id", "amount", "country", "day").collect()),
        key=str,
    )


def put(spark, path, rows, **kw):
    return upsert(spark, path, frame(spark, rows), "order_id", "day", **kw)


def test_insert_update_and_move(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0]), ("b", 2.0, "DE", D[1]), ("c", 3.0, "FR", D[2])])
    done = put(spark, path, [("b", 9.0, None, D[5]), ("d", 4.0, "ES", D[0])])
    assert content(spark, path) == [
        ("a", 1.0, "IT", D[0]),
        ("b", 9.0, None, D[5]),
        ("c", 3.0, "FR", D[2]),
        ("d", 4.0, "ES", D[0]),
    ]
    assert done.rows_merged == 2
    assert done.partitions_rewritten == 3
    assert "day=2024-01-02" not in os.listdir(path), "the emptied partition has to go"


def test_untouched_partitions_keep_their_files(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0]), ("b", 2.0, "DE", D[1])])
    before = sorted(os.listdir(f"{path}/day=2024-01-01"))
    put(spark, path, [("b", 3.0, "DE", D[1])])
    assert sorted(os.listdir(f"{path}/day=2024-01-01")) == before


def test_twice_is_once(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0]), ("b", 2.0, "DE", D[1])])
    for _ in range(2):
        put(spark, path, [("a", 5.0, "IT", D[3]), ("z", 1.0, "IT", D[3])])
    assert content(spark, path) == [
        ("a", 5.0, "IT", D[3]),
        ("b", 2.0, "DE", D[1]),
        ("z", 1.0, "IT", D[3]),
    ]


def test_rows_without_key_or_date(spark, path):
    put(spark, path, [(None, 1.0, "IT", D[0]), ("a", 2.0, "DE", None)])
    put(spark, path, [(None, 3.0, "IT", D[0]), ("a", 4.0, "DE", D[1])], order=[F.col("amount")])
    assert content(spark, path) == sorted(
        [(None, 1.0, "IT", D[0]), (None, 3.0, "IT", D[0]), ("a", 4.0, "DE", D[1])], key=str
    )


def test_empty_source_changes_nothing(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0])])
    assert put(spark, path, []).rows_merged == 0
    assert content(spark, path) == [("a", 1.0, "IT", D[0])]


@pytest.mark.parametrize("parts", [1, 7])
def test_last_row_wins_with_a_hot_key(spark, parts):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot"] * 5 + [f"k{n}" for n in range(10)]), i) for i in range(3000)]
    last = dict(rows)
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k string, i int").repartition(parts)
    got = {r["k"]: r["i"] for r in latest_per_key(df, "k", ["i"]).collect()}
    assert got == last


def test_against_a_dictionary(spark, path):
    rnd = random.Random(11)
    table: dict = {}
    for _ in range(4):
        batch = {
            f"k{rnd.randint(0, 40)}": (float(rnd.randint(0, 99)), "X", rnd.choice(D))
            for _ in range(25)
        }
        table.update(batch)
        put(spark, path, [(k, *v) for k, v in batch.items()])
        assert content(spark, path) == sorted(((k, *v) for k, v in table.items()), key=str)


def test_overwrite_by_partition(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0]), ("b", 2.0, "DE", D[1])])
    overwrite_by_partition(frame(spark, [("c", 3.0, "FR", D[1])]), path, "day")
    assert content(spark, path) == [("a", 1.0, "IT", D[0]), ("c", 3.0, "FR", D[1])]


def test_failed_job_leaves_the_table(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0])])
    bad = spark.read.parquet(path).withColumn(
        "amount", F.raise_error(F.lit("broken")).cast("double")
    )
    with pytest.raises(Exception, match="broken"):
        overwrite_partitions(bad, path, "day", {D[0]})
    assert content(spark, path) == [("a", 1.0, "IT", D[0])]


def test_source_without_a_column_is_refused(spark, path):
    put(spark, path, [("a", 1.0, "IT", D[0])])
    with pytest.raises(ValueError, match="country"):
        upsert(spark, path, frame(spark, [("a", 2.0, "", D[0])]).drop("country"), "order_id", "day")
    assert content(spark, path) == [("a", 1.0, "IT", D[0])]
