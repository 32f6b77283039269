import datetime as dt
import os

from pyspark.sql import functions as F

from shoalmark.plans.sales import SOURCE_SCHEMA
from shoalmark.streaming.ingest import dropped_files, late_rows, stream_ingest, stream_upsert
from shoalmark.streaming.rates import all_rates, sliding_rate, write_rates

HEADER = "order_id,customer_id,amount,country,ingestion_date\n"


def drop(tmp_path, key, *lines):
    target = tmp_path / "drop" / key
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(HEADER + "\n".join(lines) + "\n")


def test_ingest_takes_each_file_once(spark, tmp_path):
    base = str(tmp_path)
    drop(tmp_path, "a/1.csv", "o1,c,1,Italy,2024-01-01", "o2,c,2,Italy,2024-01-01")

    def run():
        rows = dropped_files(spark, f"{base}/drop", SOURCE_SCHEMA)
        stream_ingest(rows, f"{base}/table", f"{base}/check", buckets=4).awaitTermination()
        found = spark.read.parquet(f"{base}/table").select("order_id", "_source_file").collect()
        return sorted(map(tuple, found))

    assert run() == [("o1", "a/1.csv"), ("o2", "a/1.csv")]
    assert run() == [("o1", "a/1.csv"), ("o2", "a/1.csv")]
    drop(tmp_path, "b/2.csv", "o3,c,3,Spain,2024-01-02")
    assert run() == [("o1", "a/1.csv"), ("o2", "a/1.csv"), ("o3", "b/2.csv")]


def test_repeated_batch_does_no_harm(spark, tmp_path):
    """Losing the checkpoint repeats every batch."""
    base = str(tmp_path)
    drop(tmp_path, "a/1.csv", "o1,c,1,Italy,2024-01-01")
    for n in range(2):
        rows = dropped_files(spark, f"{base}/drop", SOURCE_SCHEMA)
        stream_ingest(rows, f"{base}/table", f"{base}/check{n}", buckets=4).awaitTermination()
    assert spark.read.parquet(f"{base}/table").count() == 1


def test_late_rows_are_kept_once(spark, tmp_path):
    """Losing the checkpoint repeats the batches, after the mark has moved; rows on time stay out."""
    base = str(tmp_path)

    def run(check):
        rows = dropped_files(spark, f"{base}/drop", SOURCE_SCHEMA)
        schema = rows.schema
        stream_upsert(
            rows.withColumn("ingestion_date", F.to_date("ingestion_date")),
            f"{base}/table", "order_id", "ingestion_date", f"{base}/{check}",
            state_path=f"{base}/state", late_path=f"{base}/late",
        ).awaitTermination()
        found = late_rows(spark, f"{base}/late", schema).select("order_id", "late_batch", "mark")
        return sorted(map(tuple, found.collect()))

    drop(tmp_path, "a/1.csv", "o1,c,1,Italy,2024-01-05")
    assert run("check") == []
    drop(tmp_path, "a/2.csv", "o2,c,1,Italy,2024-01-05", "o3,c,1,Italy,2024-01-06", "o4,c,1,Italy,2024-01-01")
    mark = dt.date(2024, 1, 5)
    assert run("check") == [("o2", 1, mark), ("o4", 1, mark)]
    assert run("again") == [("o2", 1, mark), ("o4", 1, mark)]
    assert {r["order_id"] for r in spark.read.parquet(f"{base}/table").collect()} == {"o1", "o3"}
    assert late_rows(spark, f"{base}/none", SOURCE_SCHEMA).count() == 0


def test_upsert_with_mark(spark, tmp_path):
    base = str(tmp_path)

    def run():
        rows = dropped_files(spark, f"{base}/drop", SOURCE_SCHEMA)
        stream_upsert(
            rows,
            f"{base}/table",
            "order_id",
            "ingestion_date",
            f"{base}/check",
            order=[F.col("_source_file"), F.col("amount")],
            state_path=f"{base}/state",
        ).awaitTermination()
        found = spark.read.parquet(f"{base}/table").select("order_id", "amount").collect()
        return dict(map(tuple, found))

    drop(tmp_path, "a/1.csv", "o1,c,1,Italy,2024-01-01", "o1,c,2,Italy,2024-01-01")
    assert run() == {"o1": 2.0}
    drop(tmp_path, "a/2.csv", "o1,c,9,Italy,2024-01-01", "o2,c,3,Italy,2024-01-02")
    assert run() == {"o1": 2.0, "o2": 3.0}, "rows at the mark are left out"


def test_rates_of_stream_and_table_agree(spark, tmp_path):
    base = str(tmp_path)
    start = dt.datetime(2024, 1, 1)
    rows = [("a" if n % 3 else "b", start + dt.timedelta(seconds=7 * n)) for n in range(200)]
    spark.createDataFrame(rows, "kind string, ts timestamp").write.parquet(f"{base}/events")
    schema = spark.read.parquet(f"{base}/events").schema
    stream = sliding_rate(spark.readStream.schema(schema).parquet(f"{base}/events"), ["kind"], "ts")
    write_rates(stream, f"{base}/rates", f"{base}/check").awaitTermination()
    table = sliding_rate(spark.read.parquet(f"{base}/events"), ["kind"], "ts")
    closed = max(t for _, t in rows) - dt.timedelta(minutes=1)
    want = {tuple(r) for r in table.where(F.col("window_end") <= F.lit(closed)).collect()}
    got = [tuple(r) for r in spark.read.schema(stream.schema).parquet(f"{base}/rates").collect()]
    assert len(got) == len(want) and set(got) == want
    naive = {}
    for kind, t in rows:
        first = int((t - start).total_seconds()) // 15
        for k in range(20):
            end = start + dt.timedelta(seconds=15 * (first + 1 + k))
            naive[(kind, end)] = naive.get((kind, end), 0) + 1
    assert {(k, e): n for k, e, n, _ in (tuple(r) for r in table.collect())} == naive


def test_scratch_is_shared(spark):
    from shoalmark.session import scratch_path

    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root + os.sep)


def test_open_windows_are_read_from_the_state(spark, tmp_path):
    """After each run, what is written and what is open make up the rates of all events so far."""
    base = str(tmp_path)
    start = dt.datetime(2024, 1, 1)
    rows = [("ab"[i % 2], start + dt.timedelta(seconds=7 * i)) for i in range(120)]
    schema = "kind string, ts timestamp"
    for upto in (60, 120):
        part = rows[upto - 60 : upto]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/events")
        stream = sliding_rate(spark.readStream.schema(schema).parquet(f"{base}/events"), ["kind"], "ts")
        write_rates(stream, f"{base}/rates", f"{base}/check").awaitTermination()
        made = all_rates(spark, f"{base}/rates", f"{base}/check", ["kind"]).collect()
        table = sliding_rate(spark.createDataFrame(rows[:upto], schema), ["kind"], "ts").collect()
        assert sorted(tuple(r)[:4] for r in made) == sorted(map(tuple, table))
        mark = rows[upto - 1][1] - dt.timedelta(minutes=1)
        assert {r["window_end"] > mark for r in made if not r["complete"]} == {True}
        assert {r["window_end"] > mark for r in made if r["complete"]} == {False}
