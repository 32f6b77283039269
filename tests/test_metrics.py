import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from shoalmark.operators import metrics
from shoalmark.operators.percentiles import approx_percentiles, exact_percentiles

START = dt.datetime(2024, 1, 1)


def samples(spark, rows):
    """Rows of (series, seconds, value)."""
    data = [(s, START + dt.timedelta(seconds=t), v) for s, t, v in rows]
    return spark.createDataFrame(data, "series string, ts timestamp_ntz, value double")


def increases(df, **kw):
    out = metrics.counter_increase(df, ["series"], "ts", "value", **kw).collect()
    return {(r["series"], (r["ts"] - START).total_seconds()): r["increase"] for r in out}


def test_counter_with_a_reset(spark):
    df = samples(spark, [("a", 0, 5.0), ("a", 60, 9.0), ("a", 120, 2.0), ("a", 180, 4.0)])
    assert increases(df) == {("a", 0): 0, ("a", 60): 4, ("a", 120): 6, ("a", 180): 8}
    rate = metrics.counter_rate(df, ["series"], "ts", "value").where("ts > '2024-01-01 00:02:30'")
    assert rate.first()["rate"] == 8 / 300


def test_window_is_half_open(spark):
    df = samples(spark, [("a", 0, 0.0), ("a", 1, 1.0), ("a", 300, 3.0), ("a", 301, 4.0)])
    assert increases(df) == {("a", 0): 0, ("a", 1): 1, ("a", 300): 3, ("a", 301): 3}


def test_gap_over_several_chunks(spark):
    df = samples(spark, [("a", 10, 1.0), ("a", 100_000, 5.0), ("a", 100_010, 2.0)])
    assert increases(df, chunk=300) == {("a", 10): 0, ("a", 100_000): 4, ("a", 100_010): 6}


def brute_increase(rows, window=300):
    out, by = {}, {}
    for s, t, v in sorted(rows):
        by.setdefault(s, []).append((t, v))
    for s, points in by.items():
        growth = [None] + [
            b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in zip(points, points[1:])
        ]
        for i, (t, _) in enumerate(points):
            out[(s, t)] = sum(
                g for (u, _), g in zip(points, growth) if g is not None and t - window < u <= t
            )
    return out


@pytest.mark.parametrize("chunk", [300, 900, 86400])
def test_increase_against_brute_force(spark, chunk):
    rnd = random.Random(chunk)
    rows = {}
    for _ in range(800):
        rows[(rnd.choice(["hot"] * 6 + ["a", "b"]), rnd.randint(0, 20_000))] = rnd.randint(0, 9)
    flat = [(s, t, float(v)) for (s, t), v in rows.items()]
    assert increases(samples(spark, flat), chunk=chunk) == brute_increase(flat)


def test_increase_keeps_other_columns_and_ltz_times(spark):
    df = samples(spark, [("a", 0, 1.0), ("a", 1, 2.0)]).withColumn("ts", F.col("ts").cast("timestamp"))
    out = metrics.counter_increase(df.withColumn("x", F.lit(7)), ["series"], "ts", "value")
    assert out.columns == ["series", "ts", "x", "value", "increase"]
    assert sorted(r["increase"] for r in out.collect()) == [0, 1]
    with pytest.raises(ValueError):
        metrics.counter_increase(df, ["series"], "ts", "value", chunk=301)


def alerts(df, hold, **kw):
    out = metrics.held_alerts(df, ["series"], "ts", F.col("value") > 0, hold, **kw)
    columns = ("active_from", "firing_from", "firing_to")
    naive = out.select("series", *[F.col(c).cast("timestamp_ntz").alias(c) for c in columns])
    return sorted(
        (r["series"], *[(r[c] - START).total_seconds() for c in columns]) for r in naive.collect()
    )


def test_hold_time(spark):
    short = [("a", t, 1.0) for t in range(0, 286, 15)]
    exact = [("b", t, 1.0) for t in range(0, 301, 15)]
    assert alerts(samples(spark, short + exact), 300) == [("b", 0, 300, 300)]


def test_inactive_sample_and_gap_break_a_run(spark):
    rows = [("a", t, 1.0) for t in range(0, 601, 60)]
    assert alerts(samples(spark, rows), 600) == [("a", 0, 600, 600)]
    broken = [r if r[1] != 300 else ("a", 300, 0.0) for r in rows]
    assert alerts(samples(spark, broken), 240) == [("a", 0, 240, 240), ("a", 360, 600, 600)]
    gap = [r for r in rows if not 120 < r[1] < 480]
    assert alerts(samples(spark, gap), 120) == [("a", 0, 120, 120), ("a", 480, 600, 600)]
    assert alerts(samples(spark, gap), 600, max_gap=360, chunk=360) == [("a", 0, 600, 600)]


def brute_runs(rows, hold, gap):
    out, by = [], {}
    for s, t, v in sorted(rows):
        by.setdefault(s, []).append((t, v))
    for s, points in by.items():
        run = None
        for i, (t, v) in enumerate(points):
            if v > 0 and run and points[i - 1][1] > 0 and t - points[i - 1][0] <= gap:
                run[1] = t
            else:
                if run and run[1] - run[0] >= hold:
                    out.append((s, run[0], run[0] + hold, run[1]))
                run = [t, t] if v > 0 else None
        if run and run[1] - run[0] >= hold:
            out.append((s, run[0], run[0] + hold, run[1]))
    return sorted(out)


@pytest.mark.parametrize("chunk", [300, 1200, 86400])
def test_alerts_against_brute_force(spark, chunk):
    rnd = random.Random(chunk + 1)
    rows = {}
    for _ in range(900):
        key = (rnd.choice(["hot"] * 6 + ["a", "b"]), rnd.randint(0, 40_000))
        rows[key] = float(rnd.random() < 0.85)
    flat = [(s, t, v) for (s, t), v in rows.items()]
    got = alerts(samples(spark, flat), 200, max_gap=240, chunk=chunk)
    assert got == brute_runs(flat, 200, 240)
    assert got


def test_no_window_over_a_whole_series_of_samples(spark):
    """Every window over samples has the chunk in its partitioning."""
    df = samples(spark, [("a", 0, 1.0)])
    out = metrics.counter_increase(df, ["series"], "ts", "value")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3
    assert sum("_chunk#" in w for w in windows) == 2, "one runs over the slots, one row per slot"


def hot_series(seed):
    """One series with nine tenths of the samples, most of them within an hour, and one without a name."""
    rnd = random.Random(seed)
    rows = {("hot", rnd.randrange(3600)): rnd.randrange(9) for _ in range(2000)}
    rows |= {("hot", rnd.randrange(90_000)): rnd.randrange(9) for _ in range(200)}
    for name in ("b", "c", None):
        rows |= {(name, rnd.randrange(90_000)): rnd.randrange(9) for _ in range(70)}
    return [(s, t, float(v)) for (s, t), v in rows.items()]


@pytest.mark.parametrize("budget", [1, 60, 500])
def test_chunks_of_a_hot_series_are_cut(spark, budget):
    rows = hot_series(budget)
    found = increases(samples(spark, rows), chunk=21600, budget=budget)
    named = [(s or "", t, v) for s, t, v in rows]
    assert {(s or "", t): v for (s, t), v in found.items()} == brute_increase(named)
    flags = [(s or "", t, float(v > 1)) for s, t, v in rows]
    runs = alerts(samples(spark, flags), 60, max_gap=300, budget=budget)
    assert runs == alerts(samples(spark, flags), 60, max_gap=300) and runs


def test_no_chunk_holds_much_more_than_the_others(spark):
    """Parts have at most the budget, or one slot; the largest is below three times the median."""
    rnd = random.Random(5)
    rows = {("hot", rnd.randrange(21600)): 1.0 for _ in range(9000)}
    rows |= {(f"s{i}", rnd.randrange(21600)): 1.0 for i in range(10) for _ in range(100)}
    df = samples(spark, [(s, t, v) for (s, t), v in rows.items()])
    slotted = df.withColumn("_slot", F.floor(metrics.micros(df, "ts") / (300 * metrics.SECOND)))
    slots = slotted.groupBy("series", "_slot").agg(F.count("*").alias("_n"))
    cuts = metrics.chunk_cuts(slots, ["series"], 72, 400)
    dealt = metrics.with_chunk(slotted, ["series"], cuts, 72).groupBy("series", "_own").count()
    sizes = sorted(r["count"] for r in dealt.where("series = 'hot'").collect())
    assert sum(sizes) > 7000 and sizes[-1] <= 3 * sizes[len(sizes) // 2] and sizes[-1] <= 400 + 150
    assert dealt.where("series <> 'hot'").count() == 10


def test_gauges(spark):
    df = samples(spark, [("a", 0, 1.0), ("a", 9, 0.0), ("b", 0, 0.0), ("b", 9, 1.0), ("c", 5, 1.0)])
    row = metrics.count_in_state(df, ["series"], "ts", "value").first()
    assert (row["series_in_state"], row["series"]) == (2, 3)
    sums = metrics.sum_by_label(df, F.date_trunc("minute", "ts"), "series", F.col("value")).collect()
    assert {r["series"]: r["total"] for r in sums} == {"a": 1.0, "b": 1.0, "c": 1.0}
    assert metrics.total_or_zero(df.limit(0), F.col("value")).first()["total"] == 0
    status = spark.createDataFrame([(n,) for n in (0, 2, 3, 4, 5, 9)], "n int").select(
        metrics.threshold_status(F.col("n"))
    )
    assert [r[0] for r in status.collect()] == ["red", "red", "yellow", "yellow", "green", "green"]


def test_ratio(spark):
    part = samples(spark, [("a", 0, 81.0), ("b", 0, 80.0), ("c", 0, 1.0), ("d", 0, 1.0)])
    whole = samples(spark, [("a", 0, 100.0), ("b", 0, 100.0), ("c", 0, 0.0), ("d", 9, 1.0)])
    rows = metrics.gauge_ratio(part, whole, ["series"], "ts").collect()
    assert {r["series"]: (r["percent"], r["above"]) for r in rows} == {
        "a": (81.0, True),
        "b": (80.0, False),
        "c": (None, False),
    }


def test_retention_rewrites_only_the_limit_day(spark, path):
    hours = spark.range(0, 24 * 6).select(
        F.col("id"),
        F.timestamp_seconds(F.col("id") * 3600 + 1704067200).cast("timestamp_ntz").alias("ts"),
    )
    hours.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    files = {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    metrics.retain(spark, path, "ts", "day", dt.datetime(2024, 1, 5, 12), days=2)
    left = spark.read.parquet(path)
    assert sorted(r["id"] for r in left.collect()) == list(range(60, 144))
    kept = {r[0] for r in left.select("_metadata.file_path").distinct().collect()}
    assert {f for f in files if "day=2024-01-03" not in f and f.split("day=")[1] > "2024-01-03"} <= kept


def brute_percentile(values, p):
    ordered = sorted(values)
    rank = max(1, -(-round(p * 100) * len(ordered) // 100))
    return ordered[rank - 1]


@pytest.mark.parametrize("accuracy", [20, 10000])
def test_percentiles_against_brute_force(spark, accuracy):
    rnd = random.Random(accuracy)
    rows = [("hot", float(rnd.choice([7, rnd.randint(0, 10_000)]))) for _ in range(6000)]
    rows += [(g, rnd.random()) for g in "abc" for _ in range(rnd.randint(1, 50))]
    rows += [(None, 3.0), (None, 4.0), ("nulls", None), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = {"p0": 0.0, "p7": 0.07, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = exact_percentiles(df, ["g"], F.col("v"), points, accuracy).collect()
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert {r["g"] for r in got} == set(groups)
    for r in got:
        want = {n: brute_percentile(groups[r["g"]], p) for n, p in points.items()}
        assert {n: r[n] for n in points} == want, r["g"]


def test_percentiles_without_groups_and_sketch(spark):
    df = spark.range(1, 101).select(F.col("id").alias("v"))
    assert exact_percentiles(df, [], F.col("v"), {"m": 0.5}).first()["m"] == 50
    assert approx_percentiles(df, [], F.col("v"), {"m": 0.5}).first()["m"] == 50


def test_equal_times_count_once(spark):
    at = [dt.datetime(2024, 1, 1, 0, m) for m in range(0, 12)]
    rows = [("a", t, 1) for t in at] + [("a", at[3], 1), ("a", at[8], 0)]
    samples = spark.createDataFrame(rows, "s string, t timestamp, v int")
    for parts in (1, 7):
        got = metrics.held_alerts(samples.repartition(parts), ["s"], "t", F.col("v") == 1, 300, 300).collect()
        assert [(r["active_from"], r["firing_to"]) for r in got] == [(at[0], at[7])]


@pytest.mark.parametrize("kind", ["double", "decimal(18,2)", "bigint"])
def test_increase_of_very_unequal_values(spark, kind):
    """Nothing outside of a window shows in its sum, and sums have one type."""
    rows = [("a", 0, 0.0), ("a", 10, 1e15), ("a", 290, 1.0), ("a", 320, 3.0), ("a", 595, 9.0), ("a", 1300, 9.0)]
    df = samples(spark, rows).withColumn("value", F.col("value").cast(kind))
    out = metrics.counter_increase(df, ["series"], "ts", "value")
    assert dict(out.dtypes)["increase"] == {"double": "double", "bigint": "bigint"}.get(kind, "decimal(29,2)")
    assert increases(df) == brute_increase(rows)


def test_dense_windows_take_no_sliding_frame(spark):
    """30,000 samples in one window of a series: a frame gone through for each took their square."""
    df = spark.range(30_000).selectExpr(
        "'a' AS series", "timestamp_micros(id * 1000) AS ts", "CAST(id % 100 AS DECIMAL(18,2)) AS value"
    )
    out = metrics.counter_increase(df, ["series"], "ts", "value")
    frames = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]*), ", plan_text(out))
    assert set(frames) == {"unboundedpreceding$()"}
    assert out.agg(F.max("increase")).first()[0] == sum(i % 100 - (i - 1) % 100 if i % 100 else 0 for i in range(1, 30_000))


def plan_text(df):
    return df._jdf.queryExecution().analyzed().toString()
