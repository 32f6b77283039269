import datetime as dt
import os
import random

from pyspark.sql import functions as F

from shoalmark.operators import versions

UTC = dt.timezone.utc


def at(day):
    return dt.datetime(2024, 1, day, tzinfo=UTC)


def commit(spark, path, batch, rows):
    df = spark.createDataFrame(rows, "k string, v int, _op string")
    versions.commit(df, path, batch, F.col("_op"), at(batch))


def log(spark, path):
    return versions.read_log(spark, path)


def state(spark, path, **kw):
    return {r["k"]: r["v"] for r in versions.as_of(log(spark, path), "k", **kw).collect()}


def three(spark, path):
    commit(spark, path, 1, [("a", 1, "insert"), ("b", 1, "insert"), ("c", 1, "insert")])
    commit(spark, path, 2, [("b", 2, "update"), ("d", 2, "insert")])
    commit(spark, path, 3, [("a", None, "delete"), ("b", 3, "update")])


def test_reads_as_of(spark, path):
    three(spark, path)
    assert state(spark, path) == {"b": 3, "c": 1, "d": 2}
    assert state(spark, path, version=1) == {"a": 1, "b": 1, "c": 1}
    assert state(spark, path, version=2) == {"a": 1, "b": 2, "c": 1, "d": 2}
    assert state(spark, path, timestamp=at(2)) == state(spark, path, version=2)
    assert state(spark, path, version=0) == {}


def test_older_version_reads_fewer_files(spark, path):
    three(spark, path)
    old = versions.as_of(log(spark, path), "k", version=1)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan or "PartitionFilters: [(cast" in plan, plan
    files = log(spark, path).where("batch_id <= 1").select(F.col("_metadata.file_path")).distinct()
    assert all("batch_id=1/" in r[0] for r in files.collect())


def test_history_and_counts(spark, path):
    three(spark, path)
    rows = versions.batches(log(spark, path)).collect()
    assert [(r["batch_id"], r["parent_id"]) for r in rows] == [(3, 2), (2, 1), (1, None)]
    counts = versions.compare_counts(log(spark, path), "k", {"old": 1, "now": None}).collect()
    assert {r["version"]: r["rows"] for r in counts} == {"old": 3, "now": 3}
    assert versions.version_count(log(spark, path)) == 3


def test_commit_again_replaces_the_batch(spark, path):
    three(spark, path)
    commit(spark, path, 3, [("c", 9, "update")])
    assert state(spark, path) == {"a": 1, "b": 2, "c": 9, "d": 2}


def test_rollback(spark, path):
    three(spark, path)
    versions.rollback(spark, path, "k", 1, 4)
    assert state(spark, path) == {"a": 1, "b": 1, "c": 1}
    assert state(spark, path, version=3) == {"b": 3, "c": 1, "d": 2}


def test_expire_keeps_all_younger_versions(spark, path):
    rnd = random.Random(5)
    live: set = set()
    for batch in range(1, 9):
        rows = []
        for k in {f"k{rnd.randint(0, 12)}" for _ in range(6)}:
            if k in live and rnd.random() < 0.4:
                rows.append((k, None, "delete"))
                live.discard(k)
            else:
                rows.append((k, rnd.randint(0, 99), "update" if k in live else "insert"))
                live.add(k)
        commit(spark, path, batch, rows)
    before = {v: state(spark, path, version=v) for v in range(5, 9)}
    total = log(spark, path).count()
    versions.expire(spark, path, "k", at(5))
    assert {v: state(spark, path, version=v) for v in range(5, 9)} == before
    assert log(spark, path).count() < total
    left = log(spark, path).where("batch_id <= 5")
    assert left.where("op = 'delete'").count() == 0
    assert left.count() == left.select("k").distinct().count()


def test_expire_removes_emptied_batches(spark, path):
    three(spark, path)
    assert versions.expire(spark, path, "k", at(3)) == 0
    commit(spark, path, 4, [("b", 4, "update"), ("c", 4, "update"), ("d", 4, "update")])
    assert versions.expire(spark, path, "k", at(4)) == 3
    assert state(spark, path) == {"b": 4, "c": 4, "d": 4}
    assert versions.expire(spark, path, "k", at(0 + 1)) == 0


def based(spark, path, version):
    found = versions.as_of_version(spark, path, "k", version)
    return {r["k"]: r["v"] for r in found.collect()}


def test_bases_give_the_same_state_from_few_folders(spark, path):
    random.seed(3)
    keys, every = [f"k{i}" for i in range(8)], 5
    for batch in range(1, 24):
        chosen = random.sample(keys, 3)
        commit(spark, path, batch, [(k, batch, random.choice(["update", "delete"])) for k in chosen])
        versions.keep_bases(spark, path, "k", every)
    assert versions.bases(spark, path) == [5, 10, 15, 20]
    for version in (0, 1, 4, 5, 6, 14, 19, 20, 23):
        assert based(spark, path, version) == state(spark, path, version=version)
        files = versions.as_of_version(spark, path, "k", version).inputFiles()
        assert len({f.rsplit("/", 1)[0] for f in files}) <= every
    assert based(spark, path, 99) == state(spark, path)


def test_a_batch_run_again_drops_the_bases_it_makes_wrong(spark, path):
    three(spark, path)
    for version in (1, 2, 3):
        versions.write_base(spark, path, "k", version)
    commit(spark, path, 2, [("b", 7, "update")])
    assert versions.bases(spark, path) == [1]
    assert based(spark, path, 3) == state(spark, path) == {"b": 3, "c": 1}
    assert based(spark, path, 2) == {"a": 1, "b": 7, "c": 1}


def test_a_base_that_was_not_finished_does_not_count(spark, path):
    three(spark, path)
    spark.range(3).write.parquet(f"{path}/_bases/version=2")
    os.remove(f"{path}/_bases/version=2/_SUCCESS")
    assert versions.bases(spark, path) == [] and based(spark, path, 2) == state(spark, path, version=2)
    versions.write_base(spark, path, "k", 2)
    assert versions.bases(spark, path) == [2] and based(spark, path, 2) == state(spark, path, version=2)


def test_expiry_keeps_reads_of_younger_versions_with_bases(spark, path):
    three(spark, path)
    versions.write_base(spark, path, "k", 1)
    versions.write_base(spark, path, "k", 2)
    versions.expire(spark, path, "k", at(2))
    assert based(spark, path, 2) == {"a": 1, "b": 2, "c": 1, "d": 2}
    assert based(spark, path, 3) == state(spark, path) == {"b": 3, "c": 1, "d": 2}
