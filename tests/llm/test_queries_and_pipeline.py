"""The registered queries beside their SQL, and the pipeline stage by stage."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module
import corpus_pipeline
from shoalmark.llm import decontaminate, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= entry_module.queries().keys()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    same, note = compare(queries.QUERIES[name](spark, FOLDER), con, queries.ORACLES[name])
    assert same, note


def test_url_query_covers_every_page(spark):
    got = queries.op7_url_filter(spark, FOLDER)
    assert got.count() == queries.table(spark, FOLDER, "pages").count()
    assert got.where("verdict NOT IN ('allow', 'block') OR verdict IS NULL").isEmpty()


def test_stages(spark, tmp_path):
    docs = queries.table(spark, FOLDER, "documents")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, FOLDER)
        path = str(tmp_path / str(n))
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns[: len(columns)] == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert [set(seen[b]) <= set(seen[a]) for a, b in zip(names, names[1:])] == [True] * 4
    everything = queries.table(spark, FOLDER, "documents")
    lexicon = toxicity.train(everything, queries.table(spark, FOLDER, "labels"))
    bad = {r["doc_id"] for r in toxicity.score(everything, lexicon).where("predicted = 1").collect()}
    assert set(seen["toxicity"]) == set(before) - bad
    lines = [line.strip() for t in seen["toxicity"].values() for line in t.split("\n")]
    kept = [line.strip() for t in seen["line dedup"].values() for line in t.split("\n")]
    assert set(lines) - {""} == set(kept) - {""} and len(kept) <= len(lines)
    hit = {r["doc_id"] for r in decontaminate.contamination(everything, queries.table(spark, FOLDER, "benchmark"))
           .where("contaminated").select("row.doc_id").collect()}
    assert not hit & set(seen["decontamination"])
    assert docs.columns == [*columns, "copies"] and docs.where("copies < 1").isEmpty()
