"""Records of CSV files whose fields hold line breaks, read in splits of a few bytes."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from shoalmark.plans.incremental import land_raw
from shoalmark.sources.csvfiles import ContractError, CsvSource
from shoalmark.sources.records import csv_records, state_after

CELL = st.text('ab,"\n é', max_size=6)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for name, size in zip(names, ("64", "0")):
        spark.conf.set(name, size)
    yield spark
    for name, size in before.items():
        spark.conf.set(name, size)


def written(rows):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    return text.getvalue()


def test_records_equal_what_was_written(small_splits, tmp_path):
    cells = ["x", 'a "b" c', '5" pipe', "line\nbreak", "\n\n", "", '"', "a,b", ' "x', "é"]
    expected = {}
    for k in range(3):
        rows = [["a", "b"], *[[cells[(i * i + k) % 10], cells[(3 * i + k) % 10]] for i in range(60)]]
        (tmp_path / f"f{k}.csv").write_text(written(rows), encoding="utf-8")
        expected[f"f{k}.csv"] = [written([r])[:-1] for r in rows]
    found = csv_records(small_splits, [str(tmp_path)]).orderBy("path", "block", "line_no").collect()
    assert len({(r["path"], r["block"]) for r in found}) > 30
    for name, records in expected.items():
        assert [r["text"] for r in found if r["path"].endswith(name)] == records


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(CELL, CELL), min_size=1, max_size=40))
def test_states_of_lines_tell_where_records_end(spark, rows):
    """Walking over all lines with the two maps ends outside after each record and only there."""
    lines = written(rows)[:-1].split("\n")
    table = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    maps = table.select(
        "i", *[state_after(F.col("value"), ",", s).cast("int") for s in (False, True)]
    ).sort("i").collect()
    state, ends = 0, 0
    for _, from_out, from_in in maps:
        state = from_in if state else from_out
        ends += not state
    assert (state, ends) == (0, len(rows))


def test_stray_quotes_are_letters_and_the_file_is_read_by_many_tasks(small_splits, tmp_path):
    lines = [f'{i},5" pipe' if i % 7 == 0 else f"{i},plain" for i in range(200)]
    (tmp_path / "f.csv").write_text("\n".join(["id,what", *lines]) + "\n")
    source = CsvSource.open(small_splits, str(tmp_path))
    assert source.quoted and source.columns() == ["id", "what"]
    schema = T.StructType.fromDDL("id int, what string")
    rows, order = source.ordered(schema)
    found = rows.orderBy(*order).select("id", "what").collect()
    assert [f"{r[0]},{r[1]}" for r in found] == lines
    assert rows.select(order[1]).distinct().count() > 20


def test_a_quote_that_is_never_closed_takes_the_rest(small_splits, tmp_path):
    (tmp_path / "f.csv").write_text('id,what\n1,"open\n2,b\n' + "3,c\n" * 40)
    texts = [r["text"] for r in csv_records(small_splits, [str(tmp_path)]).sort("block", "line_no").collect()]
    assert texts == ["id,what", '1,"open\n2,b\n' + "3,c\n" * 39 + "3,c"]


def test_headers_of_all_files_and_blank_lines(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('\n﻿id,what\n\n1,"x\n\ny"\n  \n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('id,what\n2,"p\nq"\n')
    source = CsvSource.open(small_splits, str(tmp_path))
    assert sorted(tuple(r) for r in source.text().collect()) == [("1", "x\n\ny"), ("2", "p\nq")]
    (tmp_path / "c.csv").write_text("what,id\nz,3\n")
    with pytest.raises(ContractError):
        CsvSource.open(small_splits, str(tmp_path)).columns()


def test_raw_copy_keeps_breaks_and_blanks(small_splits, tmp_path):
    rows = [["a", "b"], ["1", " x \n y "], ["2", 'q "q"\n'], ["3", "plain"]]
    (tmp_path / "f.csv").write_text(written(rows))
    land_raw(CsvSource.open(small_splits, str(tmp_path / "f.csv")), str(tmp_path / "raw"))
    copied = CsvSource.open(small_splits, str(tmp_path / "raw")).text().collect()
    assert sorted(map(list, copied)) == rows[1:]


def test_lines_meet_the_splits_and_headers_without_an_exchange(spark, tmp_path):
    """Only the lines of records that span several go through one; headers are found without the others."""
    rows = [["a", "b"], *[[str(i), f"x\ny {i}"] for i in range(300)]]
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text(written(rows))
    source = CsvSource.open(spark, str(tmp_path))
    assert source.columns() == ["a", "b"]
    made = source.text()
    assert made.count() == 900
    plan = made._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in final
