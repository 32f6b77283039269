import datetime as dt

import pytest

from shoalmark.operators.watermark import advance_watermark, read_watermark
from shoalmark.plans.incremental import ContractViolation, load_sales
from shoalmark.sources.csvfiles import ContractError, EmptySource

HEADER = "order_id,customer_id,amount,country,ingestion_date"


@pytest.fixture
def job(spark, tmp_path):
    def run(*lines, header=HEADER, **kw):
        source = tmp_path / "sales.csv"
        source.write_text("\n".join([header, *lines]) + "\n")
        base = str(tmp_path)
        return load_sales(
            spark, str(source), f"{base}/sales", f"{base}/state", f"{base}/raw", "sales.csv", **kw
        )

    job_rows = lambda: sorted(
        tuple(r)
        for r in spark.read.parquet(str(tmp_path / "sales"))
        .select("order_id", "amount", "ingestion_date")
        .collect()
    )
    run.rows = job_rows
    run.path = tmp_path
    return run


def day(n):
    return dt.date(2024, 1, n)


def test_first_run_then_nothing_new(job, spark):
    lines = ["a,c1,10.00,Italy,2024-01-01", "b,c2,20.50,Spain,2024-01-02"]
    first = job(*lines)
    assert (first.rows_merged, first.watermark_before, first.watermark_after) == (2, None, day(2))
    again = job(*lines)
    assert again.skipped and again.rows_merged == 0 and again.late_rows == 2
    assert again.watermark_after == day(2)
    assert [r[0] for r in spark.read.text(str(job.path / "raw")).collect()][:1] == [HEADER]
    raw = spark.read.csv(str(job.path / "raw"), header=True)
    assert sorted(",".join(r) for r in raw.collect()) == lines
    audit = spark.read.parquet(str(job.path / "sales")).select("_source_file").distinct().collect()
    assert [r[0] for r in audit] == ["sales.csv"]


def test_changes_count_only_after_the_mark(job):
    job("a,c1,10,Italy,2024-01-01", "b,c2,20,Spain,2024-01-02")
    done = job(
        "a,c1,11,Italy,2024-01-01",  # changed, but not newer
        "b,c2,21,Spain,2024-01-03",  # changed and newer: moves
        "c,c3,30,Japan,2024-01-02",  # new, but at the mark
        "d,c4,40,Japan,2024-01-04",
    )
    assert (done.rows_merged, done.late_rows, done.watermark_after) == (2, 2, day(4))
    assert job.rows() == [("a", 10.0, day(1)), ("b", 21.0, day(3)), ("d", 40.0, day(4))]


def test_last_line_of_a_key_wins(job):
    done = job("a,c1,1,Italy,2024-01-01", "a,c1,2,Italy,2024-01-02", "a,c1,3,,2024-01-01")
    assert done.rows_merged == 1
    assert job.rows() == [("a", 3.0, day(1))]


@pytest.mark.parametrize(
    "header",
    [
        "customer_id,order_id,amount,country,ingestion_date",
        "order_id,customer_id,amount,country",
        HEADER + ",extra",
    ],
)
def test_header_has_to_be_equal(job, header):
    with pytest.raises(ContractError, match="order_id.*found"):
        job("a,c1,1,Italy,2024-01-01", header=header)


def test_empty_and_missing_sources(job, spark, tmp_path):
    with pytest.raises(EmptySource):
        job()
    with pytest.raises(FileNotFoundError):
        load_sales(spark, str(tmp_path / "none.csv"), "t", "s")


def test_strict_contract(job):
    with pytest.raises(ContractViolation, match="amount: 1 uncastable"):
        job("a,c1,one,Italy,2024-01-01", strict=True)
    with pytest.raises(ContractViolation, match="customer_id: 0 uncastable, 1 empty"):
        job("a,,1,Italy,2024-01-01", strict=True)


def test_mark_never_moves_back(spark, path):
    assert read_watermark(spark, path, "p") is None
    assert advance_watermark(spark, path, "p", day(5)) == day(5)
    assert advance_watermark(spark, path, "p", day(3)) == day(5)
    assert advance_watermark(spark, path, "p", None) == day(5)
    assert advance_watermark(spark, path, "q", day(1)) == day(1)
    assert read_watermark(spark, path, "p") == day(5)


def test_every_file_of_a_folder_needs_the_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "\na,c1,1,Italy,2024-01-01\n")
    other = "customer_id,order_id,amount,country,ingestion_date"
    (folder / "b.csv").write_text(other + "\nc1,b,1,Italy,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_sales(spark, str(folder), str(tmp_path / "sales"), str(tmp_path / "state"))


def test_rows_without_a_date(job):
    with pytest.raises(ContractViolation, match="1 row.s. without a date"):
        job("a,c1,1,Italy,")
    assert job("a,c1,1,Italy,", allow_undated=True).rows_merged == 1
    done = job("a,c1,2,Italy,2024-01-01", "b,c1,3,Italy,", allow_undated=True)
    assert (done.rows_merged, done.late_rows, done.undated_rows, done.watermark_after) == (2, 0, 1, day(1))
    again = job("b,c1,4,Italy,", "a,c1,9,Italy,2024-01-01", allow_undated=True)
    assert (again.rows_merged, again.late_rows, again.undated_rows) == (1, 1, 1)
    assert job.rows() == [("a", 2.0, day(1)), ("b", 4.0, None)]


def test_no_record_is_lost_behind_the_mark(job, spark):
    job("a,c1,1,Italy,2024-01-01")
    with pytest.raises(ContractViolation, match="ingestion_date: 1 uncastable"):
        job("b,c2,2,Italy,02/01/2024")
    done = job('b,c2,2,"It""aly\nand, more",2024-01-02', "c,c3,3,Spain,2024-01-03")
    assert (done.rows_in, done.rows_merged, done.late_rows, done.watermark_after) == (2, 2, 0, day(3))
    assert job.rows() == [("a", 1.0, day(1)), ("b", 2.0, day(2)), ("c", 3.0, day(3))]
    raw = spark.read.csv(str(job.path / "raw"), header=True, escape='"', multiLine=True)
    assert sorted(r["country"] for r in raw.collect()) == ['It"aly\nand, more', "Spain"]


def test_the_raw_copy_can_be_read_back_from_parts(spark, tmp_path):
    lines = [f"k{i},c{i},{i}.5,Italy,2024-01-01" for i in range(2000)]
    for n in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{n}.csv").write_text("\n".join([HEADER, *lines[n::3]]) + "\n")
    load_sales(spark, str(tmp_path / "in"), str(tmp_path / "sales"), str(tmp_path / "state"), str(tmp_path / "raw"))
    raw = spark.read.csv(str(tmp_path / "raw"), header=True)
    assert raw.count() == 2000 and raw.columns == HEADER.split(",")


def test_the_table_is_in_the_catalog(job, spark):
    name = "sales_db.sales_of_this_test"
    job("a,c1,1,Italy,2024-01-01", table=name)
    job("b,c1,1,Italy,2024-01-02", table=name)
    assert [r[0] for r in spark.sql(f"SELECT order_id FROM {name} ORDER BY 1").collect()] == ["a", "b"]
    spark.sql("DROP DATABASE sales_db CASCADE")
