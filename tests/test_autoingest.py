import itertools
import os

import pytest

from shoalmark.operators import metadata
from shoalmark.plans import autoingest
from shoalmark.plans.autoingest import Options, ingest_folder
from shoalmark.session import staged
from shoalmark.sources import catalog

_numbers = itertools.count()


class Lake:
    def __init__(self, spark, base, **kw):
        self.spark, self.root, self.lake = spark, f"{base}/uploads", f"{base}/lake"
        os.makedirs(self.root)
        self.opts = Options(database=f"auto_{next(_numbers)}", buckets=4, **kw)
        self.runs = 0

    def put(self, key, text):
        target = f"{self.root}/{key}"
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w", encoding="utf-8", newline="") as f:
            f.write(text)

    def run(self):
        self.runs += 1
        found = ingest_folder(self.spark, self.root, self.lake, f"run-{self.runs}", self.opts)
        return {r["file_key"]: (r["status"], r["row_count"], r["rejected"]) for r in found}

    def rows(self, table, *columns):
        df = self.spark.table(f"{self.opts.database}.{table}").select(*columns)
        return sorted((tuple(r) for r in df.collect()), key=str)

    def types(self, table):
        return catalog.describe(self.spark, f"{self.opts.database}.{table}")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


STAFF = (
    "id,name,email,age,salary,signup_date,is_active\n"
    + "".join(
        f"{n},N{n},n{n}@example.org,{20 + n},{1000 + n}.50,2024-01-{n:02d},{'true' if n % 2 else 'false'}\n"
        for n in range(1, 11)
    )
)


def test_new_unchanged_and_changed_file(lake):
    lake.put("staff/a.csv", STAFF)
    assert lake.run() == {"staff/a.csv": ("success", 10, 0)}
    assert lake.types("staff") == {
        "id": "INT",
        "name": "STRING",
        "email": "STRING",
        "age": "INT",
        "salary": "DOUBLE",
        "signup_date": "DATE",
        "is_active": "BOOLEAN",
        "_source_file": "STRING",
        "_ingested_at": "TIMESTAMP",
        "_source_bucket": "INT",
    }
    assert lake.run() == {}
    os.utime(f"{lake.root}/staff/a.csv", (1, 1))
    assert lake.run() == {}, "another time, but the same content"
    lake.put("staff/b.csv", STAFF.replace("N", "M"))
    assert lake.run() == {"staff/b.csv": ("success", 10, 0)}
    lake.put("staff/a.csv", STAFF.replace("N1,", "Z1,"))
    assert lake.run() == {"staff/a.csv": ("success", 10, 0)}
    names = [r[0] for r in lake.rows("staff", "name")]
    assert len(names) == 20 and "Z1" in names and "N1" not in names and "M1" in names
    sources = {r[0] for r in lake.rows("staff", "_source_file")}
    assert sources == {"staff/a.csv", "staff/b.csv"}


def test_touched_file_is_read_once(lake, monkeypatch):
    lake.put("staff/a.csv", STAFF)
    lake.run()
    os.utime(f"{lake.root}/staff/a.csv", (1, 1))
    assert lake.run() == {}
    registry = metadata.read(lake.spark, lake.lake, metadata.REGISTRY)
    assert sorted(r["status"] for r in registry.collect()) == ["success", "unchanged"]
    monkeypatch.setattr(autoingest, "fingerprint", lambda *a: pytest.fail("the file was read again"))
    assert lake.run() == {}


def test_a_file_that_gets_its_old_content_back_is_loaded_again(lake):
    lake.put("staff/a.csv", STAFF)
    lake.run()
    first = os.stat(f"{lake.root}/staff/a.csv")
    lake.put("staff/a.csv", STAFF.replace("N1,", "Z1,"))
    assert lake.run() == {"staff/a.csv": ("success", 10, 0)}
    lake.put("staff/a.csv", STAFF)
    os.utime(f"{lake.root}/staff/a.csv", ns=(first.st_mtime_ns, first.st_mtime_ns))
    assert lake.run() == {"staff/a.csv": ("success", 10, 0)}
    assert ("N1",) in lake.rows("staff", "name") and ("Z1",) not in lake.rows("staff", "name")


def test_extra_and_missing_columns(lake):
    lake.put("t/a.csv", "a,b\n5,x\n6,y\n")
    lake.run()
    lake.put("t/b.csv", "a,c\n7,2024-05-01\n")
    lake.put("t/c.csv", "c;a\n2024-05-02;8\n")
    assert all(r[0] == "success" for r in lake.run().values())
    rows = [tuple(map(str, r)) for r in lake.rows("t", "a", "b", "c")]
    assert rows == [
        ("5", "x", "None"),
        ("6", "y", "None"),
        ("7", "None", "2024-05-01"),
        ("8", "None", "2024-05-02"),
    ]


def test_ragged_rows_and_unreadable_values(lake):
    lake.put("t/a.csv", "a,b\n" + "".join(f"{n},{n}\n" for n in range(2, 21)) + "x,1\n21\n22,3,4\n")
    assert lake.run() == {"t/a.csv": ("success", 22, 1)}
    rows = lake.rows("t", "a", "b")
    assert (None, 1) in rows and (21, None) in rows and (22, 3) in rows
    registry = metadata.read(lake.spark, lake.lake, metadata.REGISTRY)
    assert [r["ragged"] for r in registry.collect()] == [2]


def test_existing_type_wins(lake):
    lake.put("t/a.csv", "a\n5\n6\n")
    lake.run()
    lake.put("t/b.csv", "a\nx\n7\n")
    assert lake.run() == {"t/b.csv": ("success", 2, 1)}
    assert lake.rows("t", "a") == sorted([(5,), (6,), (7,), (None,)], key=str)


def test_quoted_text_names_and_blanks(lake):
    lake.put("my drop/q1+%.CSV", 'Some Text,Some Text,"N, o"\n"two\nlines","say ""hi""",7\n" ",x,8\n')
    assert lake.run() == {"my drop/q1+%.CSV": ("success", 2, 0)}
    assert lake.rows("my_drop", "some_text", "some_text_2", "n_o", "_source_file") == sorted(
        [
            ("two\nlines", 'say "hi"', 7, "my drop/q1+%.CSV"),
            (None, "x", 8, "my drop/q1+%.CSV"),
        ],
        key=str,
    )


def test_failed_file_does_not_harm_others_and_is_tried_again(lake):
    lake.put("t/empty.csv", "\n")
    lake.put("t/good.csv", "a\n5\n")
    lake.put("u/good.csv", "a\n5\n")
    assert lake.run() == {
        "t/empty.csv": ("failed", 0, 0),
        "t/good.csv": ("success", 1, 0),
        "u/good.csv": ("success", 1, 0),
    }
    assert lake.run() == {"t/empty.csv": ("failed", 0, 0)}
    lake.put("t/empty.csv", "a\n6\n")
    assert lake.run() == {"t/empty.csv": ("success", 1, 0)}
    registry = metadata.read(lake.spark, lake.lake, metadata.REGISTRY)
    newest = metadata.newest(registry, "ingested_at", 20, "file_key").collect()
    assert len(newest) == 5 and newest[0]["file_key"] == "t/empty.csv"
    assert {r["error_message"] for r in newest if r["status"] == "failed"} == {"no header row"}
    assert catalog.user_tables(lake.spark, lake.opts.database) == ["t", "u"]


def test_header_only_file(lake):
    lake.put("t/a.csv", "a,b\n")
    assert lake.run() == {"t/a.csv": ("success", 0, 0)}
    assert lake.rows("t", "a") == []


def test_file_that_shrinks_to_nothing(lake):
    lake.put("t/a.csv", "a,b\n5,6\n")
    lake.put("t/b.csv", "a,b\n7,8\n")
    lake.run()
    lake.put("t/a.csv", "a,b\n")
    assert lake.run() == {"t/a.csv": ("success", 0, 0)}
    assert lake.rows("t", "a") == [(7,)]


def test_empty_folder_and_file_at_the_root(lake):
    lake.put("root.csv", "a\n1\n")
    assert lake.run() == {}


def test_strict_mode_fails_the_file(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), strict=True)
    lake.put("t/a.csv", "a\n" + "".join(f"{n}\n" for n in range(2, 21)) + "x\n")
    assert lake.run() == {"t/a.csv": ("failed", 0, 0)}


def test_portions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), files_per_wave=2)
    for n in range(5):
        lake.put(f"t/f{n}.csv", "a|b\n" + f"{n + 2}|x\n" * n)
    done = lake.run()
    assert {k: v[1] for k, v in done.items()} == {f"t/f{n}.csv": n for n in range(5)}
    assert len(lake.rows("t", "a")) == 10
    assert lake.run() == {}


@pytest.mark.parametrize("portions", [{}, {"files_per_wave": 1}, {"dialects_at_once": 1}])
def test_portions_do_not_change_the_table(spark, tmp_path, portions):
    lake = Lake(spark, str(tmp_path), **portions)
    lake.put("t/a.csv", "x,a\nhello,1\nworld,2\n")
    lake.put("t/b.csv", "x,b\n1,1\n2,2\n")
    lake.put("t/c.csv", "c,x\n7,5\n")
    assert set(v[0] for v in lake.run().values()) == {"success"}
    assert lake.types("t")["x"] == "STRING"
    assert lake.rows("t", "x") == [("1",), ("2",), ("5",), ("hello",), ("world",)]


def test_whole_headers(lake):
    names = [f"column_{n:04d}_" + "n" * 30 for n in range(240)]
    lake.put("wide/a.csv", ",".join(names) + "\n" + ",".join(str(n + 2) for n in range(240)) + "\n")
    lake.put("broken/a.csv", 'id;"unit\nof ""measure""";last\n5;kg;x\n6;"m\nm";y\n')
    assert lake.run() == {"wide/a.csv": ("success", 1, 0), "broken/a.csv": ("success", 2, 0)}
    assert lake.rows("wide", *names) == [tuple(range(2, 242))]
    assert lake.rows("broken", "id", "unit_of_measure", "last") == [(5, "kg", "x"), (6, "m\nm", "y")]
    lake.put("broken/a.csv", 'id;"unit\nof ""measure""";last\n5;kg;x\n')
    assert lake.run() == {"broken/a.csv": ("success", 1, 0)}


def test_one_bad_file_among_many_is_left_out(spark, tmp_path, monkeypatch):
    lake, loads = Lake(spark, str(tmp_path)), []
    real = autoingest.ingest_files

    def counted(*args):
        loads.append(len(args[4]))
        if any("f13" in f["key"] for f in args[4]):
            raise OSError("cannot be opened")
        return real(*args)

    monkeypatch.setattr(autoingest, "ingest_files", counted)
    for n in range(16):
        lake.put(f"t/f{n:02d}.csv", f"a\n{n + 2}\n")
    done = lake.run()
    assert [k for k, v in done.items() if v[0] == "failed"] == ["t/f13.csv"]
    assert len(loads) == 9 and len(lake.rows("t", "a")) == 15
    monkeypatch.undo()
    assert lake.run() == {"t/f13.csv": ("success", 1, 0)}
    assert len(lake.rows("t", "a")) == 16


def test_a_gone_file_is_recorded(lake, monkeypatch):
    lake.put("t/a.csv", "a\n5\n")
    lake.put("t/b.csv", "a\n6\n")
    real = autoingest.list_csv

    def listed(spark, root):
        found = staged(real(spark, root), "listing")
        os.remove(f"{lake.root}/t/b.csv")
        return found

    monkeypatch.setattr(autoingest, "list_csv", listed)
    assert {k: v[0] for k, v in lake.run().items()} == {"t/a.csv": "success", "t/b.csv": "failed"}
    assert lake.rows("t", "a") == [(5,)]


def test_records_of_finished_tables_are_stored(lake, monkeypatch):
    lake.put("good/a.csv", "a\n5\n")
    lake.put("bad/a.csv", "a\n6\n")
    real = autoingest.ingest_files

    def broken(*args):
        if args[3] == "bad":
            raise RuntimeError("not foreseen")
        return real(*args)

    monkeypatch.setattr(autoingest, "ingest_files", broken)
    with pytest.raises(RuntimeError, match="not foreseen"):
        lake.run()
    stored = metadata.read(lake.spark, lake.lake, metadata.REGISTRY).collect()
    assert [(r["file_key"], r["status"]) for r in stored] == [("good/a.csv", "success")]


def test_many_headers_are_loaded_in_portions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), dialects_at_once=2)
    for n in range(5):
        lake.put(f"t/f{n}.csv", f"a,c{n}\n{n + 2},x\n")
    assert set(lake.run().values()) == {("success", 1, 0)}
    assert lake.rows("t", "a") == [(n + 2,) for n in range(5)]
    assert {f"c{n}" for n in range(5)} < set(lake.types("t"))


def test_table_missing_in_the_catalog_keeps_its_rows(lake):
    lake.put("t/a.csv", "a,b\n5,x\n")
    lake.put("t/b.csv", "a,c\n6,y\n")
    lake.run()
    lake.spark.sql(f"DROP TABLE {lake.opts.database}.t")
    lake.put("t/a.csv", "a\n7\n")
    assert lake.run() == {"t/a.csv": ("success", 1, 0)}
    assert lake.rows("t", "a", "b", "c") == [(6, None, "y"), (7, None, None)]


def test_nothing_stays_in_the_scratch_folder(lake):
    root = lake.spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    lake.put("t/a.csv", "a\n5\n")
    lake.run()
    lake.put("t/a.csv", "a\n6\n")
    lake.run()
    assert set(os.listdir(root)) == before
