import os

import pytest
from pyspark.sql import functions as F

from shoalmark.sources.delimiter import fingerprint
from shoalmark.sources.listing import decoded_path, list_csv

HEADS = {
    "comma": ("a,b\n1,2\n3,4\n", ","),
    "semicolon": ("a;b;c\n1,5;2;3\n4,5;5;6\n", ";"),
    "tab": ("a\tb\n1\t2\n", "\t"),
    "pipe": ("a|b\n1|2", "|"),
    "one_column": ("a\n1\n2\n", ","),
    "quoted": ('a;b\n"x,y,z";2\n"u,v";3\n', ";"),
    "windows": ("a;b\r\n1;2\r\n", ";"),
    "marked": ("\ufeffa|b\n1|2\n", "|"),
    "ragged": ("a;b;c\n1;2\n1;2;3\n4;5;6\n", ";"),
    "tie": ("a,b;c\n1,2;3\n", ","),
}


def test_delimiters(spark, tmp_path):
    for k, (text, _) in HEADS.items():
        (tmp_path / k).mkdir()
        (tmp_path / k / "f.csv").write_text(text, encoding="utf-8", newline="")
    found = _probe(spark, str(tmp_path))
    assert {k.split("/")[0]: r["delimiter"] for k, r in found.items()} == {k: d for k, (_, d) in HEADS.items()}
    assert found["marked/f.csv"]["header"] == "a|b"


@pytest.fixture
def drops(tmp_path):
    files = {
        "customers/q1.csv": "id;name\n1;x\n",
        "customers/q 2+%.CSV": "id;name\n1;é\n",
        "My Data!/deep/er/f.csv": 'a,b\n1,"two\nlines"\n',
        "top.csv": "a,b\n",
        "customers/readme.txt": "no",
        "empty/e.csv": "",
    }
    for key, text in files.items():
        target = tmp_path / key
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(text.encode("utf-8"))
    return str(tmp_path)


EXPECTED = {
    "customers/q1.csv": "customers",
    "customers/q 2+%.CSV": "customers",
    "My Data!/deep/er/f.csv": "my_data",
}


def test_listing(spark, drops):
    # Spark leaves out files of no length.
    rows = list_csv(spark, drops).collect()
    assert {r["key"]: r["table_name"] for r in rows} == EXPECTED
    sizes = {r["key"]: r["size"] for r in rows}
    assert sizes["customers/q1.csv"] == os.path.getsize(f"{drops}/customers/q1.csv")


def test_metadata_paths_equal_listed_paths(spark, drops):
    listed = {r["path"] for r in list_csv(spark, drops).collect()}
    read = spark.read.text(sorted(listed)).select(decoded_path(F.col("_metadata.file_path")))
    assert {r[0] for r in read.distinct().collect()} == listed


def _probe(spark, root):
    files = list_csv(spark, root).cache()
    paths = sorted(r["path"] for r in files.collect())
    with fingerprint(spark, paths) as probed:
        return {r["key"]: r for r in files.join(probed, "path").collect()}


@pytest.mark.parametrize("split_bytes", ["128m", "7b"])
def test_fingerprint(spark, drops, split_bytes):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        found = _probe(spark, drops)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {k: (r["delimiter"], r["header"], r["multi_line"]) for k, r in found.items()} == {
        "customers/q1.csv": (";", "id;name", False),
        "customers/q 2+%.CSV": (";", "id;name", False),
        "My Data!/deep/er/f.csv": (",", "a,b", True),
    }
    assert {r["etag"] for r in _probe(spark, drops).values()} == {r["etag"] for r in found.values()}


def test_tag_follows_the_content(spark, drops):
    before = _probe(spark, drops)["customers/q1.csv"]["etag"]
    with open(f"{drops}/customers/q1.csv", "a") as f:
        f.write("2;y\n")
    assert _probe(spark, drops)["customers/q1.csv"]["etag"] != before


def test_long_lines(spark, tmp_path):
    (tmp_path / "t").mkdir()
    lines = ["a|" + "b" * 20000] + ["x" * 5000 + "|1"] * 4 + [f"{n}|{n}" for n in range(9000)]
    (tmp_path / "t" / "f.csv").write_text("\n".join(lines) + "\n")
    found = _probe(spark, str(tmp_path))["t/f.csv"]
    assert (found["delimiter"], found["header"], found["multi_line"]) == ("|", lines[0], False)


def test_tag_knows_the_order_of_lines_and_blank_ones(spark, tmp_path):
    """Also lines that any sum of moments takes for equal; the splits of a file make no difference."""
    cell = 'id,t\n1,"{}"\n'
    odd = "abbabaabbaababba"
    texts = {
        "plain": cell.format("x\nb\nc\ny"),
        "swapped": cell.format("x\nc\nb\ny"),
        "blank": cell.format("x\n\n\nb\nc\ny"),
        "odd": cell.format("\n".join(odd)),
        "even": cell.format("\n".join(odd.translate({97: 98, 98: 97}))),
        "long": "id,t\n" + "".join(f"{i},{i * i}\n" for i in range(500)),
        "touched": "id,t\n" + "".join(f"{i},{i * i}\n" for i in range(500)),
        "moved": "id,t\n" + "".join(f"{i},{i * i}\n" for i in (*range(1, 500), 0)),
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before, seen = {n: spark.conf.get(n) for n in names}, []
    try:
        for size in ("97", "1000", "100000000"):
            spark.conf.set(names[0], size)
            spark.conf.set(names[1], "0")
            with fingerprint(spark, [str(tmp_path / f"{n}.csv") for n in texts]) as found:
                rows = {r["path"].rsplit("/", 1)[1][:-4]: r for r in found.collect()}
            assert {r["header"] for r in rows.values()} == {"id,t"}
            seen.append({n: r["etag"] for n, r in rows.items()})
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert seen[0] == seen[1] == seen[2]
    assert seen[0]["long"] == seen[0]["touched"]
    assert len(set(seen[0].values())) == len(texts) - 1
