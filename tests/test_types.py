import datetime as dt
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shoalmark.functions import coltypes
from shoalmark.functions.text import WHITESPACE, blank_to_null, money_label, percent, strip
from shoalmark.operators.inference import infer_schema, match_shares, profile, with_type

BIG = "9999999999"
VECTORS = {
    "zero_one": (["0", "1", "1", "0"], "BOOLEAN"),
    "words": (["yes", "NO", "True"], "BOOLEAN"),
    "one_to_ten": ([str(n) for n in range(1, 11)], "INTEGER"),
    "one_big": ([str(n) for n in range(2, 11)] + [BIG], "INTEGER"),
    "half_big": (["12", BIG] * 5, "BIGINT"),
    "reals": (["1.5", "2.0", "3e5", "5."], "DOUBLE"),
    "mixed_numbers": (["10", "10.5"] * 5, "VARCHAR"),
    "leading_point": ([".5", ".6"], "VARCHAR"),
    "plus_sign": (["+5.0", "+6.0"], "VARCHAR"),
    "short_dates": (["2024-01-15", "2024-1-5"], "DATE"),
    "both_orders": (["15/01/2024", "01/15/2024"], "DATE"),
    "dashes_last": (["15-01-2024", "01-15-2024", "2024/01/15"], "DATE"),
    "no_such_day": (["2024-02-30"], "VARCHAR"),
    "mixed_separators": (["2024-01/15"], "VARCHAR"),
    "moments": (["2024-01-15T10:30:00Z", "2024-01-15 10:30:00.5"], "TIMESTAMP(6)"),
    "blank_with_z": (["2024-01-15 10:30:00Z"], "VARCHAR"),
    "seven_digits": (["2024-01-15T10:30:00.1234567"], "VARCHAR"),
    "no_such_hour": (["2024-01-15T25:30:00"], "VARCHAR"),
    "ninety_percent": ([str(n) for n in range(2, 11)] + ["x"], "INTEGER"),
    "eighty_percent": ([str(n) for n in range(2, 10)] + ["x", "x"], "VARCHAR"),
    "blanks": (["", " ", "\t"], "VARCHAR"),
    "blanks_do_not_count": (["5", " ", "6", " \n"], "INTEGER"),
    "short_year": (["24-1-5"], "VARCHAR"),
    "endless": (["9" * 26], "BIGINT"),
    "year_zero": (["0000-01-01"], "VARCHAR"),
}


def test_inference_vectors(spark):
    rows = [(case, v) for case, (values, _) in VECTORS.items() for v in values]
    df = spark.createDataFrame(rows, "_source_file string, value string")
    found = with_type(profile(df, ["value"])).select("_source_file", "type").collect()
    assert {r[0]: r[1] for r in found} == {case: t for case, (_, t) in VECTORS.items()}


def test_no_rows_is_text(spark):
    assert infer_schema(spark.createDataFrame([], "a string"), ["a"]) == [("a", "VARCHAR")]


def test_schema_in_column_order(spark):
    df = spark.createDataFrame([("x", "1.5", "7"), ("y", "2.5", "8")], "b string, a string, c string")
    assert infer_schema(df, ["b", "a", "c"]) == [("b", "VARCHAR"), ("a", "DOUBLE"), ("c", "INTEGER")]


def test_lattice_option_widens(spark):
    df = spark.createDataFrame([("10",), ("10.5",)], "a string")
    assert infer_schema(df, ["a"]) == [("a", "VARCHAR")]
    assert infer_schema(df, ["a"], numeric_lattice=True) == [("a", "DOUBLE")]


def test_shares(spark):
    df = spark.createDataFrame([("f", "1"), ("f", "2"), ("f", " ")], "_source_file string, a string")
    row = match_shares(profile(df, ["a"])).first()
    assert (row["filled"], row["boolean_share"], row["integer_share"]) == (2, 0.5, 1.0)


READ = [
    ("BOOLEAN", " Yes ", True),
    ("BOOLEAN", "0", False),
    ("BOOLEAN", "t", None),
    ("INTEGER", "2147483647", 2147483647),
    ("INTEGER", "2147483648", None),
    ("INTEGER", "5.0", None),
    ("BIGINT", "-9223372036854775808", -(2**63)),
    ("BIGINT", "9" * 26, None),
    ("DOUBLE", "5.", 5.0),
    ("DOUBLE", "10", 10.0),
    ("DOUBLE", "1.5d", None),
    ("DOUBLE", "NaN", None),
    ("DATE", "03/04/2024", dt.date(2024, 4, 3)),
    ("DATE", "04/13/2024", dt.date(2024, 4, 13)),
    ("DATE", "2024/1/5", dt.date(2024, 1, 5)),
    ("DATE", "31-12-2023", dt.date(2023, 12, 31)),
    ("DATE", "2023-02-29", None),
    ("TIMESTAMP(6)", "2024-01-15T10:30:00.25Z", dt.datetime(2024, 1, 15, 10, 30, 0, 250000)),
    ("TIMESTAMP(6)", "2024-1-5 1:2:3", dt.datetime(2024, 1, 5, 1, 2, 3)),
    ("VARCHAR", "  x ", "  x "),
    ("VARCHAR", " \t ", None),
]


def test_reading_values(spark):
    for name in {t for t, _, _ in READ}:
        cases = [(raw, want) for t, raw, want in READ if t == name]
        df = spark.createDataFrame([(raw,) for raw, _ in cases], "raw string")
        value = coltypes.read_as(F.col("raw"), name)
        if name.startswith("TIMESTAMP"):
            value = value.cast("timestamp_ntz")
        got = {r[0]: r[1] for r in df.select("raw", value).collect()}
        assert got == dict(cases), name


DATE_FORMATS = ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y/%m/%d", "%d-%m-%Y", "%m-%d-%Y"]
TIME_FORMATS = [
    f"%Y-%m-%d{sep}%H:%M:%S{frac}{z}"
    for sep, z in (("T", ""), ("T", "Z"), (" ", ""))
    for frac in ("", ".%f")
]


def _parses(text: str, formats: list[str]) -> bool:
    for f in formats:
        try:
            datetime.strptime(text, f)
            return True
        except ValueError:
            pass
    return False


@pytest.mark.parametrize("seed", [1, 2])
def test_dates_and_times_against_strptime(spark, seed):
    rnd = random.Random(seed)
    texts = set()
    for _ in range(1500):
        y, m, d = rnd.randint(1, 2500), rnd.randint(0, 14), rnd.randint(0, 33)
        sep = rnd.choice("-/")
        style = rnd.choice(["{y:04d}{s}{m}{s}{d}", "{d:02d}{s}{m:02d}{s}{y:04d}", "{m}{s}{d}{s}{y}"])
        text = style.format(y=y, m=m, d=d, s=sep)
        if rnd.random() < 0.5:
            text += rnd.choice("T ") + f"{rnd.randint(0, 25)}:{rnd.randint(0, 61)}:{rnd.randint(0, 59)}"
            text += rnd.choice(["", "Z", ".5", ".123456", ".1234567", ".5Z"])
        texts.add(text)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(
        "t",
        coltypes.matches(F.col("t"), "DATE").alias("d"),
        coltypes.matches(F.col("t"), "TIMESTAMP(6)").alias("m"),
    ).collect()
    for r in got:
        assert r["d"] == _parses(r["t"], DATE_FORMATS), r["t"]
        assert r["m"] == _parses(r["t"], TIME_FORMATS), r["t"]


def test_strip_knows_every_blank(spark):
    assert all(c.isspace() for c in WHITESPACE)
    df = spark.createDataFrame([(WHITESPACE + "a b" + WHITESPACE,), (WHITESPACE,)], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == ["a b", ""]
    assert [r[0] is None for r in df.select(blank_to_null(F.col("t"))).collect()] == [False, True]


def test_labels_and_percent(spark):
    row = spark.range(1).select(
        money_label(F.lit(1234567.891)), percent(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(4))
    ).first()
    assert tuple(row) == ("$1,234,567.89", None, 25.0)
