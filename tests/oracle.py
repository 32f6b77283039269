"""Run registered queries beside their SQL and compare the rows.

``python tests/oracle.py [folder] [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    """Same column names, same rows in any order, values equal to the last bit."""
    names = sorted(spark_df.columns)
    mine = sorted(tuple(_norm(r[n]) for n in names) for r in spark_df.collect())
    cursor = con.execute(sql)
    theirs_names = [d[0] for d in cursor.description]
    if sorted(theirs_names) != names:
        return False, f"columns {names} != {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = sorted(tuple(_norm(row[i]) for i in at) for row in cursor.fetchall())
    if mine == theirs:
        return True, f"{len(mine)} rows"
    only_mine = [r for r in mine if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(mine)][:3]
    return False, f"rows {len(mine)} vs {len(theirs)} {names}\n  spark {only_mine}\n  sql   {only_theirs}"


if __name__ == "__main__":
    from shoalmark.session import build_session

    import __spark_entry__ as entry_module

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry_module.oracle_sql()
    bad = []
    for name, run in entry_module.queries().items():
        if args[1:] and not any(name.startswith(a) for a in args[1:]):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                ok, note = compare(df, con, oracles[name])
            else:
                ok, note = True, f"{len(df.collect())} rows, no SQL"
        except Exception as problem:  # noqa: BLE001 - reported, then counted as a failure
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:1500]}"
        if not ok:
            bad.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:36s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))
