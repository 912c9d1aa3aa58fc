"""Side-by-side check of registered queries against their SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# type names of the check engine that a Spark type may meet
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def tidy(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def compare(spark, con, folder: str, name: str, fn, sql: str | None) -> list[str]:
    df = fn(spark, folder)
    cols = sorted(df.columns)
    got = [tuple(tidy(r[c]) for c in cols) for r in df.collect()]
    if sql is None:
        return [] if got else ["no rows"]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want_raw = cur.fetchall()
    problems = []
    if sorted(names) != cols:
        return [f"columns {cols} != {sorted(names)}"]
    for f in df.schema:
        if SAME_TYPE.get(f.dataType.simpleString()) != types[f.name]:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} vs {types[f.name]}")
    order = [names.index(c) for c in cols]
    want = [tuple(tidy(r[i]) for i in order) for r in want_raw]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not got:
        problems.append("no rows")
    got.sort(key=sort_key)
    want.sort(key=sort_key)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        diff = {c: (a, b) for c, a, b in zip(cols, g, w) if a != b}
        problems.append(f"{len(bad)} rows differ, first {diff}")
    return problems


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    folder = "/root/testdata/sf0.01"
    only = sys.argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            problems = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - t:.2f}s {'' if name in sqls else '(rows only)'} {problems or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
