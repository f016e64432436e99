"""Run catalogue queries against their SQL twins and compare as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def sql_rows(con, text: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(text)
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(con, df, text: str) -> str | None:
    """None when equal, otherwise a short account of the difference."""
    names, got = spark_rows(df)
    want_names, want = sql_rows(con, text)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows; e.g. {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference: {dict(zip(names, a))} != {dict(zip(names, b))}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from wayfare.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    if os.environ.get("PLAIN_SESSION"):  # nothing but Spark's own defaults
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, twins, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = difference(con, df, twins[name]) if name in twins else f"(no twin) {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = problem is None or problem.startswith("(no twin)")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failing; without queries: {sorted(set(twins) - set(queries()))}")
