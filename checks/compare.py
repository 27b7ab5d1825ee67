"""Run a query and its SQL twin and compare their rows exactly: ``python -m checks.compare [ids]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import ORACLES, QUERIES

spark_seconds = 0.0
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[int, str]:
    """Rows of the query, and a description of the first difference or an empty text."""
    global spark_seconds
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=key)
    spark_seconds = time.time() - start
    if name not in ORACLES:
        return len(got), ""
    rel = con.sql(ORACLES[name])
    if sorted(rel.columns) != names:
        return len(got), f"columns {names} != {sorted(rel.columns)}"
    want = sorted(rel.select(*[f'"{n}"' for n in names]).fetchall(), key=key)
    if len(got) != len(want):
        return len(got), f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return len(got), f"{len(wrong)} rows differ in {names}, first {wrong[0]}"
    kinds = [(a, b) for a, b in zip(got[:1], want[:1]) for a, b in zip(a, b) if type(a) is not type(b) and None not in (a, b)]
    return len(got), f"types differ: {kinds}" if kinds else ""


def main() -> None:
    sf_dir = "/root/testdata/sf0.01"
    wanted = [a for a in sys.argv[1:] if not a.startswith("/")] or list(QUERIES)
    sf_dir = next((a for a in sys.argv[1:] if a.startswith("/")), sf_dir)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in wanted:
        start = time.time()
        try:
            n, problem = differences(spark, con, name, sf_dir)
        except Exception as e:
            n, problem = -1, f"{type(e).__name__}: {str(e)[:1500]}"
        mark = "FAIL" if problem else ("ok" if name in ORACLES else "ok*")
        print(f"{mark:5}{name:28}{n:8} rows {spark_seconds:6.2f}s {time.time() - start:6.2f}s  {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
