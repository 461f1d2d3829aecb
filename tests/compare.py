"""Run registered queries in Spark and their SQL twins in DuckDB, and compare the rows.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    return None if v is None or v != v else repr(v)


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, run, sql: str | None) -> str:
    """Empty text when both agree, else what differs."""
    df = run(spark, sf_dir)
    names, got = _bag(df.columns, df.collect())
    if sql is None:
        return ""
    cur = con.execute(sql)
    wanted_names, wanted = _bag([d[0] for d in cur.description], cur.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return (f"{sum(extra.values())} rows only in Spark of {sum(got.values())}, {sum(missing.values())} only in SQL of "
                f"{sum(wanted.values())}: {names} {list(extra)[:3]} / {list(missing)[:3]}")
    return ""


def main() -> int:
    import __spark_entry__ as entry
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    # a session as it comes, to show that no query depends on our own settings
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(w) for w in sys.argv[2:]):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, run, oracle.get(name))
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(problem)
        kind = "sql " if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
