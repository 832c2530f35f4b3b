"""Run every registered query next to its SQL counterpart on one scale factor.

Usage: python tests/compare.py SF_DIR [query name prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return (0 if v is None else 2, str(v))
    if isinstance(v, float) and math.isnan(v):
        return (1, "nan")
    return (1, repr(float(v)))


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, text: str) -> str | None:
    """None if both results hold the same columns and rows, else what differs."""
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    want = canonical(names, cur.fetchall())
    got = canonical(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if got != want:
        in_got, in_want = set(got), set(want)
        only_got = [r for r in got if r not in in_want][:3]
        only_want = [r for r in want if r not in in_got][:3]
        return f"rows {len(got)} / {len(want)}; only Spark {only_got}; only SQL {only_want}"
    return None


def main() -> int:
    import __spark_entry__ as E
    from mirrorflow.sources.scratch import clear_scratch, local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = local_session(builder)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf_dir), E.oracle_sql(), 0
    for name, query in E.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                note = "same" if problem is None else problem
            else:
                problem, note = None, f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001 - report and go on to the next query
            problem = note = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    clear_scratch(spark)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
