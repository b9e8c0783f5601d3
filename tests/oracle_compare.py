"""Run registered queries and their SQL side by side; also a command line tool."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def compare(spark, name, fn, sql, folder, con):
    """None when equal, else a text saying where the two differ."""
    df = fn(spark, folder)
    left = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right = _sorted([c[0] for c in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from moodtape.session import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                result = f"rows only: {entry.queries()[name](spark, folder).count()}"
            else:
                result = compare(spark, name, entry.queries()[name], sql, folder, con) or "ok"
        except Exception as e:
            result = f"ERROR {str(e)[:1500]}"
        print(f"{name:30s} {time.time() - start:6.2f}s {result}"[:1800], flush=True)
