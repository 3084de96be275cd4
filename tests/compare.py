"""Run registered queries against DuckDB and compare whole results.

Usage: python tests/compare.py [sf] [name-prefix …]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def check(spark, con, name, fn, sql, sf_dir):
    """Return None when equal, else a description."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE"}
    types = dict(zip(rel.columns, map(str, rel.types)))
    odd = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes if kinds.get(t, t) != types[c]]
    want = rows_of(rel.columns, rel.fetchall())
    if got != want:
        extra = [r for r in got if r not in set(want)][:3] if len(got) < 200000 else []
        lost = [r for r in want if r not in set(got)][:3] if len(got) < 200000 else []
        return f"{len(got)} rows vs {len(want)} cols {sorted(df.columns)}; only ours {extra}; only SQL {lost}"
    if odd:
        return f"types differ: {odd}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from logspark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    prefixes = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            problem = check(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
            if prefixes:
                traceback.print_exc(limit=4)
        flag = "ok " if problem is None else "BAD"
        print(f"{flag} {name} {time.time() - start:.1f}s {'' if oracle.get(name) else '(rows only)'} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
