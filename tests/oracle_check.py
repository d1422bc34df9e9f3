"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: ``python tests/oracle_check.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode("utf-8", "replace")
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str, con) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    s_names = df.columns
    s_rows = _rows([tuple(r) for r in df.collect()], s_names)
    mid = time.time()
    cur = con.execute(sql)
    d_names = [c[0] for c in cur.description]
    d_rows = _rows(cur.fetchall(), d_names)
    end = time.time()
    if sorted(s_names) != sorted(d_names):
        return False, f"columns differ: spark={s_names} duckdb={d_names}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}"
    if s_rows != d_rows:
        s_set, d_set = set(map(repr, s_rows)), set(map(repr, d_rows))
        only_s = sorted(s_set - d_set)[:3]
        only_d = sorted(d_set - s_set)[:3]
        return False, f"values differ ({len(s_set ^ d_set)})\n  spark: {only_s}\n  duck:  {only_d}"
    return True, f"{len(s_rows)} rows (spark {mid - start:.1f}s, duckdb {end - mid:.1f}s)"


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        if name not in sqls:
            n = query(spark, sf_dir).count()
            print(f"[rows-only] {name}: {n} rows")
            continue
        try:
            ok, msg = compare(spark, sf_dir, name, query, sqls[name], con)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"error: {str(exc)[:2000]}"
        failed += not ok
        print(f"[{'ok' if ok else 'FAIL'}] {name}: {msg}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
