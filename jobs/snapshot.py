#!/usr/bin/env python3
"""Metastore RDBMS (JDBC) -> snapshot directory with manifest."""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catrec.schemas import SNAPSHOT_TABLES  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Dump metastore tables to a snapshot")
    parser.add_argument("--jdbc-url", required=True)
    parser.add_argument("--user")
    parser.add_argument("--password-env", default="METASTORE_DB_PASSWORD",
                        help="name of the environment variable holding the password")
    parser.add_argument("--driver", help="JDBC driver class")
    parser.add_argument("--database", help="recorded in the manifest")
    parser.add_argument("--tables", nargs="*", default=list(SNAPSHOT_TABLES))
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--snapshot-id")
    parser.add_argument("--rows-per-file", type=int, default=200000)
    parser.add_argument("--fetch-size", type=int, default=5000)
    parser.add_argument("--partition", action="append", default=[],
                        help="TABLE:COLUMN:N reads TABLE in N parallel ranges of COLUMN")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from catrec.sinks.snapshot import write_snapshot
    from catrec.sources.jdbc import read_jdbc_tables

    properties = {}
    if args.user:
        properties["user"] = args.user
    password = os.environ.get(args.password_env)
    if password is not None:
        properties["password"] = password
    if args.driver:
        properties["driver"] = args.driver
    partitioning = {}
    for spec in args.partition:
        table, column, parts = spec.split(":")
        partitioning[table] = (column, int(parts))
    spark = SparkSession.builder.appName("catalogue-snapshot").getOrCreate()
    tables = read_jdbc_tables(spark, args.jdbc_url, args.tables, properties, args.fetch_size, partitioning)
    root = write_snapshot(spark, tables, args.output_dir, args.snapshot_id, args.rows_per_file,
                          database=args.database, consistent_snapshot=False)
    print(root)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
