#!/usr/bin/env python3
"""Snapshot -> change-record files.  Prints a JSON run summary."""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catrec.options import CatalogueOptions, parse_byte_size  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Convert a metastore snapshot to change-record JSON arrays")
    parser.add_argument("--snapshot", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--env", default="PROD")
    parser.add_argument("--platform", default="hive")
    parser.add_argument("--platform-instance")
    parser.add_argument("--database-pattern", default=".*")
    parser.add_argument("--metastore-name", default="hive_metastore")
    parser.add_argument("--source-timezone", default="UTC")
    parser.add_argument("--single-file", action="store_true")
    parser.add_argument("--max-file-size", help="target file size, e.g. 20k, 20M or 1G (default 20M)")
    parser.add_argument("--overwrite", action="store_true")
    args = parser.parse_args(argv)
    size = parse_byte_size(args.max_file_size) if args.max_file_size else None
    if args.single_file and size is not None:
        parser.error("--single-file cannot be used with --max-file-size")

    from pyspark.sql import SparkSession

    from catrec.plans.transform import transform_snapshot

    spark = SparkSession.builder.appName("catalogue-transform").getOrCreate()
    options = CatalogueOptions(
        platform=args.platform, env=args.env, platform_instance=args.platform_instance,
        metastore_name=args.metastore_name, database_pattern=args.database_pattern,
        source_timezone=args.source_timezone,
    )
    summary = transform_snapshot(spark, args.snapshot, args.output, options, max_file_size=size,
                                 single_file=args.single_file, mode="overwrite" if args.overwrite else "errorifexists")
    print(json.dumps(summary.as_dict()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
