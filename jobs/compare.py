#!/usr/bin/env python3
"""Compare two record sets.  Exit 0 when equal, 1 when different, 2 on failure."""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Reconcile a baseline and a candidate record set")
    parser.add_argument("--baseline", required=True, help="file or directory of records")
    parser.add_argument("--candidate", required=True, help="file or directory of records")
    parser.add_argument("--report", help="directory for the full report")
    parser.add_argument("--strict", action="store_true", help="also compare aspects outside the supported set")
    parser.add_argument("--exact", action="store_true", help="compare raw keys and values without normalisation")
    parser.add_argument("--layout", choices=("auto", "array", "lines"), default="auto")
    args = parser.parse_args(argv)
    mode = "exact" if args.exact else ("strict" if args.strict else "default")

    from pyspark.sql import SparkSession

    from catrec.plans.compare import compare_paths, summary_line, write_report

    spark = SparkSession.builder.appName("catalogue-compare").getOrCreate()
    try:
        diff = compare_paths(spark, args.baseline, args.candidate, mode=mode, layout=args.layout)
        summary = write_report(spark, diff, args.report) if args.report else diff.summary.first().asDict()
    except Exception as exc:  # noqa: BLE001
        print(f"comparison failed: {exc}", file=sys.stderr)
        return 2
    print(summary_line(summary))
    if not summary["equal"]:
        print(json.dumps(summary, indent=2))
    return 0 if summary["equal"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
