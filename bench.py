#!/usr/bin/env python3
"""Benchmark the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}``
where every query time is the median of ``$BENCH_REPEATS`` runs (default 3)
and ``value`` is their sum.

Jobs timed (all over the whole test tables):
* ``catalogue_events``  - every change record of the adapter catalogue (noop sink)
* ``ordered_fields`` / ``custom_properties`` - the per-table aggregates (noop sink)
* ``transform_write``  - the full transform incl. the size-bounded JSON-array sink
* ``flatten_records``  - records re-packed into bundles and flattened back (noop)
* ``reconcile_summary`` - two written record sets (revision 0 vs 1) scanned,
  indexed and reconciled, summary only
* ``reconcile_report`` - the same, with every report listing written
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    scratch = tempfile.mkdtemp(prefix="catrec-bench-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("catrec-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus * 2))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    from catrec.operators.events import catalogue_events
    from catrec.plans.adapter import metastore_from_test_data
    from catrec.plans.compare import compare_paths, write_report
    from catrec.plans.registry import QUERIES, QUERY_OPTIONS
    from catrec.sinks.records import write_records

    counter = iter(range(1 << 30))

    def fresh(name: str) -> str:
        return os.path.join(scratch, f"{name}-{next(counter)}")

    def events(revision: int):
        return catalogue_events(spark, metastore_from_test_data(spark, sf_dir, revision), QUERY_OPTIONS)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def summary_only(diff) -> None:
        # Release the per-side caches so every repeat reads its input again.
        diff.summary.collect()
        diff.release()

    # Inputs of the reconciliation: both revisions written once as record files.
    baseline_dir, candidate_dir = fresh("baseline"), fresh("candidate")
    written = write_records(events(0), baseline_dir)
    write_records(events(1), candidate_dir)

    jobs = {
        "catalogue_events": lambda: noop(QUERIES["catalogue_events"](spark, sf_dir)),
        "ordered_fields": lambda: noop(QUERIES["ordered_fields"](spark, sf_dir)),
        "custom_properties": lambda: noop(QUERIES["custom_properties"](spark, sf_dir)),
        "transform_write": lambda: write_records(events(0), fresh("records")),
        "flatten_records": lambda: noop(QUERIES["flatten_records"](spark, sf_dir)),
        "reconcile_summary": lambda: summary_only(compare_paths(spark, baseline_dir, candidate_dir)),
        "reconcile_report": lambda: write_report(spark, compare_paths(spark, baseline_dir, candidate_dir),
                                                 fresh("report")),
    }
    noop(QUERIES["base_tables"](spark, sf_dir))  # warm-up (JIT, file listing caches)
    times: dict[str, float] = {}
    for name, job in jobs.items():
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            job()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_job_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "records": written.records, "record_files": written.files,
        "repeats": repeats, "cpus": cpus, "spark": spark.version, "machine": platform.machine(),
    }))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
