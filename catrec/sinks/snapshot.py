"""Snapshot writer: every relation as gzip JSON lines plus a manifest.

Per table: values are normalised to JSON-safe types (bytes -> UTF-8 text,
dates/timestamps -> ISO strings, decimals -> strings), nulls are written
explicitly, tables are dumped by concurrent jobs, files are sharded at ``rows_per_file`` by the writer itself
(``maxRecordsPerFile``) and renamed ``part-%05d.jsonl.gz``.  Row counts come
from an ``observe`` on the write (no second pass).  The manifest is written
last, also when a table fails, and says ``complete: true`` only when every
table was written.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catrec.functions.values import normalize_row_values
from catrec.sinks import fs
from catrec.sources.jdbc import validate_table_name

#: Tables dumped at the same time, so that a small one doesn't wait for the tail of a large one.
DUMPS_AT_ONCE = 4
SNAPSHOT_PART_FORMAT = "part-{:05d}.jsonl.gz"


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def finalize_table_dir(spark: SparkSession, path: str) -> int:
    """Rename parts to ``part-%05d.jsonl.gz``; an empty table gets one empty,
    readable gzip part.  Returns the number of part files."""
    entries = fs.list_files(spark, path)
    parts = sorted(name for name, _, is_file in entries if is_file and name.startswith("part-"))
    for name, _, _ in entries:
        if name not in parts:
            fs.delete(spark, path, name)
    fs.rename_all(spark, path, {name: SNAPSHOT_PART_FORMAT.format(index) for index, name in enumerate(parts)})
    if not parts:
        fs.write_bytes(spark, f"{path.rstrip('/')}/{SNAPSHOT_PART_FORMAT.format(0)}", gzip.compress(b""))
        return 1
    return len(parts)


def dump_table(spark: SparkSession, df: DataFrame, path: str, rows_per_file: int) -> dict:
    observation = Observation()
    out = normalize_row_values(df).observe(observation, F.count(F.lit(1)).alias("rows"))
    (out.write.mode("errorifexists").option("compression", "gzip").option("maxRecordsPerFile", rows_per_file)
     .option("ignoreNullFields", False).json(path))
    files = finalize_table_dir(spark, path)
    return {"rows": int(observation.get["rows"]), "files": files}


def write_snapshot(
    spark: SparkSession, tables: Mapping[str, DataFrame], output_dir: str, snapshot_id: str | None = None,
    rows_per_file: int = 200000, database: str | None = None, consistent_snapshot: bool = False,
) -> str:
    """Dump ``tables`` under ``output_dir/snapshot_id``; returns the root path."""
    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be positive")
    snapshot_id = snapshot_id or datetime.now(timezone.utc).strftime("snapshot-%Y%m%dT%H%M%SZ")
    root = f"{output_dir.rstrip('/')}/{snapshot_id}"
    if fs.exists(spark, root):
        raise FileExistsError(root)
    fs.mkdirs(spark, root)
    manifest: dict = {
        "snapshot_id": snapshot_id, "started_at": _now(), "database": database,
        "consistent_snapshot": consistent_snapshot, "tables": [], "complete": False,
    }
    try:
        for name in tables:
            validate_table_name(name)
        with ThreadPoolExecutor(max_workers=DUMPS_AT_ONCE) as pool:
            dumps = {name: pool.submit(dump_table, spark, df, f"{root}/{name}", rows_per_file) for name, df in tables.items()}
        # A table that failed fails the snapshot, after the others are told.
        manifest["tables"] = [{"table": name, **dump.result()} for name, dump in dumps.items() if not dump.exception()]
        for dump in dumps.values():
            dump.result()
        manifest["complete"] = True
        manifest["completed_at"] = _now()
        return root
    finally:
        text = json.dumps(manifest, ensure_ascii=False, indent=2) + "\n"
        fs.write_bytes(spark, f"{root}/manifest.json", text.encode("utf-8"), overwrite=True)
