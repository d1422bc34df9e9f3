"""The transform job: snapshot -> gates -> change records -> record files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from catrec.operators.catalogue import Metastore, base_tables, exported_databases
from catrec.operators.events import catalogue_events
from catrec.operators.gates import assert_no_delimiters, assert_unique_ids
from catrec.options import CatalogueOptions
from catrec.sinks.records import write_records
from catrec.sources.snapshot import read_snapshot


@dataclass(frozen=True)
class TransformSummary:
    databases: int
    tables: int
    mcps: int
    files: int
    bytes: int

    def as_dict(self) -> dict:
        return {"databases": self.databases, "tables": self.tables, "mcps": self.mcps,
                "files": self.files, "bytes": self.bytes}


def checked_events(spark: SparkSession, m: Metastore, o: CatalogueOptions) -> DataFrame:
    """Run the gates (duplicate ids, URN delimiters), then plan the records."""
    dbs = exported_databases(m, o)
    assert_unique_ids(dbs, m.tbls)
    base = base_tables(m, o)
    assert_no_delimiters(base, "DATASET_NAME")
    return catalogue_events(spark, m, o, base)


def transform_metastore(
    spark: SparkSession, m: Metastore, output: str, o: CatalogueOptions,
    max_file_size: int | str | None = None, single_file: bool = False, mode: str = "errorifexists",
) -> TransformSummary:
    events = checked_events(spark, m, o)
    result = write_records(events, output, max_file_size=max_file_size, single_file=single_file, mode=mode)
    return TransformSummary(
        # Every exported database yields one containerProperties, plus the root.
        databases=result.containers - 1, tables=result.datasets, mcps=result.records,
        files=result.files, bytes=result.bytes,
    )


def transform_snapshot(
    spark: SparkSession, snapshot: str, output: str, o: CatalogueOptions,
    max_file_size: int | str | None = None, single_file: bool = False, mode: str = "errorifexists",
) -> TransformSummary:
    """Gate on the manifest, read the six relations and write the records."""
    m = read_snapshot(spark, snapshot)
    return transform_metastore(spark, m, output, o, max_file_size, single_file, mode)
