"""Fail-fast checks run before anything is written.

Each check is one small Spark job that stops at the first offending row
(``limit(1)``), so the cost does not grow with the number of offenders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catrec.functions.urns import has_urn_delimiter


class GateError(RuntimeError):
    """A snapshot or record set violates an invariant of the transform."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key that occurs more than once, with its multiplicity ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], label: str) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise GateError(f"snapshot contains duplicate {label}")


def assert_unique_ids(dbs: DataFrame, tbls: DataFrame) -> None:
    """DB_ID must be unique among exported databases, TBL_ID among all tables.

    Both checks run as one job: the union is grouped on a (relation, id) key.
    """
    ids = dbs.select(F.lit("DBS.DB_ID").alias("rel"), F.col("DB_ID").alias("id")).unionByName(
        tbls.select(F.lit("TBLS.TBL_ID").alias("rel"), F.col("TBL_ID").alias("id"))
    )
    if not duplicate_keys(ids, ["rel", "id"]).isEmpty():
        raise GateError("snapshot contains duplicate DBS.DB_ID or TBLS.TBL_ID")


def delimiter_rows(df: DataFrame, name: Column | str) -> DataFrame:
    column = F.col(name) if isinstance(name, str) else name
    return df.filter(has_urn_delimiter(column))


def assert_no_delimiters(df: DataFrame, name: Column | str) -> None:
    if not delimiter_rows(df, name).isEmpty():
        raise GateError("database/table name contains a tuple URN delimiter: (, ) or ,")


def assert_manifest_complete(manifest: DataFrame) -> None:
    """Exactly the snapshot's own statement decides: ``complete`` must be true."""
    if manifest.filter(F.col("complete") == F.lit(True)).isEmpty():
        raise GateError("snapshot manifest is missing or incomplete")


def assert_no_corrupt(df: DataFrame, column: str = "_corrupt_record") -> None:
    if column in df.columns and not df.filter(F.col(column).isNotNull()).isEmpty():
        raise GateError("input contains rows that are not valid JSON objects")
