"""Snapshot scans: one directory of gzip JSON-lines per relation + manifest.

Gzip parts are not splittable, so scan parallelism equals the number of
part files; the snapshot writer shards tables with ``rows_per_file`` for
exactly that reason.  Column pruning reaches the JSON scan (only the
columns a plan uses are converted).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catrec.operators.catalogue import Metastore
from catrec.operators.gates import GateError, assert_manifest_complete
from catrec.schemas import MANIFEST_SCHEMA, METASTORE_SCHEMAS, TRANSFORM_TABLES

# Matches both ``part-00000.jsonl.gz`` and Spark's ``part-...-c000.json.gz``.
PART_GLOB = "*.json*"
DAMAGED = "_damaged_line"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Read one relation; fixed schema when known, inferred otherwise.

    Parsing is permissive: a value of the wrong type becomes null and the
    row is kept (e.g. bit columns dumped as text).  A line that is no JSON at
    all (a damaged file) fails the read of a relation with a fixed schema.
    """
    schema = schema if schema is not None else METASTORE_SCHEMAS.get(name)
    reader = spark.read.option("pathGlobFilter", PART_GLOB).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.json(table_path(root, name))
    marked = T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())])
    rows = reader.schema(marked).option("columnNameOfCorruptRecord", DAMAGED).json(table_path(root, name))
    damaged = F.col(DAMAGED).isNotNull() & F.expr(f"try_parse_json({DAMAGED})").isNull()
    # The message names a column too: a scan may not ask for the damaged text alone.
    message = F.concat_ws(" ", F.lit(f"snapshot table {name} holds a line that is not JSON:"),
                          F.substring(DAMAGED, 1, 200), F.col(schema.fieldNames()[0]).cast("string"))
    sound = F.coalesce(F.when(damaged, F.raise_error(message).cast("boolean")), F.lit(True))
    return rows.where(sound).drop(DAMAGED)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(f"{root.rstrip('/')}/manifest.json")


def check_manifest(spark: SparkSession, root: str) -> None:
    try:
        manifest = read_manifest(spark, root)
        assert_manifest_complete(manifest)
    except AnalysisException as exc:
        raise GateError("snapshot manifest is missing or incomplete") from exc


def read_snapshot(spark: SparkSession, root: str, check: bool = True) -> Metastore:
    """The six transform relations of a snapshot, after the manifest gate."""
    if check:
        check_manifest(spark, root)
    return Metastore.from_tables({name: read_table(spark, root, name) for name in TRANSFORM_TABLES})
