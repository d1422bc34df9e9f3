"""Derive metastore relations from the driver's TPC-H-like test tables.

nation -> DBS, orders ⋈ customer -> TBLS, orders -> SDS, lineitem ->
COLUMNS_V2 (non-returned lines) and PARTITION_KEYS (returned lines),
events -> TABLE_PARAMS.  Every relation grows with the scale factor.
The same derivation is written in DuckDB SQL in :mod:`catrec.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catrec.operators.catalogue import Metastore

# Fixed mapping of l_suppkey % 12 to a Hive type name (covers every rule).
ADAPTER_TYPES = (
    "bigint", "decimal(10,2)", "decimal", "DATE", "timestamp", "boolean",
    "binary", "array<int>", "double", "varchar(20)", "smallint", "map<string,int>",
)
PRIORITY_TYPES = {
    "1-URGENT": "EXTERNAL_TABLE",
    "2-HIGH": "VIRTUAL_VIEW",
    "3-MEDIUM": "MATERIALIZED_VIEW",
    "4-NOT SPECIFIED": None,
}
DEFAULT_TABLE_TYPE = "MANAGED_TABLE"
RENAMED_DATABASE = "NATION_0"
RENAMED_DATABASE_TO = "hive_metastore"


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _type_name(suppkey: Column) -> Column:
    rule = F.pmod(suppkey, F.lit(len(ADAPTER_TYPES)))
    expr = None
    for index, name in enumerate(ADAPTER_TYPES):
        expr = F.when(rule == index, F.lit(name)) if expr is None else expr.when(rule == index, F.lit(name))
    return expr


def _line_name(prefix: str) -> Column:
    return F.concat(
        F.lit(prefix), F.col("l_linenumber").cast("string"), F.lit("_"),
        F.col("l_partkey").cast("string"), F.lit("_"), F.col("l_suppkey").cast("string"),
    )


def _table_type(priority: Column) -> Column:
    expr = None
    for key, value in PRIORITY_TYPES.items():
        lit = F.lit(value).cast("string")
        expr = F.when(priority == key, lit) if expr is None else expr.when(priority == key, lit)
    return expr.otherwise(F.lit(DEFAULT_TABLE_TYPE))


def metastore_from_test_data(spark: SparkSession, sf_dir: str, revision: int = 0) -> Metastore:
    """Revision 0 is the catalogue as derived above.  Revision 1 is the same
    catalogue one release later: low-priority open orders' tables renamed
    (``_v2``), low-priority pending ones dropped, finished tables moved to an
    archive location, comments edited (``signup`` params), column comments
    re-derived with a stricter tax rule, and database ``NATION_0`` renamed to
    the metastore's own name (so the name-keyed comparison sees two
    containers with one name)."""
    t = lambda name: read_test_table(spark, sf_dir, name)
    nation, customer, orders = t("nation"), t("customer"), t("orders")
    lineitem, events = t("lineitem"), t("events")

    updated = revision >= 1
    db_name = F.col("n_name")
    if updated:
        db_name = F.when(db_name == RENAMED_DATABASE, F.lit(RENAMED_DATABASE_TO)).otherwise(db_name)
    dbs = nation.select(F.col("n_nationkey").cast("long").alias("DB_ID"), db_name.alias("NAME"))
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("long")
    low = F.col("o_orderpriority") == "5-LOW"
    table_name = F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))
    if updated:
        table_name = F.when(low & (F.col("o_orderstatus") == "O"), F.concat(table_name, F.lit("_v2"))).otherwise(table_name)
        orders_now = orders.filter(~(low & (F.col("o_orderstatus") == "P")))
    else:
        orders_now = orders
    tbls = orders_now.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("TBL_ID"),
        F.col("c_nationkey").cast("long").alias("DB_ID"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("long")).otherwise(F.col("o_orderkey")).alias("SD_ID"),
        table_name.alias("TBL_NAME"),
        _table_type(F.col("o_orderpriority")).alias("TBL_TYPE"),
        (day * 86400).alias("CREATE_TIME"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("select "), F.col("o_custkey").cast("string")))
        .alias("VIEW_EXPANDED_TEXT"),
        F.when(F.col("o_orderstatus") != "O", F.lit("select 1")).alias("VIEW_ORIGINAL_TEXT"),
    )
    sds = orders.select(
        F.col("o_orderkey").alias("SD_ID"), F.col("o_orderkey").alias("CD_ID"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string"))
        .when(F.lit(updated) & (F.col("o_orderstatus") == "F"),
              F.concat(F.lit("s3://archive/t"), F.col("o_orderkey").cast("string")))
        .otherwise(F.concat(F.lit("s3://b/t"), F.col("o_orderkey").cast("string"))).alias("LOCATION"),
    )
    columns = lineitem.filter(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("CD_ID"),
        _line_name("c").alias("COLUMN_NAME"),
        _type_name(F.col("l_suppkey")).alias("TYPE_NAME"),
        F.col("l_linenumber").alias("INTEGER_IDX"),
        F.when(F.col("l_tax") > (0.06 if updated else 0.04), F.lit(None).cast("string"))
        .otherwise(F.col("l_linestatus")).alias("COMMENT"),
    )
    partition_keys = lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("TBL_ID"),
        _line_name("p").alias("PKEY_NAME"),
        _type_name(F.col("l_suppkey")).alias("PKEY_TYPE"),
        F.col("l_linenumber").alias("INTEGER_IDX"),
        F.col("l_linestatus").alias("PKEY_COMMENT"),
    )
    params = events.select(
        F.col("user_id").alias("TBL_ID"),
        F.when(F.col("event_type") == "signup", F.lit("comment"))
        .when(F.col("event_type") == "error", F.lit("table_type"))
        .otherwise(F.col("event_type")).alias("PARAM_KEY"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
        .when(F.lit(updated) & (F.col("event_type") == "signup"), F.concat(F.col("props"), F.lit(" (updated)")))
        .otherwise(F.col("props")).alias("PARAM_VALUE"),
    )
    return Metastore(dbs=dbs, tbls=tbls, sds=sds, columns=columns, partition_keys=partition_keys, table_params=params)


def other_relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The relations that a snapshot holds besides the six of the transform."""
    t = lambda name: read_test_table(spark, sf_dir, name)
    return {
        "DATABASE_PARAMS": t("nation").select(
            F.col("n_nationkey").cast("long").alias("DB_ID"), F.lit("region").alias("PARAM_KEY"),
            F.col("n_regionkey").cast("string").alias("PARAM_VALUE")),
        "SERDES": t("supplier").select(
            F.col("s_suppkey").cast("long").alias("SERDE_ID"), F.col("s_name").alias("NAME"),
            F.when(F.col("s_nationkey") % 5 != 0, F.concat(F.lit("lib "), F.col("s_nationkey").cast("string"))).alias("SLIB")),
        "SERDE_PARAMS": t("part").select(
            F.col("p_partkey").cast("long").alias("SERDE_ID"), F.col("p_brand").alias("PARAM_KEY"),
            F.col("p_name").alias("PARAM_VALUE")),
    }
