"""The reference's 104-table integration catalogue (two databases, four
hand-made tables, 100 generated tables, then three updates to table 042),
rebuilt as Spark DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catrec.options import CatalogueOptions
from catrec.schemas import METASTORE_SCHEMAS

OPTIONS = CatalogueOptions(env="UAT", platform="hive", platform_instance="hive",
                           metastore_name="hive_metastore_test", source_timezone="Asia/Shanghai")


def _frame(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, METASTORE_SCHEMAS[name])


def golden_tables(spark: SparkSession) -> dict[str, DataFrame]:
    dbs = _frame(spark, "DBS", [
        (1, "Local Hive integration database", "file:///tmp/hive/warehouse", "hive", "hive_admin", "USER", "hive"),
        (2, "Must be filtered out", "file:///tmp/ignored", "ignored", "nobody", "USER", "hive"),
    ])
    tf, to = "org.apache.hadoop.mapred.TextInputFormat", "org.apache.hadoop.hive.ql.io.HiveIgnoreKeyTextOutputFormat"
    sds = _frame(spark, "SDS", [
        (20, 30, "parquet.input", False, "file:///tmp/hive/warehouse/orders", 0, "parquet.output", 50, False),
        (21, 31, tf, False, "file:///tmp/hive/warehouse/customers", 0, to, 51, False),
        (22, 32, tf, False, "file:///tmp/hive/warehouse/order_view", 0, to, 52, False),
        (23, 33, tf, False, "file:///tmp/ignored/not_exported", 0, to, 53, False),
    ])
    tbls = _frame(spark, "TBLS", [
        (10, 1710000000, 1, 0, "alice", 0, 20, "orders", "EXTERNAL_TABLE", None, None, False),
        (11, 1710000100, 1, 0, "bob", 0, 21, "customers", "MANAGED_TABLE", None, None, False),
        (12, 1710000200, 1, 0, "carol", 0, 22, "order_view", "VIRTUAL_VIEW",
         "SELECT id, amount FROM hive.orders", "SELECT id, amount FROM orders", False),
        (13, 1710000300, 2, 0, "nobody", 0, 23, "not_exported", "MANAGED_TABLE", None, None, False),
    ])
    columns = _frame(spark, "COLUMNS_V2", [
        (30, "Order identifier", "id", "bigint", 0), (30, "Order amount", "amount", "decimal(10,2)", 1),
        (31, "Customer identifier", "customer_id", "bigint", 0), (31, "Customer name", "name", "string", 1),
        (32, "Order identifier", "id", "bigint", 0), (32, "Order amount", "amount", "decimal(10,2)", 1),
        (33, "Ignored field", "x", "string", 0),
    ])
    partition_keys = _frame(spark, "PARTITION_KEYS", [(10, "Partition date", "dt", "date", 10)])
    params = _frame(spark, "TABLE_PARAMS", [
        (10, "comment", "Orders from the integration test"), (10, "classification", "gold"),
        (11, "comment", "Customer master data"), (12, "comment", "Order projection view"),
    ])

    # 100 generated tables, i = 1..100, then the updates of table 042.
    i = spark.range(1, 101).select(F.col("id").alias("i"))
    n = F.lpad(F.col("i").cast("string"), 3, "0")
    name = F.concat(F.lit("test_table_"), n)
    is42 = F.col("i") == 42
    bulk_tbls = i.select(
        (F.col("i") + 1000).alias("TBL_ID"), (F.col("i") + 1710100000).alias("CREATE_TIME"), F.lit(1).cast("long").alias("DB_ID"),
        F.lit(0).cast("long").alias("LAST_ACCESS_TIME"), F.lit("integration_owner").alias("OWNER"),
        F.lit(0).cast("long").alias("RETENTION"), (F.col("i") + 1000).alias("SD_ID"), name.alias("TBL_NAME"),
        F.lit("MANAGED_TABLE").alias("TBL_TYPE"), F.lit(None).cast("string").alias("VIEW_EXPANDED_TEXT"),
        F.lit(None).cast("string").alias("VIEW_ORIGINAL_TEXT"), F.lit(False).alias("IS_REWRITE_ENABLED"))
    location = F.concat(F.lit("file:///tmp/hive/warehouse/"), name)
    bulk_sds = i.select(
        (F.col("i") + 1000).alias("SD_ID"), (F.col("i") + 2000).alias("CD_ID"), F.lit(tf).alias("INPUT_FORMAT"),
        F.lit(False).alias("IS_COMPRESSED"),
        F.when(is42, F.concat(location, F.lit("_updated"))).otherwise(location).alias("LOCATION"),
        F.lit(0).cast("long").alias("NUM_BUCKETS"), F.lit(to).alias("OUTPUT_FORMAT"),
        (F.col("i") + 1000).alias("SERDE_ID"), F.lit(False).alias("STORED_AS_SUB_DIRECTORIES"))
    cd = (F.col("i") + 2000).alias("CD_ID")
    bulk_columns = i.select(cd, F.concat(F.lit("Initial id column "), n).alias("COMMENT"), F.lit("id").alias("COLUMN_NAME"),
                            F.lit("bigint").alias("TYPE_NAME"), F.lit(0).alias("INTEGER_IDX")).unionByName(
        i.select(cd, F.when(is42, F.lit("Updated value column 042"))
                 .otherwise(F.concat(F.lit("Initial value column "), n)).alias("COMMENT"),
                 F.lit("value").alias("COLUMN_NAME"), F.lit("string").alias("TYPE_NAME"), F.lit(1).alias("INTEGER_IDX")))
    tid = (F.col("i") + 1000).alias("TBL_ID")
    bulk_params = i.select(tid, F.lit("comment").alias("PARAM_KEY"),
                           F.when(is42, F.lit("Updated integration table 042 comment"))
                           .otherwise(F.concat(F.lit("Initial integration table "), n)).alias("PARAM_VALUE")).unionByName(
        i.select(tid, F.lit("classification").alias("PARAM_KEY"), F.lit("integration_bulk").alias("PARAM_VALUE")))

    def cast(df: DataFrame, table: str) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in METASTORE_SCHEMAS[table].fields])

    return {
        "DBS": dbs, "TBLS": tbls.unionByName(cast(bulk_tbls, "TBLS")), "SDS": sds.unionByName(cast(bulk_sds, "SDS")),
        "COLUMNS_V2": columns.unionByName(cast(bulk_columns, "COLUMNS_V2")), "PARTITION_KEYS": partition_keys,
        "TABLE_PARAMS": params.unionByName(cast(bulk_params, "TABLE_PARAMS")),
    }
