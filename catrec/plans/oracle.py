"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL re-derives the metastore relations from the test tables (same
rules as :mod:`catrec.plans.adapter`) and rebuilds every output with plain
SQL: JSON documents are assembled with ``concat_ws`` / ``string_agg ...
ORDER BY`` (DuckDB's ``to_json`` keeps nulls, Spark's drops null members),
so the text is compared byte for byte with Spark's ``to_json`` output.
"""

from __future__ import annotations

import hashlib
import json
import re
from string import Template

from catrec.functions.fields import SCHEMA_TYPE_PREFIX
from catrec.options import CatalogueOptions


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _type_case(column: str) -> str:
    return (
        f"CASE {column} % 12 WHEN 0 THEN 'bigint' WHEN 1 THEN 'decimal(10,2)' WHEN 2 THEN 'decimal' "
        "WHEN 3 THEN 'DATE' WHEN 4 THEN 'timestamp' WHEN 5 THEN 'boolean' WHEN 6 THEN 'binary' "
        "WHEN 7 THEN 'array<int>' WHEN 8 THEN 'double' WHEN 9 THEN 'varchar(20)' WHEN 10 THEN 'smallint' "
        "ELSE 'map<string,int>' END"
    )


def adapter_ctes(revision: int = 0) -> str:
    """The metastore relations derived from the test tables (see adapter.py)."""
    updated = revision >= 1
    db_name = "CASE WHEN n_name = 'NATION_0' THEN 'hive_metastore' ELSE n_name END" if updated else "n_name"
    table_name = "concat('t', CAST(o_orderkey AS VARCHAR))"
    orders_now = "orders"
    if updated:
        table_name = (f"CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' "
                      f"THEN {table_name} || '_v2' ELSE {table_name} END")
        orders_now = "(SELECT * FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P'))"
    archive = ("WHEN o_orderstatus = 'F' THEN concat('s3://archive/t', CAST(o_orderkey AS VARCHAR)) "
               if updated else "")
    tax = "0.06" if updated else "0.04"
    signup = "WHEN event_type = 'signup' THEN props || ' (updated)' " if updated else ""
    return f"""
DBS AS (SELECT CAST(n_nationkey AS BIGINT) AS DB_ID, {db_name} AS NAME FROM nation),
TBLS AS (
  SELECT o_orderkey AS TBL_ID, CAST(c_nationkey AS BIGINT) AS DB_ID,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS SD_ID,
    {table_name} AS TBL_NAME,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'EXTERNAL_TABLE' WHEN '2-HIGH' THEN 'VIRTUAL_VIEW'
      WHEN '3-MEDIUM' THEN 'MATERIALIZED_VIEW' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'MANAGED_TABLE' END AS TBL_TYPE,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS CREATE_TIME,
    CASE WHEN o_orderstatus = 'F' THEN concat('select ', CAST(o_custkey AS VARCHAR)) END AS VIEW_EXPANDED_TEXT,
    CASE WHEN o_orderstatus <> 'O' THEN 'select 1' END AS VIEW_ORIGINAL_TEXT
  FROM {orders_now} o JOIN customer ON o_custkey = c_custkey),
SDS AS (
  SELECT o_orderkey AS SD_ID, o_orderkey AS CD_ID,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL {archive}ELSE concat('s3://b/t', CAST(o_orderkey AS VARCHAR)) END AS LOCATION
  FROM orders),
COLUMNS_V2 AS (
  SELECT l_orderkey AS CD_ID,
    concat('c', CAST(l_linenumber AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '_', CAST(l_suppkey AS VARCHAR)) AS COLUMN_NAME,
    {_type_case('l_suppkey')} AS TYPE_NAME, l_linenumber AS INTEGER_IDX,
    CASE WHEN l_tax > {tax} THEN NULL ELSE l_linestatus END AS COMMENT
  FROM lineitem WHERE l_returnflag <> 'R'),
PARTITION_KEYS AS (
  SELECT l_orderkey AS TBL_ID,
    concat('p', CAST(l_linenumber AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '_', CAST(l_suppkey AS VARCHAR)) AS PKEY_NAME,
    {_type_case('l_suppkey')} AS PKEY_TYPE, l_linenumber AS INTEGER_IDX, l_linestatus AS PKEY_COMMENT
  FROM lineitem WHERE l_returnflag = 'R'),
TABLE_PARAMS AS (
  SELECT user_id AS TBL_ID,
    CASE event_type WHEN 'signup' THEN 'comment' WHEN 'error' THEN 'table_type' ELSE event_type END AS PARAM_KEY,
    CASE WHEN event_id % 11 = 0 THEN NULL {signup}ELSE props END AS PARAM_VALUE
  FROM events)"""


ADAPTER_CTES = adapter_ctes(0)


def _number_rule(t: str) -> str:
    return f"regexp_matches(lower({t}), '^(tinyint|smallint|int|bigint|float|double|decimal)')"


def type_class_sql(t: str) -> str:
    return (
        f"CASE WHEN {_number_rule(t)} THEN 'NumberType' "
        f"WHEN starts_with(lower({t}), 'boolean') THEN 'BooleanType' "
        f"WHEN starts_with(lower({t}), 'binary') THEN 'BytesType' "
        f"WHEN starts_with(lower({t}), 'date') THEN 'DateType' "
        f"WHEN starts_with(lower({t}), 'timestamp') THEN 'TimeType' ELSE 'StringType' END"
    )


def avro_type_sql(t: str) -> str:
    return (
        f"CASE WHEN starts_with(lower({t}), 'bigint') THEN 'long' "
        f"WHEN regexp_matches(lower({t}), '^(tinyint|smallint|int|date)') THEN 'int' "
        f"WHEN regexp_matches(lower({t}), '^(float|double)') THEN 'double' "
        f"WHEN regexp_matches(lower({t}), '^(decimal|binary)') THEN 'bytes' "
        f"WHEN starts_with(lower({t}), 'boolean') THEN 'boolean' ELSE 'string' END"
    )


def json_props_sql(t: str) -> str:
    pattern = r"'^decimal\((\d+),(\d+)\)'"
    return (
        f"CASE WHEN regexp_matches(lower({t}), {pattern}) THEN "
        f"'{{\"logicalType\": \"decimal\", \"precision\": ' || regexp_extract(lower({t}), {pattern}, 1) "
        f"|| ', \"scale\": ' || regexp_extract(lower({t}), {pattern}, 2) || '}}' "
        f"WHEN starts_with(lower({t}), 'date') THEN '{{\"logicalType\": \"date\"}}' END"
    )


def field_path_sql(name: str, t: str) -> str:
    return f"'[version=2.0].[type=' || {avro_type_sql(t)} || '].' || {name}"


def _guid(o: CatalogueOptions) -> str:
    doc = {"database": o.metastore_name, "instance": o.instance_key, "platform": o.platform}
    return json.dumps(doc, separators=(",", ":"), ensure_ascii=False)


def root_urn_value(o: CatalogueOptions) -> str:
    return "urn:li:container:" + hashlib.md5(_guid(o).encode("utf-8")).hexdigest()


def _sql_params(o: CatalogueOptions) -> dict[str, str]:
    root = root_urn_value(o)
    inst_urn = o.platform_instance_urn
    path_inst = f'{{"id":{json.dumps(inst_urn)},"urn":{json.dumps(inst_urn)}}}' if inst_urn else None
    path_root = f'{{"id":{json.dumps(root)},"urn":{json.dumps(root)}}}'
    dpi = {"platform": o.platform_urn}
    if inst_urn:
        dpi["instance"] = inst_urn
    cp = [("platform", o.platform)]
    if o.platform_instance:
        cp.append(("instance", o.platform_instance))
    cp += [("env", o.env_upper), ("database", o.metastore_name)]
    cp_text = ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in cp)
    guid_prefix = _guid(o)[:-1] + ',"schema":'
    return {
        "pattern": _q(o.database_pattern),
        "tz": _q(o.source_timezone),
        "root": _q(root),
        "root_json": _q(json.dumps(root)),
        "guid_prefix": _q(guid_prefix),
        "guid_plain": _q(_guid(o)),
        "urn_prefix": _q(f"urn:li:dataset:({o.platform_urn}," + (f"{o.platform_instance}." if o.platform_instance else "")),
        "urn_suffix": _q(f",{o.env_upper})"),
        "platform_urn_json": _q(json.dumps(o.platform_urn)),
        "dpi": _q(json.dumps(dpi, separators=(",", ":"))),
        "root_path": _q('{"path":[' + (path_inst or "") + "]}"),
        "schema_path": _q('{"path":[' + ",".join(p for p in (path_inst, path_root) if p) + "]}"),
        "dataset_path_prefix": _q('{"path":[' + ",".join(p for p in (path_inst, path_root) if p) + ","),
        "cp_prefix": _q('{"customProperties":{' + cp_text),
        "env_json": _q(json.dumps(o.env_upper)),
        "metastore_json": _q(json.dumps(o.metastore_name)),
        "with_instance": "TRUE" if o.platform_instance else "FALSE",
        "type_prefix": _q(SCHEMA_TYPE_PREFIX),
    }


# Relations derived from the adapter, in the order the transform builds them.
_CATALOGUE_CTES = Template("""
X_DBS AS (SELECT DB_ID, NAME FROM DBS WHERE regexp_matches(NAME, $pattern)),
BASE AS (
  SELECT t.TBL_ID, t.DB_ID, t.SD_ID, t.TBL_NAME, t.TBL_TYPE, t.CREATE_TIME, t.VIEW_EXPANDED_TEXT,
    t.VIEW_ORIGINAL_TEXT, d.NAME, s.CD_ID, s.LOCATION,
    concat_ws('.', d.NAME, t.TBL_NAME) AS DATASET_NAME,
    $urn_prefix || concat_ws('.', d.NAME, t.TBL_NAME) || $urn_suffix AS URN,
    'urn:li:container:' || md5(CASE WHEN d.NAME IS NULL THEN $guid_plain
                               ELSE $guid_prefix || to_json(d.NAME) || '}' END) AS CONTAINER_URN
  FROM TBLS t JOIN X_DBS d ON t.DB_ID = d.DB_ID LEFT JOIN SDS s ON t.SD_ID = s.SD_ID),
FIELD_ROWS AS (
  SELECT b.TBL_ID, c.INTEGER_IDX AS POS, c.COLUMN_NAME AS FIELD_NAME, c.TYPE_NAME AS NATIVE_TYPE,
    c.COMMENT AS DESCRIPTION, FALSE AS IS_PARTITION
  FROM BASE b JOIN COLUMNS_V2 c ON b.CD_ID = c.CD_ID WHERE c.COLUMN_NAME IS NOT NULL
  UNION ALL
  SELECT p.TBL_ID, p.INTEGER_IDX + 1000000, p.PKEY_NAME, p.PKEY_TYPE, p.PKEY_COMMENT, TRUE
  FROM PARTITION_KEYS p WHERE p.PKEY_NAME IS NOT NULL AND p.TBL_ID IN (SELECT TBL_ID FROM BASE)),
FIELD_JSON AS (
  SELECT TBL_ID, POS, FIELD_NAME, NATIVE_TYPE, DESCRIPTION, IS_PARTITION,
    FIELD_PATH_EXPR AS FIELD_PATH,
    '{' || concat_ws(',',
      '"fieldPath":' || to_json(FIELD_PATH_EXPR),
      '"nativeDataType":' || to_json(NATIVE_TYPE),
      '"type":{"type":{' || to_json($type_prefix || TYPE_CLASS_EXPR) || ':{}}}',
      '"description":' || to_json(coalesce(DESCRIPTION, '')),
      '"nullable":true', '"recursive":false', '"isPartOfKey":false',
      CASE WHEN IS_PARTITION THEN '"isPartitioningKey":true' END,
      '"jsonProps":' || to_json(JSON_PROPS_EXPR)) || '}' AS FIELD_DOC
  FROM FIELD_ROWS),
FIELDS AS (
  SELECT TBL_ID, string_agg(FIELD_DOC, ',' ORDER BY POS ASC NULLS FIRST, FIELD_NAME ASC NULLS FIRST,
      NATIVE_TYPE ASC NULLS FIRST, DESCRIPTION ASC NULLS FIRST, IS_PARTITION ASC NULLS FIRST) AS FIELDS_DOC
  FROM FIELD_JSON GROUP BY TBL_ID),
PARAM_DEDUP AS (
  SELECT TBL_ID, PARAM_KEY, max(PARAM_VALUE) AS PARAM_VALUE FROM TABLE_PARAMS
  WHERE PARAM_KEY IS NOT NULL AND PARAM_VALUE IS NOT NULL GROUP BY TBL_ID, PARAM_KEY),
PARAMS AS (
  SELECT TBL_ID,
    max(CASE WHEN PARAM_KEY = 'comment' THEN PARAM_VALUE END) AS COMMENT_PARAM,
    string_agg(CASE WHEN PARAM_KEY NOT IN ('table_type', 'table_location', 'create_date', 'partitioned_columns')
               THEN to_json(PARAM_KEY) || ':' || to_json(PARAM_VALUE) END, ',' ORDER BY PARAM_KEY) AS PARAMS_DOC
  FROM PARAM_DEDUP GROUP BY TBL_ID),
PARTS AS (
  SELECT TBL_ID, coalesce(string_agg(PKEY_NAME, ',' ORDER BY PKEY_NAME), '') AS PARTITIONED_COLUMNS
  FROM PARTITION_KEYS GROUP BY TBL_ID),
ENRICHED AS (
  SELECT b.*, f.FIELDS_DOC, p.COMMENT_PARAM, p.PARAMS_DOC, k.PARTITIONED_COLUMNS,
    b.TBL_TYPE IN ('VIRTUAL_VIEW', 'MATERIALIZED_VIEW') AS IS_VIEW,
    strftime(to_timestamp(b.CREATE_TIME) AT TIME ZONE $tz, '%Y-%m-%d') AS CREATE_DATE
  FROM BASE b LEFT JOIN FIELDS f ON b.TBL_ID = f.TBL_ID LEFT JOIN PARAMS p ON b.TBL_ID = p.TBL_ID
  LEFT JOIN PARTS k ON b.TBL_ID = k.TBL_ID),
CUSTOM AS (
  SELECT e.*,
    CASE WHEN IS_VIEW THEN '{"is_view":"True"}' ELSE '{' || concat_ws(',', PARAMS_DOC,
      '"table_type":' || to_json(coalesce(TBL_TYPE, '')),
      '"table_location":' || to_json(coalesce(LOCATION, '')),
      '"create_date":' || coalesce(to_json(CREATE_DATE), 'null'),
      CASE WHEN PARTITIONED_COLUMNS IS NOT NULL THEN '"partitioned_columns":' || to_json(PARTITIONED_COLUMNS) END) || '}'
    END AS CUSTOM_DOC
  FROM ENRICHED e),
ROOT_EVENTS AS (
  SELECT 'container' AS entity_type, $root AS entity_urn, aspect_name, aspect_value, 0 AS src FROM (VALUES
    ('containerProperties', $cp_prefix || '},"name":' || $metastore_json || ',"env":' || $env_json || '}'),
    ('status', '{"removed":false}'),
    ('subTypes', '{"typeNames":["Database"]}'),
    ('dataPlatformInstance', $dpi),
    ('browsePathsV2', $root_path)) AS v(aspect_name, aspect_value)),
SCHEMA_URNS AS (
  SELECT NAME, 'urn:li:container:' || md5(CASE WHEN NAME IS NULL THEN $guid_plain
                                          ELSE $guid_prefix || to_json(NAME) || '}' END) AS URN
  FROM X_DBS),
SCHEMA_EVENTS AS (
  SELECT 'container' AS entity_type, URN AS entity_urn, aspect_name, aspect_value, 1 AS src FROM (
    SELECT URN, 'container' AS aspect_name, '{"container":' || $root_json || '}' AS aspect_value FROM SCHEMA_URNS
    UNION ALL SELECT URN, 'containerProperties', $cp_prefix || ',"schema":' || coalesce(to_json(NAME), 'null') || '}'
      || coalesce(',"name":' || to_json(NAME), '') || ',"env":' || $env_json || '}' FROM SCHEMA_URNS
    UNION ALL SELECT URN, 'status', '{"removed":false}' FROM SCHEMA_URNS
    UNION ALL SELECT URN, 'subTypes', '{"typeNames":["Schema"]}' FROM SCHEMA_URNS
    UNION ALL SELECT URN, 'dataPlatformInstance', $dpi FROM SCHEMA_URNS
    UNION ALL SELECT URN, 'browsePathsV2', $schema_path FROM SCHEMA_URNS)),
DATASET_EVENTS AS (
  SELECT 'dataset' AS entity_type, URN AS entity_urn, aspect_name, aspect_value, 2 AS src FROM (
    SELECT URN, 'datasetProperties' AS aspect_name,
      '{' || concat_ws(',', '"name":' || to_json(TBL_NAME),
        CASE WHEN NOT IS_VIEW THEN '"description":' || to_json(COMMENT_PARAM) END,
        '"customProperties":' || CUSTOM_DOC, '"tags":[]') || '}' AS aspect_value FROM CUSTOM
    UNION ALL SELECT URN, 'schemaMetadata',
      '{"schemaName":' || to_json(DATASET_NAME) || ',"platform":' || $platform_urn_json
      || ',"version":0,"created":{"time":0,"actor":"urn:li:corpuser:unknown"},'
      || '"lastModified":{"time":0,"actor":"urn:li:corpuser:unknown"},"hash":"",'
      || '"platformSchema":{"com.linkedin.pegasus2avro.schema.MySqlDDL":{"tableSchema":""}},'
      || '"fields":[' || coalesce(FIELDS_DOC, '') || ']}' FROM ENRICHED
    UNION ALL SELECT URN, 'status', '{"removed":false}' FROM ENRICHED
    UNION ALL SELECT URN, 'container', '{"container":' || to_json(CONTAINER_URN) || '}' FROM ENRICHED
    UNION ALL SELECT URN, 'browsePathsV2', $dataset_path_prefix || '{"id":' || to_json(CONTAINER_URN)
      || ',"urn":' || to_json(CONTAINER_URN) || '}]}' FROM ENRICHED
    UNION ALL SELECT URN, 'subTypes', CASE WHEN IS_VIEW THEN '{"typeNames":["View"]}'
      ELSE '{"typeNames":["Table"]}' END FROM ENRICHED
    UNION ALL SELECT URN, 'dataPlatformInstance', $dpi FROM ENRICHED WHERE $with_instance)),
VIEW_EVENTS AS (
  SELECT 'dataset' AS entity_type, URN AS entity_urn, 'viewProperties' AS aspect_name,
    '{"materialized":' || CASE WHEN TBL_TYPE = 'MATERIALIZED_VIEW' THEN 'true' ELSE 'false' END
    || ',"viewLanguage":"SQL","viewLogic":'
    || to_json(coalesce(VIEW_EXPANDED_TEXT, VIEW_ORIGINAL_TEXT, '')) || '}' AS aspect_value, 2 AS src
  FROM ENRICHED WHERE IS_VIEW),
ALL_EVENTS AS (
  SELECT * FROM ROOT_EVENTS UNION ALL SELECT * FROM SCHEMA_EVENTS
  UNION ALL SELECT * FROM DATASET_EVENTS UNION ALL SELECT * FROM VIEW_EVENTS)""")


def catalogue_ctes(o: CatalogueOptions) -> str:
    body = _CATALOGUE_CTES.substitute(_sql_params(o))
    body = body.replace("FIELD_PATH_EXPR", f"({field_path_sql('FIELD_NAME', 'NATIVE_TYPE')})")
    body = body.replace("TYPE_CLASS_EXPR", f"({type_class_sql('NATIVE_TYPE')})")
    body = body.replace("JSON_PROPS_EXPR", f"({json_props_sql('NATIVE_TYPE')})")
    return body


_CTE_NAMES = (
    "DBS", "TBLS", "SDS", "COLUMNS_V2", "PARTITION_KEYS", "TABLE_PARAMS", "X_DBS", "BASE", "FIELD_ROWS",
    "FIELD_JSON", "FIELDS", "PARAM_DEDUP", "PARAMS", "PARTS", "ENRICHED", "CUSTOM", "ROOT_EVENTS",
    "SCHEMA_URNS", "SCHEMA_EVENTS", "DATASET_EVENTS", "VIEW_EVENTS", "ALL_EVENTS",
)
_CTE_PATTERN = re.compile(r"\b(" + "|".join(_CTE_NAMES) + r")\b")


def prefixed(sql: str, prefix: str) -> str:
    """Rename every catalogue CTE (and its references) with ``prefix``."""
    return _CTE_PATTERN.sub(lambda m: prefix + m.group(1), sql) if prefix else sql


def catalogue_block(o: CatalogueOptions, revision: int = 0, prefix: str = "") -> str:
    return prefixed(adapter_ctes(revision) + "," + catalogue_ctes(o), prefix)


def with_catalogue(o: CatalogueOptions, select: str) -> str:
    return "WITH " + catalogue_block(o) + "\n" + select


def with_adapter(select: str) -> str:
    return "WITH " + ADAPTER_CTES + "\n" + select


def _event_select(source: str) -> str:
    return f"SELECT entity_type, entity_urn, aspect_name, aspect_value FROM {source}"


def oracle_queries() -> dict[str, str]:
    from catrec.plans.registry import FILTER_OPTIONS, QUERY_OPTIONS

    o = QUERY_OPTIONS
    cat = lambda select: with_catalogue(o, select)
    encoded_prefix = f"urn:li:dataset:({o.platform_urn},"
    return {
        "database_filter": with_adapter(
            f"SELECT DB_ID AS db_id, NAME AS name FROM DBS WHERE regexp_matches(NAME, {_q(FILTER_OPTIONS.database_pattern)})"),
        "duplicate_keys": with_adapter(
            "SELECT TBL_ID AS tbl_id, PARAM_KEY AS param_key, count(*) AS n FROM TABLE_PARAMS "
            "GROUP BY TBL_ID, PARAM_KEY HAVING count(*) > 1"),
        "delimiter_names": cat(
            "SELECT count(*) AS tables, count(*) FILTER (WHERE regexp_matches(DATASET_NAME, '[(),]')) AS offending FROM BASE"),
        "base_tables": cat(
            "SELECT TBL_ID AS tbl_id, NAME AS db_name, TBL_NAME AS tbl_name, TBL_TYPE AS tbl_type, "
            "LOCATION AS location, DATASET_NAME AS dataset_name, URN AS urn, CONTAINER_URN AS container_urn FROM BASE"),
        "field_types": with_adapter(
            "SELECT owner_id, is_partition, field_name, native_type, "
            f"{field_path_sql('field_name', 'native_type')} AS field_path, "
            f"{type_class_sql('native_type')} AS type_class, {json_props_sql('native_type')} AS json_props FROM ("
            "SELECT CD_ID AS owner_id, FALSE AS is_partition, COLUMN_NAME AS field_name, TYPE_NAME AS native_type FROM COLUMNS_V2 "
            "UNION ALL SELECT TBL_ID, TRUE, PKEY_NAME, PKEY_TYPE FROM PARTITION_KEYS) WHERE field_name IS NOT NULL"),
        "ordered_fields": cat(
            "SELECT b.URN AS urn, CAST(row_number() OVER (PARTITION BY f.TBL_ID ORDER BY f.POS ASC NULLS FIRST, "
            "f.FIELD_NAME ASC NULLS FIRST, f.NATIVE_TYPE ASC NULLS FIRST, f.DESCRIPTION ASC NULLS FIRST, "
            "f.IS_PARTITION ASC NULLS FIRST) - 1 AS INTEGER) AS ordinal, f.FIELD_PATH AS field_path, "
            "f.NATIVE_TYPE AS native_type, coalesce(f.DESCRIPTION, '') AS description, "
            "CASE WHEN f.IS_PARTITION THEN TRUE END AS is_partitioning_key, "
            f"{json_props_sql('f.NATIVE_TYPE')} AS json_props "
            "FROM FIELD_JSON f JOIN BASE b ON f.TBL_ID = b.TBL_ID"),
        "param_entries": cat(
            "SELECT TBL_ID AS tbl_id, PARAM_KEY AS param_key, PARAM_VALUE AS param_value FROM PARAM_DEDUP"),
        "partitioned_columns": cat(
            "SELECT TBL_ID AS tbl_id, PARTITIONED_COLUMNS AS partitioned_columns FROM PARTS"),
        "custom_properties": cat(
            "SELECT URN AS urn, 'is_view' AS prop_key, 'True' AS prop_value FROM ENRICHED WHERE IS_VIEW "
            "UNION ALL SELECT e.URN, d.PARAM_KEY, d.PARAM_VALUE FROM ENRICHED e JOIN PARAM_DEDUP d ON e.TBL_ID = d.TBL_ID "
            "WHERE NOT coalesce(e.IS_VIEW, FALSE) AND d.PARAM_KEY NOT IN ('table_type', 'table_location', 'create_date', 'partitioned_columns') "
            "UNION ALL SELECT URN, 'table_type', coalesce(TBL_TYPE, '') FROM ENRICHED WHERE NOT coalesce(IS_VIEW, FALSE) "
            "UNION ALL SELECT URN, 'table_location', coalesce(LOCATION, '') FROM ENRICHED WHERE NOT coalesce(IS_VIEW, FALSE) "
            "UNION ALL SELECT URN, 'create_date', CREATE_DATE FROM ENRICHED WHERE NOT coalesce(IS_VIEW, FALSE) "
            "UNION ALL SELECT URN, 'partitioned_columns', PARTITIONED_COLUMNS FROM ENRICHED "
            "WHERE NOT coalesce(IS_VIEW, FALSE) AND PARTITIONED_COLUMNS IS NOT NULL"),
        "schema_events": cat(_event_select("SCHEMA_EVENTS")),
        "dataset_events": cat(_event_select("DATASET_EVENTS")),
        "view_events": cat(_event_select("VIEW_EVENTS")),
        "catalogue_events": cat(_event_select("ALL_EVENTS")),
        "aspect_counts": cat(
            "SELECT entity_type, aspect_name, count(*) AS n FROM ALL_EVENTS GROUP BY entity_type, aspect_name"),
        "encoded_urns": (
            f"SELECT c_custkey, {_q(encoded_prefix)} || replace(url_encode("
            f"{_q(o.platform_instance + '.') if o.platform_instance else _q('')} || concat_ws('.', n_name, c_name)), '%2F', '/') "
            f"|| {_q(',' + o.env_upper + ')')} AS urn FROM customer JOIN nation ON c_nationkey = n_nationkey"),
        "normalized_values": (
            "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN '' "
            "ELSE '.' || strftime(ts, '%f') END AS ts, user_id, event_type, value, props, props AS props_bytes FROM events"),
        **oracle_queries_more(),
    }


SUPPORTED_SQL = ("('containerProperties', 'datasetProperties', 'schemaMetadata', 'status', "
                 "'container', 'ownership', 'subTypes', 'viewProperties')")


def _index_ctes(p: str, o: CatalogueOptions, strict: bool = False) -> str:
    """Normalised index of one side (prefix ``p``): entity keyed by container
    name, canonical schema fields, last record (highest source) wins."""
    platform = _q(json.dumps(o.platform_urn))
    return f"""
{p}NAMES AS (
  SELECT entity_urn AS urn, arg_max('container:' || json_extract_string(aspect_value, '$.name'), src) AS name_key
  FROM {p}ALL_EVENTS WHERE aspect_name = 'containerProperties'
    AND coalesce(json_extract_string(aspect_value, '$.name'), '') <> '' GROUP BY entity_urn),
{p}SCHEMA_CANON AS (
  SELECT b.URN, '{{"fields":[' || coalesce(string_agg('{{"description":' || to_json(coalesce(f.DESCRIPTION, ''))
      || ',"fieldPath":' || to_json(f.FIELD_PATH) || ',"nativeDataType":' || to_json(lower(coalesce(f.NATIVE_TYPE, '')))
      || ',"nullable":true}}', ',' ORDER BY f.FIELD_PATH, f.POS ASC NULLS FIRST, f.FIELD_NAME ASC NULLS FIRST,
        f.NATIVE_TYPE ASC NULLS FIRST, f.DESCRIPTION ASC NULLS FIRST, f.IS_PARTITION ASC NULLS FIRST), '')
      || '],"platform":' || {platform}
      || ',"schemaName":' || to_json(b.DATASET_NAME) || '}}' AS canonical
  FROM {p}BASE b LEFT JOIN {p}FIELD_JSON f ON b.TBL_ID = f.TBL_ID GROUP BY b.URN, b.DATASET_NAME),
{p}KEYED AS (
  SELECT coalesce(n.name_key, e.entity_urn) AS entity, e.aspect_name AS aspect, e.src,
    CASE WHEN e.aspect_name = 'container'
           THEN '{{"container":' || to_json(coalesce(r.name_key, json_extract_string(e.aspect_value, '$.container'))) || '}}'
         WHEN e.aspect_name = 'schemaMetadata' THEN s.canonical
         ELSE e.aspect_value END AS canonical
  FROM {p}ALL_EVENTS e
  LEFT JOIN {p}NAMES n ON e.entity_urn = n.urn
  LEFT JOIN {p}NAMES r ON e.aspect_name = 'container' AND json_extract_string(e.aspect_value, '$.container') = r.urn
  LEFT JOIN {p}SCHEMA_CANON s ON e.aspect_name = 'schemaMetadata' AND e.entity_urn = s.URN
  {"" if strict else "WHERE e.aspect_name IN " + SUPPORTED_SQL}),
{p}IDX AS (
  SELECT entity, aspect, arg_max(canonical, src) AS canonical, count(DISTINCT canonical) > 1 AS conflicting
  FROM {p}KEYED GROUP BY entity, aspect)"""


def _exact_index_ctes(p: str) -> str:
    return f"""
{p}IDX AS (
  SELECT entity_urn AS entity, aspect_name AS aspect, arg_max(aspect_value, src) AS canonical,
    count(DISTINCT aspect_value) > 1 AS conflicting
  FROM {p}ALL_EVENTS GROUP BY entity_urn, aspect_name)"""


_PAIRS = """
PAIRS AS (
  SELECT coalesce(b.entity, c.entity) AS entity, coalesce(b.aspect, c.aspect) AS aspect,
    b.canonical AS expected, c.canonical AS actual, b.conflicting AS bc, c.conflicting AS cc
  FROM B_IDX b FULL OUTER JOIN C_IDX c ON b.entity = c.entity AND b.aspect = c.aspect)"""

_SUMMARY = """
SELECT baseline_aspects, candidate_aspects, missing_in_candidate, extra_in_candidate, different_aspects,
  baseline_duplicates, candidate_duplicates,
  (missing_in_candidate + extra_in_candidate + different_aspects + baseline_duplicates + candidate_duplicates) = 0 AS equal
FROM (SELECT count(expected) AS baseline_aspects, count(actual) AS candidate_aspects,
  count(*) FILTER (WHERE expected IS NOT NULL AND actual IS NULL) AS missing_in_candidate,
  count(*) FILTER (WHERE actual IS NOT NULL AND expected IS NULL) AS extra_in_candidate,
  count(*) FILTER (WHERE expected <> actual) AS different_aspects,
  count(*) FILTER (WHERE bc) AS baseline_duplicates, count(*) FILTER (WHERE cc) AS candidate_duplicates
  FROM PAIRS)"""

# Leaves that differ: nodes whose parent is an object on both sides (reached
# through objects only, never through an array) and that are not objects on
# both sides themselves (json_tree walks each document).
_DIFF_CTES = """,
DIFF AS (SELECT entity, aspect, expected, actual FROM PAIRS WHERE expected <> actual),
E AS (SELECT d.entity, d.aspect, t.fullkey, t.path AS parent, t.type, t.value FROM DIFF d, json_tree(d.expected) t),
A AS (SELECT d.entity, d.aspect, t.fullkey, t.path AS parent, t.type, t.value FROM DIFF d, json_tree(d.actual) t),
N AS (
  SELECT coalesce(e.entity, a.entity) AS entity, coalesce(e.aspect, a.aspect) AS aspect,
    coalesce(e.fullkey, a.fullkey) AS fullkey, coalesce(e.parent, a.parent) AS parent,
    e.type AS e_type, a.type AS a_type, e.value AS e_val, a.value AS a_val
  FROM E e FULL OUTER JOIN A a ON e.entity = a.entity AND e.aspect = a.aspect AND e.fullkey = a.fullkey),
OBJ AS (SELECT entity, aspect, fullkey FROM N
        WHERE e_type = 'OBJECT' AND a_type = 'OBJECT' AND NOT contains(fullkey, '['))"""

_DIFF_SELECT = """
SELECT n.entity, n.aspect, CASE WHEN n.fullkey = '$' THEN '$' ELSE substr(n.fullkey, 3) END AS path,
  coalesce(n.e_val, '"<missing>"') AS expected, coalesce(n.a_val, '"<missing>"') AS actual
FROM N n LEFT JOIN OBJ o ON n.entity = o.entity AND n.aspect = o.aspect AND n.parent = o.fullkey
WHERE NOT coalesce(n.e_type = 'OBJECT' AND n.a_type = 'OBJECT', FALSE)
  AND (n.fullkey = '$' OR o.fullkey IS NOT NULL)
  AND (n.e_val IS NULL OR n.a_val IS NULL OR n.e_val <> n.a_val)"""


_LISTINGS = f"""
SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY side NULLS FIRST, entity, aspect, path) AS position, entity, aspect, path
FROM (SELECT 'missing' AS kind, NULL AS side, entity, aspect, NULL AS path FROM PAIRS WHERE actual IS NULL
  UNION ALL SELECT 'extra', NULL, entity, aspect, NULL FROM PAIRS WHERE expected IS NULL
  UNION ALL SELECT 'duplicates', 'baseline', entity, aspect, NULL FROM PAIRS WHERE bc
  UNION ALL SELECT 'duplicates', 'candidate', entity, aspect, NULL FROM PAIRS WHERE cc
  UNION ALL SELECT 'differences', NULL, entity, aspect, path FROM ({_DIFF_SELECT}))"""


def fingerprint_sql(*columns: str) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"CAST('0x' || left(md5({text}), 8) AS BIGINT)"


SNAPSHOT_COLUMNS = {
    "DBS": ("DB_ID", "NAME"),
    "TBLS": ("TBL_ID", "DB_ID", "SD_ID", "TBL_NAME", "TBL_TYPE", "CREATE_TIME", "VIEW_EXPANDED_TEXT", "VIEW_ORIGINAL_TEXT"),
    "SDS": ("SD_ID", "CD_ID", "LOCATION"),
    "COLUMNS_V2": ("CD_ID", "COLUMN_NAME", "TYPE_NAME", "INTEGER_IDX", "COMMENT"),
    "PARTITION_KEYS": ("TBL_ID", "PKEY_NAME", "PKEY_TYPE", "INTEGER_IDX", "PKEY_COMMENT"),
    "TABLE_PARAMS": ("TBL_ID", "PARAM_KEY", "PARAM_VALUE"),
    "DATABASE_PARAMS": ("n_nationkey", "'region'", "n_regionkey"),
    "SERDES": ("s_suppkey", "s_name", "CASE WHEN s_nationkey % 5 <> 0 THEN 'lib ' || CAST(s_nationkey AS VARCHAR) END"),
    "SERDE_PARAMS": ("p_partkey", "p_brand", "p_name"),
}
OTHER_RELATIONS = {"DATABASE_PARAMS": "nation", "SERDES": "supplier", "SERDE_PARAMS": "part"}


def snapshot_sql() -> str:
    """What each relation of a snapshot must hold after the round trip."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS relation, count(*) AS rows, count(*) AS manifest_rows, "
        f"CAST(coalesce(sum({fingerprint_sql(*columns)}), 0) AS BIGINT) AS checksum, "
        f"true AS bounded, true AS files_told FROM {OTHER_RELATIONS.get(name, name)}"
        for name, columns in SNAPSHOT_COLUMNS.items())


def reconcile_sql(o: CatalogueOptions, select: str, exact: bool = False, strict: bool = False) -> str:
    index = (_exact_index_ctes("B_") + "," + _exact_index_ctes("C_")) if exact else (
        _index_ctes("B_", o, strict) + "," + _index_ctes("C_", o, strict))
    return ("WITH " + catalogue_block(o, 0, "B_") + "," + catalogue_block(o, 1, "C_") + "," + index + ","
            + _PAIRS + select)


def record_text_sql() -> str:
    return ("'{\"entityType\":' || to_json(entity_type) || ',\"entityUrn\":' || to_json(entity_urn) "
            "|| ',\"changeType\":\"UPSERT\",\"aspectName\":' || to_json(aspect_name) "
            "|| ',\"aspect\":{\"value\":' || to_json(aspect_value) || ',\"contentType\":\"application/json\"}}'")


def oracle_queries_more() -> dict[str, str]:
    from catrec.plans.registry import QUERY_OPTIONS, SIZING_LIMIT

    o = QUERY_OPTIONS
    cat = lambda select: with_catalogue(o, select)
    return {
        "run_summary": cat(
            "SELECT count(*) FILTER (WHERE aspect_name = 'containerProperties') - 1 AS databases, "
            "count(*) FILTER (WHERE aspect_name = 'datasetProperties') AS tables, count(*) AS mcps FROM ALL_EVENTS"),
        "output_sizing": cat(
            f"SELECT records, total_bytes, greatest(1, CAST(ceil(total_bytes / {SIZING_LIMIT}) AS BIGINT)) AS files FROM ("
            f"SELECT count(*) AS records, CAST(sum(octet_length(encode({record_text_sql()})) + 2) AS BIGINT) AS total_bytes "
            "FROM ALL_EVENTS)"),
        "record_file_layout": cat(
            "SELECT place // {0} AS file_id, count(*) AS records, CAST(sum(size) AS BIGINT) AS bytes FROM ("
            "SELECT size, CAST(sum(size) OVER (ORDER BY left(md5(value), 4), entity_urn, aspect_name, value "
            "ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS place FROM ("
            "SELECT *, octet_length(encode(value)) + 2 AS size FROM (SELECT entity_urn, aspect_name, {1} AS value FROM ALL_EVENTS))) "
            "GROUP BY file_id".format(SIZING_LIMIT, record_text_sql())),
        "record_round_trip": cat(
            "SELECT layout, entity_type, aspect_name, count(*) AS records, "
            "CAST(sum(octet_length(encode(aspect_value))) AS BIGINT) AS aspect_bytes, "
            f"CAST(sum({fingerprint_sql('entity_urn', 'aspect_value')}) AS BIGINT) AS checksum "
            "FROM ALL_EVENTS, (VALUES ('array'), ('lines'), ('spread')) l(layout) GROUP BY layout, entity_type, aspect_name"),
        "snapshot_round_trip": with_adapter(snapshot_sql()),
        "flatten_records": cat(
            "SELECT entity_type, entity_urn AS urn, aspect_name, aspect_value AS aspect FROM ALL_EVENTS"),
        "reconcile_summary": reconcile_sql(o, _SUMMARY),
        "reconcile_missing": reconcile_sql(o, "\nSELECT entity, aspect FROM PAIRS WHERE actual IS NULL"),
        "reconcile_extra": reconcile_sql(o, "\nSELECT entity, aspect FROM PAIRS WHERE expected IS NULL"),
        "reconcile_differences": reconcile_sql(o, _DIFF_CTES + _DIFF_SELECT),
        "report_rows": reconcile_sql(o, _DIFF_CTES + _LISTINGS),
        "reconcile_duplicates": reconcile_sql(
            o, "\nSELECT 'baseline' AS side, entity, aspect FROM PAIRS WHERE bc "
               "UNION ALL SELECT 'candidate' AS side, entity, aspect FROM PAIRS WHERE cc"),
        "reconcile_exact_summary": reconcile_sql(o, _SUMMARY, exact=True),
        "reconcile_strict_summary": reconcile_sql(o, _SUMMARY, strict=True),
    }
