"""Golden run: the reference's stored integration output (746 records over
173 files of about 2 KiB) is reproduced record for record."""

import json
import os

from catrec.plans.transform import transform_snapshot
from catrec.sinks.snapshot import write_snapshot
from tests.fixtures import by_key, load_record_files
from tests.golden import OPTIONS, golden_tables

ROOT = "urn:li:container:12aaabe8d9719d7293ed4602bb2018ea"
SCHEMA = "urn:li:container:f2d758e87ffe1694cd9563f4e960f1b8"
T042 = "urn:li:dataset:(urn:li:dataPlatform:hive,hive.hive.test_table_042,UAT)"

# Record texts as stored in the reference's own output (fixed values).
STORED = [
    '{"entityType":"dataset","entityUrn":"urn:li:dataset:(urn:li:dataPlatform:hive,hive.hive.orders,UAT)","changeType":"UPSERT","aspectName":"datasetProperties","aspect":{"value":"{\\"name\\":\\"orders\\",\\"description\\":\\"Orders from the integration test\\",\\"customProperties\\":{\\"classification\\":\\"gold\\",\\"comment\\":\\"Orders from the integration test\\",\\"table_type\\":\\"EXTERNAL_TABLE\\",\\"table_location\\":\\"file:///tmp/hive/warehouse/orders\\",\\"create_date\\":\\"2024-03-10\\",\\"partitioned_columns\\":\\"dt\\"},\\"tags\\":[]}","contentType":"application/json"}}',
    '{"entityType":"dataset","entityUrn":"urn:li:dataset:(urn:li:dataPlatform:hive,hive.hive.order_view,UAT)","changeType":"UPSERT","aspectName":"datasetProperties","aspect":{"value":"{\\"name\\":\\"order_view\\",\\"customProperties\\":{\\"is_view\\":\\"True\\"},\\"tags\\":[]}","contentType":"application/json"}}',
    '{"entityType":"dataset","entityUrn":"urn:li:dataset:(urn:li:dataPlatform:hive,hive.hive.order_view,UAT)","changeType":"UPSERT","aspectName":"viewProperties","aspect":{"value":"{\\"materialized\\":false,\\"viewLanguage\\":\\"SQL\\",\\"viewLogic\\":\\"SELECT id, amount FROM hive.orders\\"}","contentType":"application/json"}}',
    '{"entityType":"container","entityUrn":"urn:li:container:12aaabe8d9719d7293ed4602bb2018ea","changeType":"UPSERT","aspectName":"containerProperties","aspect":{"value":"{\\"customProperties\\":{\\"platform\\":\\"hive\\",\\"instance\\":\\"hive\\",\\"env\\":\\"UAT\\",\\"database\\":\\"hive_metastore_test\\"},\\"name\\":\\"hive_metastore_test\\",\\"env\\":\\"UAT\\"}","contentType":"application/json"}}',
    '{"entityType":"container","entityUrn":"urn:li:container:f2d758e87ffe1694cd9563f4e960f1b8","changeType":"UPSERT","aspectName":"browsePathsV2","aspect":{"value":"{\\"path\\":[{\\"id\\":\\"urn:li:dataPlatformInstance:(urn:li:dataPlatform:hive,hive)\\",\\"urn\\":\\"urn:li:dataPlatformInstance:(urn:li:dataPlatform:hive,hive)\\"},{\\"id\\":\\"urn:li:container:12aaabe8d9719d7293ed4602bb2018ea\\",\\"urn\\":\\"urn:li:container:12aaabe8d9719d7293ed4602bb2018ea\\"}]}","contentType":"application/json"}}',
    '{"entityType":"dataset","entityUrn":"urn:li:dataset:(urn:li:dataPlatform:hive,hive.hive.orders,UAT)","changeType":"UPSERT","aspectName":"schemaMetadata","aspect":{"value":"{\\"schemaName\\":\\"hive.orders\\",\\"platform\\":\\"urn:li:dataPlatform:hive\\",\\"version\\":0,\\"created\\":{\\"time\\":0,\\"actor\\":\\"urn:li:corpuser:unknown\\"},\\"lastModified\\":{\\"time\\":0,\\"actor\\":\\"urn:li:corpuser:unknown\\"},\\"hash\\":\\"\\",\\"platformSchema\\":{\\"com.linkedin.pegasus2avro.schema.MySqlDDL\\":{\\"tableSchema\\":\\"\\"}},\\"fields\\":[{\\"fieldPath\\":\\"[version=2.0].[type=long].id\\",\\"nativeDataType\\":\\"bigint\\",\\"type\\":{\\"type\\":{\\"com.linkedin.pegasus2avro.schema.NumberType\\":{}}},\\"description\\":\\"Order identifier\\",\\"nullable\\":true,\\"recursive\\":false,\\"isPartOfKey\\":false},{\\"fieldPath\\":\\"[version=2.0].[type=bytes].amount\\",\\"nativeDataType\\":\\"decimal(10,2)\\",\\"type\\":{\\"type\\":{\\"com.linkedin.pegasus2avro.schema.NumberType\\":{}}},\\"description\\":\\"Order amount\\",\\"nullable\\":true,\\"recursive\\":false,\\"isPartOfKey\\":false,\\"jsonProps\\":\\"{\\\\\\"logicalType\\\\\\": \\\\\\"decimal\\\\\\", \\\\\\"precision\\\\\\": 10, \\\\\\"scale\\\\\\": 2}\\"},{\\"fieldPath\\":\\"[version=2.0].[type=int].dt\\",\\"nativeDataType\\":\\"date\\",\\"type\\":{\\"type\\":{\\"com.linkedin.pegasus2avro.schema.DateType\\":{}}},\\"description\\":\\"Partition date\\",\\"nullable\\":true,\\"recursive\\":false,\\"isPartOfKey\\":false,\\"isPartitioningKey\\":true,\\"jsonProps\\":\\"{\\\\\\"logicalType\\\\\\": \\\\\\"date\\\\\\"}\\"}]}","contentType":"application/json"}}',
]
STORED_RECORD_BYTES = 353908 - 4 * 173  # file bytes minus "[\n" and "\n]\n\n" per file


def test_golden_integration_catalogue(spark, scratch):
    root = write_snapshot(spark, golden_tables(spark), scratch, "local-integration", rows_per_file=2)
    manifest = json.load(open(os.path.join(root, "manifest.json")))
    assert {t["table"]: t["rows"] for t in manifest["tables"]} == {
        "DBS": 2, "TBLS": 104, "SDS": 104, "COLUMNS_V2": 207, "PARTITION_KEYS": 1, "TABLE_PARAMS": 204}
    output = os.path.join(scratch, "records")
    summary = transform_snapshot(spark, root, output, OPTIONS, max_file_size="2k")
    assert summary.mcps == 746 and summary.databases == 2 and summary.tables == 104
    assert summary.bytes == STORED_RECORD_BYTES  # byte-identical record texts
    records = load_record_files(output)
    assert len(records) == 746
    texts = {json.dumps(r, separators=(",", ":"), ensure_ascii=False) for r in records}
    for stored in STORED:
        assert stored in texts
    aspects = by_key(records)
    assert (ROOT, "containerProperties") in aspects and (SCHEMA, "containerProperties") in aspects
    props = aspects[(T042, "datasetProperties")]
    assert props["description"] == "Updated integration table 042 comment"
    assert props["customProperties"]["table_location"] == "file:///tmp/hive/warehouse/test_table_042_updated"
    assert props["customProperties"]["create_date"] == "2024-03-11"
    value = next(f for f in aspects[(T042, "schemaMetadata")]["fields"] if f["fieldPath"].endswith(".value"))
    assert value["description"] == "Updated value column 042"
