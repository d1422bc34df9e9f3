import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catrec.functions.fields import field_path, json_props, type_class
from catrec.functions.urns import dataset_urn, encode_identifier, named_container_urn, root_container_urn, schema_container_urn
from catrec.functions.values import epoch_to_local_date
from catrec.options import CatalogueOptions, parse_byte_size


def one(spark, column, value=None, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(("name", "env", "expected"), [
    ("hive.orders", "uat", "urn:li:dataset:(urn:li:dataPlatform:hive,hive.orders,UAT)"),
    ("中文.订单", "prod", "urn:li:dataset:(urn:li:dataPlatform:hive,%E4%B8%AD%E6%96%87.%E8%AE%A2%E5%8D%95,PROD)"),
])
def test_encoded_dataset_urn(spark, name, env, expected):
    assert one(spark, dataset_urn(F.col("v"), CatalogueOptions(env=env), encode=True), name) == expected


@pytest.mark.parametrize(("value", "expected"), [
    ("db,a(b)", "db%2Ca%28b%29"), ("a b", "a%20b"), ("x*y", "x%2Ay"), ("p/q~r", "p/q~r"),
    ("50%", "50%25"), ("'\"", "%27%22"), ("a+b", "a%2Bb"),
])
def test_percent_encoding_matches_quote(spark, value, expected):
    from urllib.parse import quote

    assert quote(value, safe="._-~/") == expected
    assert one(spark, encode_identifier(F.col("v")), value) == expected


def test_all_parts_of_an_encoded_urn_are_escaped(spark):
    o = CatalogueOptions(platform="my hive", env="q,a")
    assert one(spark, dataset_urn(F.col("v"), o, encode=True), "a(b") == (
        "urn:li:dataset:(urn:li:dataPlatform:my%20hive,a%28b,Q%2CA)")


def test_named_container(spark):
    assert one(spark, named_container_urn(F.col("v"), CatalogueOptions(env="uat")), "sales eu") == (
        "urn:li:container:hive.UAT.sales%20eu")


def test_plain_urn_with_instance(spark):
    o = CatalogueOptions(env="uat", platform_instance="hive")
    assert one(spark, dataset_urn(F.col("v"), o), "hive.t") == "urn:li:dataset:(urn:li:dataPlatform:hive,hive.hive.t,UAT)"


def test_container_guids_match_stored_values(spark):
    o = CatalogueOptions(env="UAT", platform_instance="hive", metastore_name="hive_metastore_test")
    assert one(spark, root_container_urn(o)) == "urn:li:container:12aaabe8d9719d7293ed4602bb2018ea"
    assert one(spark, schema_container_urn(F.col("v"), o), "hive") == "urn:li:container:f2d758e87ffe1694cd9563f4e960f1b8"


@pytest.mark.parametrize(("native", "cls", "path", "props"), [
    ("bigint", "NumberType", "long", None),
    ("INT", "NumberType", "int", None),
    ("interval_day", "NumberType", "int", None),
    ("decimal(10,2)", "NumberType", "bytes", '{"logicalType": "decimal", "precision": 10, "scale": 2}'),
    ("decimal(10, 2)", "NumberType", "bytes", None),
    ("decimal", "NumberType", "bytes", None),
    ("date", "DateType", "int", '{"logicalType": "date"}'),
    ("datetime", "DateType", "int", '{"logicalType": "date"}'),
    ("timestamp", "TimeType", "string", None),
    ("boolean", "BooleanType", "boolean", None),
    ("binary", "BytesType", "bytes", None),
    ("double", "NumberType", "double", None),
    ("varchar(20)", "StringType", "string", None),
    ("array<int>", "StringType", "string", None),
    (None, "StringType", "string", None),
])
def test_type_classification(spark, native, cls, path, props):
    df = spark.createDataFrame([(native,)], "t string")
    row = df.select(type_class(F.col("t")).alias("c"), field_path(F.lit("f"), F.col("t")).alias("p"),
                    json_props(F.col("t")).alias("j")).first()
    assert row["c"] == cls
    assert row["p"] == f"[version=2.0].[type={path}].f"
    assert row["j"] == props


@pytest.mark.parametrize(("epoch", "tz", "expected"), [
    (1710000000, "UTC", "2024-03-09"), (1710000000, "Asia/Shanghai", "2024-03-10"),
    (0, "America/New_York", "1969-12-31"), (None, "UTC", None),
])
def test_epoch_to_local_date_ignores_session_zone(spark, epoch, tz, expected):
    previous = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        assert one(spark, epoch_to_local_date(F.col("v"), tz), epoch, "long") == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


@given(st.integers(1, 10**6), st.sampled_from(["", "k", "m", "g"]), st.booleans(), st.booleans(), st.sampled_from(["", " "]))
def test_byte_sizes_are_numbers_of_powers_of_1024(n, unit, upper, with_b, gap):
    text = f"{gap}{n}{gap * bool(unit)}{unit}{'b' * with_b}{gap}"
    assert parse_byte_size(text.upper() if upper else text) == n * 1024 ** ("kmg".find(unit) + 1 if unit else 0)


@given(st.one_of(
    st.from_regex(r"[0-9]+[ac-fh-jln-z]b?", fullmatch=True), st.from_regex(r"[+-][0-9]+[kmg]?", fullmatch=True),
    st.from_regex(r"0+[kmg]?b?", fullmatch=True), st.from_regex(r"[0-9]+[.,][0-9]+[kmg]?", fullmatch=True),
    st.sampled_from([" ", "b", "kb", "m", "1kk", "1 2", "٣k", "1e3"])))
def test_anything_else_is_no_byte_size(text):
    with pytest.raises(ValueError):
        parse_byte_size(text)
