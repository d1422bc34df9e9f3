"""Classification of Hive type names into schema field attributes.

All matches are case-insensitive *prefix* matches, first rule wins, so
``interval_day`` counts as a number (it starts with ``int``) and
``datetime`` as a date.  Everything is built from ``startswith`` so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type-class names and prefix rules of the record format.
SCHEMA_TYPE_PREFIX = "com.linkedin.pegasus2avro.schema."
TYPE_CLASS_RULES = (
    (("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"), "NumberType"),
    (("boolean",), "BooleanType"),
    (("binary",), "BytesType"),
    (("date",), "DateType"),
    (("timestamp",), "TimeType"),
)
DEFAULT_TYPE_CLASS = "StringType"
FIELD_PATH_RULES = (
    (("bigint",), "long"),
    (("tinyint", "smallint", "int", "date"), "int"),
    (("float", "double"), "double"),
    (("decimal", "binary"), "bytes"),
    (("boolean",), "boolean"),
)
DEFAULT_FIELD_PATH_TYPE = "string"
DECIMAL_PATTERN = r"^decimal\((\d+),(\d+)\)"


def _starts_with_any(lowered: Column, prefixes: tuple[str, ...]) -> Column:
    cond = None
    for prefix in prefixes:
        term = lowered.startswith(prefix)
        cond = term if cond is None else (cond | term)
    return cond


def _first_match(lowered: Column, rules, default: str) -> Column:
    expr = None
    for prefixes, value in rules:
        cond = _starts_with_any(lowered, prefixes)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def type_class(native_type: Column) -> Column:
    """Short class name, e.g. ``NumberType``."""
    return _type_class(F.lower(native_type))


def _type_class(lowered: Column) -> Column:
    return _first_match(lowered, TYPE_CLASS_RULES, DEFAULT_TYPE_CLASS)


def schema_type(class_name: Column) -> Column:
    """``{"type": {"<package>.<Class>": {}}}`` as a struct column."""
    empty = F.create_map().cast("map<string,string>")
    return F.struct(F.create_map(F.concat(F.lit(SCHEMA_TYPE_PREFIX), class_name), empty).alias("type"))


def json_props(native_type: Column) -> Column:
    """Logical-type document for ``decimal(p,s)`` and dates, else null."""
    return _json_props(F.lower(native_type))


def _json_props(lowered: Column) -> Column:
    precision = F.regexp_extract(lowered, DECIMAL_PATTERN, 1)
    scale = F.regexp_extract(lowered, DECIMAL_PATTERN, 2)
    return (
        F.when(
            lowered.rlike(DECIMAL_PATTERN),
            F.concat(F.lit('{"logicalType": "decimal", "precision": '), precision,
                     F.lit(', "scale": '), scale, F.lit("}")),
        )
        .when(lowered.startswith("date"), F.lit('{"logicalType": "date"}'))
    )


def field_path_type(native_type: Column) -> Column:
    return _first_match(F.lower(native_type), FIELD_PATH_RULES, DEFAULT_FIELD_PATH_TYPE)


def field_path(name: Column, native_type: Column) -> Column:
    """Version-2 field path ``[version=2.0].[type=<avro>].<name>``."""
    return _field_path(name, field_path_type(native_type))


def _field_path(name: Column, avro_type: Column) -> Column:
    return F.concat(F.lit("[version=2.0].[type="), avro_type, F.lit("]."), name)


def classified(name: Column, lowered: Column) -> list[Column]:
    """``PATH``, ``CLASS`` and ``PROPS``: what a schema field derives from its name and its type in lower case."""
    avro_type = _first_match(lowered, FIELD_PATH_RULES, DEFAULT_FIELD_PATH_TYPE)
    return [_field_path(name, avro_type).alias("PATH"), _type_class(lowered).alias("CLASS"), _json_props(lowered).alias("PROPS")]


def schema_field(native_type: Column, description: Column, is_partition: Column,
                 path: Column, class_name: Column, props: Column) -> Column:
    """One entry of ``schemaMetadata.fields`` of what :func:`classified` found; null members vanish in ``to_json``."""
    return F.struct(
        path.alias("fieldPath"),
        native_type.alias("nativeDataType"),
        schema_type(class_name).alias("type"),
        F.coalesce(description, F.lit("")).alias("description"),
        F.lit(True).alias("nullable"),
        F.lit(False).alias("recursive"),
        F.lit(False).alias("isPartOfKey"),
        F.when(is_partition, F.lit(True)).alias("isPartitioningKey"),
        props.alias("jsonProps"),
    )
