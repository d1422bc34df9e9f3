"""Aspect documents and the change-record envelope as ``Column`` builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catrec.options import CatalogueOptions
from catrec.functions.urns import root_container_urn

# Fixed values of the record format.
CHANGE_TYPE = "UPSERT"
CONTENT_TYPE = "application/json"
UNKNOWN_ACTOR = "urn:li:corpuser:unknown"
PLATFORM_SCHEMA_CLASS = "com.linkedin.pegasus2avro.schema.MySqlDDL"


def change_record(entity_type: str, urn: Column, aspect_name: str, aspect: Column) -> Column:
    """Envelope struct; the aspect document is serialised with ``to_json``
    (null struct members are dropped, null map values are kept)."""
    return F.struct(
        F.lit(entity_type).alias("entityType"),
        urn.alias("entityUrn"),
        F.lit(CHANGE_TYPE).alias("changeType"),
        F.lit(aspect_name).alias("aspectName"),
        F.struct(F.to_json(aspect).alias("value"), F.lit(CONTENT_TYPE).alias("contentType")).alias("aspect"),
    )


def status_aspect() -> Column:
    return F.struct(F.lit(False).alias("removed"))


def sub_types_aspect(type_name: Column) -> Column:
    return F.struct(F.array(type_name).alias("typeNames"))


def container_aspect(container: Column) -> Column:
    return F.struct(container.alias("container"))


def data_platform_instance_aspect(o: CatalogueOptions) -> Column:
    members = [F.lit(o.platform_urn).alias("platform")]
    if o.platform_instance:
        members.append(F.lit(o.platform_instance_urn).alias("instance"))
    return F.struct(*members)


def _path_entry(urn: Column) -> Column:
    return F.struct(urn.alias("id"), urn.alias("urn"))


def browse_path_aspect(o: CatalogueOptions, *containers: Column) -> Column:
    """``{"path": [instance?, containers...]}``; root alone has only the instance."""
    entries = [_path_entry(F.lit(o.platform_instance_urn))] if o.platform_instance else []
    entries += [_path_entry(c) for c in containers]
    if not entries:
        return F.struct(F.array().cast("array<struct<id:string,urn:string>>").alias("path"))
    return F.struct(F.array(*entries).alias("path"))


def container_properties_aspect(o: CatalogueOptions, name: Column, schema: Column | None) -> Column:
    entries = [F.lit("platform"), F.lit(o.platform)]
    if o.platform_instance:
        entries += [F.lit("instance"), F.lit(o.platform_instance)]
    entries += [F.lit("env"), F.lit(o.env_upper), F.lit("database"), F.lit(o.metastore_name)]
    if schema is not None:
        entries += [F.lit("schema"), schema]
    return F.struct(
        F.create_map(*entries).alias("customProperties"),
        name.alias("name"),
        F.lit(o.env_upper).alias("env"),
    )


def audit_stamp() -> Column:
    return F.struct(F.lit(0).cast("long").alias("time"), F.lit(UNKNOWN_ACTOR).alias("actor"))


def schema_metadata_aspect(o: CatalogueOptions, schema_name: Column, fields: Column) -> Column:
    return F.struct(
        schema_name.alias("schemaName"),
        F.lit(o.platform_urn).alias("platform"),
        F.lit(0).cast("long").alias("version"),
        audit_stamp().alias("created"),
        audit_stamp().alias("lastModified"),
        F.lit("").alias("hash"),
        F.create_map(F.lit(PLATFORM_SCHEMA_CLASS), F.struct(F.lit("").alias("tableSchema"))).alias("platformSchema"),
        fields.alias("fields"),
    )


def root_urn(o: CatalogueOptions) -> Column:
    return root_container_urn(o)
