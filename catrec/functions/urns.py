"""URN builders as Spark ``Column`` expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catrec.options import CatalogueOptions

# Characters that may not appear unescaped inside a tuple URN.
URN_DELIMITER_PATTERN = r"[(),]"


def encode_identifier(value: Column) -> Column:
    """Percent-encode like Python ``quote(v, safe="._-~/")``.

    ``url_encode`` is form encoding (space -> ``+``, ``~`` and ``/`` escaped,
    ``*`` kept); the replacements turn it into RFC 3986 style.  A literal ``+``
    in the input is already ``%2B``, so every remaining ``+`` was a space.
    """
    encoded = F.url_encode(value)
    encoded = F.replace(encoded, F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("%2F"), F.lit("/"))
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))


def dataset_urn(name: Column, o: CatalogueOptions, encode: bool = False) -> Column:
    """``urn:li:dataset:(urn:li:dataPlatform:P,[instance.]name,ENV)``; ``encode`` escapes all three parts."""
    escape = encode_identifier if encode else (lambda part: part)
    qualified = F.concat(F.lit(f"{o.platform_instance}."), name) if o.platform_instance else name
    return F.concat(F.lit("urn:li:dataset:(urn:li:dataPlatform:"), escape(F.lit(o.platform)), F.lit(","),
                    escape(qualified), F.lit(","), escape(F.lit(o.env_upper)), F.lit(")"))


def named_container_urn(database_name: Column, o: CatalogueOptions) -> Column:
    """Container of a database by its readable key instead of a GUID, escaped."""
    return F.concat(F.lit("urn:li:container:"),
                    encode_identifier(F.concat(F.lit(f"{o.platform}.{o.env_upper}."), database_name)))


def _container_guid(o: CatalogueOptions, schema: Column | None) -> Column:
    # Key order of the GUID document is part of the identity: database,
    # instance, platform[, schema].  to_json drops a null schema.
    parts = [
        F.lit(o.metastore_name).alias("database"),
        F.lit(o.instance_key).alias("instance"),
        F.lit(o.platform).alias("platform"),
    ]
    if schema is not None:
        parts.append(schema.alias("schema"))
    return F.concat(F.lit("urn:li:container:"), F.md5(F.to_json(F.struct(*parts))))


def root_container_urn(o: CatalogueOptions) -> Column:
    """Container of the whole metastore; constant-folded by Catalyst."""
    return _container_guid(o, None)


def schema_container_urn(database_name: Column, o: CatalogueOptions) -> Column:
    """Container of one database (a *schema* below the metastore container)."""
    return _container_guid(o, database_name)


def has_urn_delimiter(name: Column) -> Column:
    return name.rlike(URN_DELIMITER_PATTERN)
