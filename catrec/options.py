"""Run options shared by every catalogue operator.

Library code never mutates session configuration; everything that the
transform depends on (environment, platform, time zone, ...) travels in
this frozen dataclass and is folded into the plan as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the record format being produced.
VIEW_TYPES = ("VIRTUAL_VIEW", "MATERIALIZED_VIEW")
RESERVED_PROPERTY_KEYS = ("table_type", "table_location", "create_date", "partitioned_columns")
PARTITION_POSITION_OFFSET = 1000000


@dataclass(frozen=True)
class CatalogueOptions:
    platform: str = "hive"
    env: str = "PROD"
    platform_instance: str | None = None
    metastore_name: str = "hive_metastore"
    database_pattern: str = ".*"
    source_timezone: str = "UTC"

    @property
    def env_upper(self) -> str:
        return self.env.upper()

    @property
    def instance_key(self) -> str:
        """Value of ``instance`` inside the container GUID document."""
        return self.platform_instance or self.env_upper

    @property
    def platform_urn(self) -> str:
        return f"urn:li:dataPlatform:{self.platform}"

    @property
    def platform_instance_urn(self) -> str | None:
        if not self.platform_instance:
            return None
        return f"urn:li:dataPlatformInstance:({self.platform_urn},{self.platform_instance})"


def parse_byte_size(value: str) -> int:
    """Bytes of a whole number with an optional unit k, m or g (powers of 1024), in either case, with or without b."""
    text = value.strip().lower().removesuffix("b")
    power = 1 + "kmg".find(text[-1]) if text else 0
    digits = text[:-1].rstrip() if power else text.rstrip()
    if not (digits.isascii() and digits.isdecimal()):
        raise ValueError(f"invalid byte size: {value!r}")
    size = int(digits) << 10 * power
    if not size:
        raise ValueError("byte size must be positive")
    return size
