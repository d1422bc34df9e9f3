"""Scalar conversions: epoch to local date, and JSON-safe value normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_to_local_date(epoch_seconds: Column, timezone: str) -> Column:
    """``yyyy-MM-dd`` of an epoch-seconds instant as seen in ``timezone``.

    Works on TIMESTAMP_NTZ values, so the result does not depend on the
    session time zone (nothing is read from or written to the session conf).
    """
    utc_wall = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), epoch_seconds.cast("decimal(18,6)")
    )
    local_wall = F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc_wall)
    return F.date_format(local_wall, "yyyy-MM-dd")


def _iso_timestamp(ts: Column) -> Column:
    # Python's isoformat(): seconds always, microseconds only when non-zero.
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None).cast("string")).when(
        micros == F.lit("000000"), base
    ).otherwise(F.concat(base, F.lit("."), micros))


def normalize_value(column: Column, dtype: T.DataType) -> Column:
    """Value as it is dumped into a snapshot row.

    null/boolean/number/string pass through; bytes become UTF-8 text with
    U+FFFD for invalid sequences; dates and timestamps become ISO strings;
    anything else (decimals, intervals, ...) becomes its string form.
    """
    if isinstance(dtype, (T.BooleanType, T.StringType, T.ByteType, T.ShortType, T.IntegerType,
                          T.LongType, T.FloatType, T.DoubleType, T.NullType)):
        return column
    if isinstance(dtype, T.BinaryType):
        return F.make_valid_utf8(column.cast("string"))
    if isinstance(dtype, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(dtype, T.TimestampNTZType):
        return _iso_timestamp(column)
    if isinstance(dtype, T.TimestampType):
        # An instant is rendered as the wall clock the JDBC source read it as,
        # i.e. in the session time zone, without an offset suffix.
        return _iso_timestamp(column)
    return column.cast("string")


def normalize_row_values(df: DataFrame) -> DataFrame:
    """Apply :func:`normalize_value` to every column, keeping names and order."""
    return df.select(*[normalize_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
