"""Literals and expressions for wall-clock (zone-less) time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(value: object, data_type: T.DataType) -> Column:
    """A literal of exactly ``data_type``.

    ``F.lit(datetime)`` makes a zoned timestamp; comparing that with a
    TIMESTAMP_NTZ column casts the column and loses scan pushdown.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, (datetime, date)):
        value = value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    return F.lit(value).cast(data_type)


def ntz(value: object) -> Column:
    return typed(value, T.TimestampNTZType())


def second_text(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, fractions cut.

    ``date_format`` would pass a wall-clock time through the session's zone, which
    shifts the hour a clock change skips; the plain cast does not.
    """
    return F.substring(col.cast("string"), 1, 19)


def change_time(df_schema: T.StructType, watermark: str | None, as_of: object) -> Column:
    """Event time of a row: its watermark when that reads as a timestamp, else ``as_of``."""
    if not watermark:
        return ntz(as_of)
    kind = df_schema[watermark].dataType
    if isinstance(kind, T.TimestampNTZType):
        event = F.col(watermark)
    else:
        event = F.col(watermark).cast("string").try_cast("timestamp_ntz")
    return F.coalesce(event, ntz(as_of))
