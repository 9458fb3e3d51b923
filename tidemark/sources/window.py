"""Incremental snapshot: the rows inside one watermark window."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import typed

LAG_MINUTES = 5  # keeps rows of still open source transactions out of the window


def window_bounds(
    as_of: datetime,
    last_loaded_at: str | datetime | None,
    lag_minutes: int = LAG_MINUTES,
    lookback_minutes: int = 0,
) -> tuple[str | None, str]:
    """``(lo, hi]`` of one run, as wall-clock text.

    ``lookback_minutes`` re-reads a margin below the stored watermark, for
    day-grain or late watermarks; the keyed merge makes the overlap harmless.
    """
    high = as_of - timedelta(minutes=lag_minutes)
    low = last_loaded_at
    if low is not None and lookback_minutes:
        moment = low if isinstance(low, datetime) else datetime.fromisoformat(low)
        low = moment - timedelta(minutes=lookback_minutes)
    if isinstance(low, datetime):
        low = low.isoformat(sep=" ")
    return low, high.isoformat(sep=" ", timespec="seconds")


def incremental_window(
    df: DataFrame, watermark: str | None, low: str | None, high: str | None
) -> DataFrame:
    """Rows with ``low < watermark <= high``; a missing bound is open.

    The bounds are literals of the column's own type, so both comparisons reach
    the scan.  Rows with a NULL watermark are never inside a window.
    """
    if not watermark:
        return df
    kind = df.schema[watermark].dataType
    if low is not None:
        df = df.where(F.col(watermark) > typed(low, kind))
    if high is not None:
        df = df.where(F.col(watermark) <= typed(high, kind))
    return df
