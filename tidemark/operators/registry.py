"""Configured tables as data: merging entries and profiling candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY_KEY = ("source_db", "source_table")

# Update-time column names, most preferred first.
WATERMARK_NAMES = ("updated_at", "modified_at", "last_updated")
PARTITION_NUM = 8


def keyed_union(winner: DataFrame, other: DataFrame, keys: Sequence[str] = ENTRY_KEY) -> DataFrame:
    """All rows of ``winner`` plus the rows of ``other`` whose key it lacks."""
    known = winner.select(*keys).distinct()
    return winner.unionByName(other.join(known, list(keys), "left_anti").select(*winner.columns))


def keep_existing(existing: DataFrame, generated: DataFrame) -> DataFrame:
    """Add newly found tables; entries already configured keep their tuning."""
    return keyed_union(existing, generated)


def replace_entries(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Add entries by hand; an entry for the same table is replaced."""
    return keyed_union(added, existing)


def default_watermark(columns: Sequence[str]) -> str | None:
    lower = {c.lower(): c for c in columns}
    return next((lower[name] for name in WATERMARK_NAMES if name in lower), None)


def profile_table(
    df: DataFrame,
    candidates: Sequence[Sequence[str]],
    watermark: str | None = None,
) -> DataFrame:
    """Measure candidate keys and suggest how to load the table; one row per candidate.

    A candidate is a key when its non-NULL values are all different.  Then the
    load is incremental if there is also a watermark column (``watermark``, else
    one with a usual name), otherwise full.  A single integer key is also the
    column to split parallel reads on.
    """
    watermark = watermark or default_watermark(df.columns)
    profiles = [_profile_key(df, list(key), watermark) for key in candidates]
    out = profiles[0]
    for frame in profiles[1:]:
        out = out.unionByName(frame)
    return out


def _profile_key(df: DataFrame, key: list[str], watermark: str | None) -> DataFrame:
    """One candidate: group by it (combined map-side), then aggregate the groups."""
    wm = F.col(f"`{watermark}`") if watermark else F.lit(None).cast("string")
    groups = df.groupBy(*[F.col(f"`{k}`") for k in key]).agg(
        F.count(F.lit(1)).alias("_n"), F.min(wm).alias("_lo"), F.max(wm).alias("_hi")
    )
    any_null: Column = F.lit(False)
    for k in key:
        any_null = any_null | F.col(f"`{k}`").isNull()
    measured = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.min("_lo").cast("string").alias("watermark_min"),
        F.max("_hi").cast("string").alias("watermark_max"),
    )
    is_key = (F.col("distinct_keys") == F.col("row_count")) & (F.col("null_keys") == 0)
    integer = len(key) == 1 and isinstance(
        df.schema[key[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    )
    incremental = is_key & F.lit(watermark is not None)
    split = F.when(is_key, F.lit(key[0])) if integer else F.lit(None).cast("string")
    return measured.select(
        F.lit(",".join(key)).alias("candidate_key"),
        "row_count",
        "distinct_keys",
        "null_keys",
        is_key.alias("is_key"),
        F.lit(watermark).cast("string").alias("watermark_col"),
        "watermark_min",
        "watermark_max",
        F.when(incremental, F.lit("incremental")).otherwise(F.lit("full")).alias("load_type"),
        split.alias("partition_col"),
        (F.when(split.isNotNull(), F.lit(PARTITION_NUM)).otherwise(F.lit(1))).cast("long").alias("partition_num"),
    )
