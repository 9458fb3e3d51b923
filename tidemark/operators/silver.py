"""SILVER: the latest live row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.layers import business_columns, is_deleted, live
from tidemark.operators.dedupe import key_struct, latest_per_key


def silver_source(raw: DataFrame, keys: Sequence[str], watermark: str | None) -> DataFrame:
    """Latest RAW row per key, deleted or not, with its flag as ``_is_del`` and its keys as ``_key``."""
    business = business_columns(raw)
    flagged = raw.select(*business, is_deleted().alias("_is_del"), key_struct(keys).alias("_key"))
    return latest_per_key(flagged, keys, watermark, by="_key")


def build_silver(
    silver: DataFrame | None,
    raw: DataFrame,
    keys: Sequence[str],
    watermark: str | None = None,
    snapshot: bool = False,
) -> DataFrame:
    """SILVER after merging RAW into it.

    Matched keys are replaced, or removed when their latest RAW row is deleted;
    new live keys are inserted; keys RAW does not hold stay.  ``snapshot`` says
    RAW is a complete copy of the source, so keys it lacks go as well.  Without
    keys SILVER is all live RAW rows.

    Both inputs of the full outer join hold one row per key, so no key can be
    hot, and RAW's side reuses the partitioning of the latest-row window.
    """
    keys = list(keys)
    if not keys:
        return live(raw).select(*business_columns(raw))
    source = silver_source(raw, keys, watermark)
    columns = silver.columns if silver is not None else business_columns(raw)
    if silver is None or snapshot:
        return source.where(~F.col("_is_del")).select(*columns)

    target = silver.select(*[F.col(f"`{c}`").alias(f"_t_{c}") for c in columns], key_struct(keys).alias("_t_key"))
    # NULL keys are one key, as in the latest-row window, so a rerun changes nothing.
    # _is_del is never NULL in the source, so a NULL marks a target-only row.
    joined = target.join(source, F.col("_t_key") == F.col("_key"), "full_outer").where(
        F.col("_is_del").isNull() | ~F.col("_is_del")
    )
    return joined.select(
        *[
            F.when(F.col("_is_del").isNull(), F.col(f"`_t_{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
            for c in columns
        ]
    )
