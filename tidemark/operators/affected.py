"""SILVER after a delta, by its keys alone.

A Bloom filter of the changed keys parts both tables without a shuffle: what it does not let through is untouched for certain.
The few rows let through by chance are told apart by exact joins, which see nothing else of the large tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.layers import business_columns
from tidemark.operators.dedupe import key_struct
from tidemark.operators.silver import silver_source
from tidemark.staging import stage

BITS_PER_KEY = 16
MOST_BITS = 1 << 26  # 8 MB: what every task gets to see is bounded whatever the delta holds
PAGE = 32_768  # bits of one bitmap of Spark's


def _bit(keys: Sequence[str], bits: int) -> Column:
    parts = []
    for k in keys:
        parts += [F.col(f"`{k}`").isNull(), F.col(f"`{k}`")]
    return F.pmod(F.xxhash64(*parts), F.lit(bits))


def bloom(changed: DataFrame, keys: Sequence[str], rows: int) -> tuple[DataFrame, int]:
    """Pages of a bitmap with a bit set for each key, and its number of bits: a power of two, MOST_BITS at most."""
    bits = PAGE
    while bits < min(rows * BITS_PER_KEY, MOST_BITS):
        bits *= 2
    at = _bit(keys, bits)
    pages = changed.select((at / PAGE).cast("int").alias("_page"), F.bitmap_bit_position(at % PAGE + 1).alias("_at"))
    return stage(pages.groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits")), "bloom"), bits


def _may_hold(df: DataFrame, keys: Sequence[str], pages: DataFrame, bits: int) -> DataFrame:
    """``df`` with ``_maybe``: whether its key may be among those of the filter."""
    at = _bit(keys, bits)
    within = F.bitmap_bit_position(at % PAGE + 1)
    byte = F.conv(F.hex(F.substring("_bits", (within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = F.getbit(byte, (within % 8).cast("int")) == 1
    # At most MOST_BITS / 8 bytes, whatever the number of keys.
    page = F.broadcast(pages.withColumnRenamed("_page", "_of"))
    joined = df.join(page, (at / PAGE).cast("int") == F.col("_of"), "left")
    return joined.withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_of", "_bits")


def refresh_silver(silver: DataFrame, raw: DataFrame, changed: DataFrame, keys: Sequence[str], watermark: str | None) -> DataFrame:
    """SILVER with the keys of ``changed`` taken anew from RAW; all other rows as they are.

    ``changed`` holds one row per key of a delta that RAW already has; ``raw`` is all
    of RAW.  A changed key goes where its newest RAW row is deleted or RAW has none.
    NULL keys are one key.  Only rows of changed keys, and about one of BITS_PER_KEY
    others, are shuffled; with more keys than the filter is meant for it lets more
    through, and the result is the same.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("a refresh by key needs at least one key column")
    columns = silver.columns
    changed = stage(changed.select(*keys), "changed")
    pages, bits = bloom(changed, keys, changed.count())
    exact = changed.select(key_struct(keys).alias("_changed"))

    marked = _may_hold(silver, keys, pages, bits)
    untouched = marked.where(~F.col("_maybe")).select(*columns)
    doubtful = marked.where("_maybe").withColumn("_key", key_struct(keys))
    kept = doubtful.join(exact, F.col("_key") == F.col("_changed"), "left_anti").select(*columns)

    business = business_columns(raw)
    near = _may_hold(raw, keys, pages, bits).where("_maybe").select(*business, "_IS_DELETED", "_DELETED_AT")
    latest = silver_source(near, keys, watermark)
    fresh = latest.join(exact, F.col("_key") == F.col("_changed"), "left_semi").where(~F.col("_is_del")).select(*columns)
    return untouched.unionByName(kept).unionByName(fresh)
