"""Rows that differ between two tables, found by a tree of fingerprints.

Both sides are added up by the leading bits of a hash of the key: count, exclusive-or and sum of row hashes.  Where these agree
the rows do; only prefixes that differ are added up again by more bits, until few rows are left under them.  Those are compared
key by key.  So two nearly equal tables are scanned a few times, but what is shuffled is some thousand sums for each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import row_hash
from tidemark.staging import stage

LEVEL_BITS = 12  # children of a prefix: 4,096 sums
HASH_BITS = 60
FEW_ROWS = 1_000_000  # compared key by key without another level
ONLY_LEFT, ONLY_RIGHT, CHANGED = "only_left", "only_right", "changed"


def _sums(rows: Column, side: int) -> list[Column]:
    mine = F.col("_side") == side
    return [
        F.count(F.when(mine, rows)).alias(f"_count{side}"),
        F.coalesce(F.bit_xor(F.when(mine, rows)), F.lit(0).cast("long")).alias(f"_xor{side}"),
        F.coalesce(F.sum(F.when(mine, rows.cast("decimal(20,0)"))), F.lit(0).cast("decimal(30,0)")).alias(f"_sum{side}"),
    ]


def _differs() -> Column:
    return (F.col("_count0") != F.col("_count1")) | (F.col("_xor0") != F.col("_xor1")) | (F.col("_sum0") != F.col("_sum1"))


def differing_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    level_bits: int = LEVEL_BITS,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """``keys, difference, left_rows, right_rows`` of every key whose rows are not the same on both sides.

    Rows are compared by 64-bit hashes of all columns of ``left``, to whose types
    ``right`` is cast; a key may have several rows, whose order does not matter.
    NULL keys are equal to each other.  Without a difference, or with empty sides,
    the result is empty.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("rows are compared by key: at least one key column is needed")
    fields = {f.name.upper(): f for f in left.schema.fields}
    names = {c.upper(): c for c in right.columns}
    absent = [c for c in fields if c not in names]
    if absent:
        raise ValueError(f"columns not on the right side: {', '.join(absent)}")
    cast = right.select(*[F.col(f"`{names[u]}`").cast(f.dataType).alias(f.name) for u, f in fields.items()])
    by_key = [fields[k.upper()] for k in keys]

    def hashed(df: DataFrame, side: int) -> DataFrame:
        # Hashed again with a constant: the place in the tree says nothing about the row hash.
        place = F.shiftrightunsigned(F.xxhash64(F.lit("place"), row_hash(by_key)), 64 - HASH_BITS)
        whole = row_hash(list(fields.values()))
        return df.select(*[f.name for f in by_key], place.alias("_place"), whole.alias("_row"), F.lit(side).alias("_side"))

    both = hashed(left, 0).unionByName(hashed(cast, 1))
    under, bits = both, 0
    while True:
        bits = min(bits + level_bits, HASH_BITS)
        prefix = F.shiftright("_place", HASH_BITS - bits)
        sums = under.groupBy(prefix.alias("_prefix")).agg(*_sums(F.col("_row"), 0), *_sums(F.col("_row"), 1))
        parts = stage(sums.where(_differs()).select("_prefix", (F.col("_count0") + F.col("_count1")).alias("_rows")), "differing")
        left_over = parts.agg(F.sum("_rows")).first()[0] or 0
        # Each level scans the given tables: what is left of them is chosen by the staged prefixes.
        chosen = parts.select(F.col("_prefix").alias("_chosen"))
        under = both.join(chosen, prefix == F.col("_chosen"), "left_semi")
        if left_over <= few_rows or bits == HASH_BITS:
            break
    found = under.groupBy(*[f.name for f in by_key]).agg(*_sums(F.col("_row"), 0), *_sums(F.col("_row"), 1)).where(_differs())
    kind = F.when(F.col("_count1") == 0, ONLY_LEFT).when(F.col("_count0") == 0, ONLY_RIGHT).otherwise(CHANGED)
    return found.select(
        *[F.col(f"`{f.name}`") for f in by_key],
        kind.alias("difference"),
        F.col("_count0").alias("left_rows"),
        F.col("_count1").alias("right_rows"),
    )
