"""Vanished keys from an invertible sketch of both key sets.

Every key hash falls into one cell of each of PARTS tables; a cell keeps the number of keys, the exclusive-or of their hashes and
that of check sums of these.  Subtracting the source's cells from RAW's leaves only keys that one side has and the other has not.
A cell with one such key gives it away; taking it out of its other cells frees more.  So keys are read once on each side and
never shuffled: what a task sends, and what reaches the driver to be taken apart, is CELLS sums at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.layers import live
from tidemark.operators.reconcile import in_type_of, missing_keys
from tidemark.staging import stage

PARTS = 3
CELLS = 3 * 65_536  # room for about 150,000 differences
SLICE_BITS = 21  # a key's place in each table is another slice of its hash


def _hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key; NULLs are told from values."""
    parts: list[Column] = []
    for k in keys:
        parts += [F.col(f"`{k}`").isNull(), F.col(f"`{k}`")]
    return F.xxhash64(*parts)


def _check(hashed: Column) -> Column:
    return F.conv(F.substring(F.md5(hashed.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def check_of(hashed: int) -> int:
    """``_check`` on the driver."""
    return int(hashlib.md5(str(hashed).encode()).hexdigest()[:15], 16)


def cells_of(hashed: int, cells: int) -> list[int]:
    """Places of a hash, as ``difference_cells`` computes them."""
    each, mask = cells // PARTS, (1 << SLICE_BITS) - 1
    return [(hashed >> part * SLICE_BITS & mask) % each + part * each for part in range(PARTS)]


def difference_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], cells: int = CELLS) -> DataFrame:
    """``cell, number, hashes, checks`` of the cells in which two key sets differ."""
    each, mask = cells // PARTS, (1 << SLICE_BITS) - 1

    def spread(df: DataFrame, sign: int) -> DataFrame:
        hashed = df.select(_hash(keys).alias("_hash")).withColumn("_check", _check(F.col("_hash")))
        slices = [F.shiftright("_hash", part * SLICE_BITS).bitwiseAND(F.lit(mask)) % each + part * each for part in range(PARTS)]
        return hashed.select(F.explode(F.array(*slices)).alias("cell"), "_hash", "_check", F.lit(sign).alias("_sign"))

    sums = spread(left, 1).unionByName(spread(right, -1)).groupBy("cell").agg(
        F.sum("_sign").alias("number"), F.bit_xor("_hash").alias("hashes"), F.bit_xor("_check").alias("checks")
    )
    return sums.where("number <> 0 OR hashes <> 0 OR checks <> 0")


def taken_apart(rows: Iterable[tuple[int, int, int, int]], cells: int) -> tuple[dict[int, int], bool]:
    """Key hashes with the side that has them (1 left, -1 right), and whether all cells came out empty."""
    left = {cell: [number, hashes, checks] for cell, number, hashes, checks in rows}
    found: dict[int, int] = {}
    queue = list(left)
    while queue:
        number, hashes, checks = left.get(queue.pop(), (0, 0, 0))
        if abs(number) != 1 or check_of(hashes) != checks or hashes in found:
            continue
        found[hashes] = number
        for cell in cells_of(hashes, cells):
            own = left.setdefault(cell, [0, 0, 0])
            own[0] -= number
            own[1] ^= hashes
            own[2] ^= checks
            queue.append(cell)
    return found, not any(any(own) for own in left.values())


def missing_keys_by_sketch(raw: DataFrame, source: DataFrame, keys: Sequence[str], cells: int = CELLS) -> DataFrame:
    """The same keys as ``missing_keys``, for tables that differ in few of them.

    Hashes found in the sketch only choose the keys that are compared; the comparison
    is exact.  Where the sketch cannot be taken apart - more differences than it has
    room for, or a key that one side repeats - all keys are compared.
    """
    keys = list(keys)
    cells = max(PARTS, cells // PARTS * PARTS)
    kinds = {f.name.upper(): f.dataType for f in raw.schema.fields}
    have = live(raw).select(*keys)
    offered = source.select(*[in_type_of(source, k, kinds[k.upper()]) for k in keys])
    rows = difference_cells(have, offered, keys, cells).collect()
    found, complete = taken_apart((tuple(row) for row in rows), cells)
    if not complete:
        return missing_keys(raw, source, keys)
    gone = [(hashed,) for hashed, side in found.items() if side > 0]
    if not gone:
        return have.limit(0)
    wanted = stage(raw.sparkSession.createDataFrame(gone, "_gone long"), "gone")

    def chosen(df: DataFrame) -> DataFrame:
        # No hash is wanted twice.  A semi join would be pushed into a union, where a constant key leaves it nothing to join by.
        return df.withColumn("_hash", _hash(keys)).join(wanted, F.col("_hash") == F.col("_gone")).drop("_hash", "_gone")

    return missing_keys(chosen(raw), chosen(offered), keys)
