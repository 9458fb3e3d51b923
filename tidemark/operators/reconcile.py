"""Delete reconciliation: keys that vanished from the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ntz
from tidemark.layers import is_deleted, live


def _null_safe(keys: Sequence[str], prefix: str) -> Column:
    match = None
    for i, k in enumerate(keys):
        same = F.col(f"`{k}`").eqNullSafe(F.col(f"{prefix}{i}"))
        match = same if match is None else match & same
    return match


def missing_keys(raw: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of live RAW rows the source does not have; NULL equals NULL.

    Keys are compared in RAW's type, which turns into text exactly where RAW
    holds text (decimals wider than 38 digits).  Both key sets meet in one
    grouping: NULLs group together without a null-safe join, only key columns
    are shuffled, once, and a hot key is combined map-side to a row per task.
    """
    keys = list(keys)
    kinds = {f.name.upper(): f.dataType for f in raw.schema.fields}
    have = live(raw).select(*keys, F.lit(False).alias("_offered"))
    offered = source.select(
        *[in_type_of(source, k, kinds[k.upper()]) for k in keys],
        F.lit(True).alias("_offered"),
    )
    return have.union(offered).groupBy(*keys).agg(F.max("_offered").alias("_offered")).where("NOT _offered").drop("_offered")


def in_type_of(df: DataFrame, name: str, want: T.DataType) -> Column:
    """A column of ``df`` in the type its counterpart has."""
    have = next(f.dataType for f in df.schema.fields if f.name.upper() == name.upper())
    return (F.col(f"`{name}`") if have == want else F.col(f"`{name}`").cast(want)).alias(name)


def soft_delete(raw: DataFrame, missing: DataFrame, keys: Sequence[str], as_of: object) -> DataFrame:
    """RAW with the live rows of the ``missing`` keys flagged as deleted at ``as_of``.

    Pass a staged ``missing``: usually few keys vanish, so Catalyst broadcasts
    them and RAW is not shuffled; when many do, the join is a sort-merge join
    whose hot RAW partitions adaptive execution can split.
    """
    keys = list(keys)
    gone = missing.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(True).alias("_gone")
    )
    hit = F.col("_gone").isNotNull() & ~is_deleted()
    flags = {
        "_IS_DELETED": F.when(hit, F.lit(True)).otherwise(F.col("_IS_DELETED")),
        "_DELETED_AT": F.when(hit, ntz(as_of)).otherwise(F.col("_DELETED_AT")),
    }
    return raw.join(gone, _null_safe(keys, "_k"), "left").select(
        *[flags[c].alias(c) if c in flags else F.col(f"`{c}`") for c in raw.columns]
    )


def count_hits(raw: DataFrame, missing: DataFrame, keys: Sequence[str]) -> int:
    """Live RAW rows that ``soft_delete`` would flag; may exceed the number of keys."""
    keys = list(keys)
    gone = missing.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    return live(raw).select(*keys).join(gone, _null_safe(keys, "_k"), "left_semi").count()
