"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def key_struct(keys: Sequence[str], prefix: str = "") -> Column:
    """The keys as one column that is never NULL: equal where the keys are, NULLs included.

    Unlike null-safe equality of each key, a join on it reuses a partitioning by it.
    """
    return F.struct(*[F.col(f"`{prefix}{k}`").alias(f"k{i}") for i, k in enumerate(keys)])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    watermark: str | None = None,
    tiebreak: Sequence[str] | None = None,
    by: str | None = None,
) -> DataFrame:
    """One row per key: highest watermark first, NULL watermarks last.

    Equal watermarks are settled by ``tiebreak`` (default: all other columns),
    descending, so the result does not depend on partitioning.  NULL keys group
    together.  ``by`` names a column that holds the keys (see ``key_struct``), to
    partition the result by it.

    The rank filter lets Spark plan ``WindowGroupLimit``: every map task keeps
    one row per key before the shuffle, so a key holding a large share of all
    rows sends one row per task.
    """
    ranked_by = [watermark] if watermark else []
    if tiebreak is None:
        used = {c.upper() for c in (*keys, *ranked_by, *([by] if by else []))}
        tiebreak = [
            f.name
            for f in df.schema.fields
            if f.name.upper() not in used and not isinstance(f.dataType, _UNORDERED)
        ]
    # With neither watermark nor tiebreak all candidates are equal.
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (*ranked_by, *tiebreak)] or [F.lit(1)]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in ([by] if by else keys)]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
