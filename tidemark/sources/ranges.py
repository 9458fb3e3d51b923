"""Ranges of a column that give parallel readers equal work.

Ranges of equal width leave most rows of a skewed column to one reader.  Here the bounds are quantiles of the column, taken from
one pass over what is already loaded; rows beyond its ends go to the first and last reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 100  # a bound's rank is off by at most one in so many of a reader's share


def balanced_bounds(df: DataFrame, column: str, readers: int) -> list:
    """Inner bounds of at most ``readers`` ranges with about as many rows each, rising.

    A value so frequent that it fills several ranges leaves fewer bounds, since rows
    of one value stay together.  NULLs do not count.  Without rows there is no bound.
    """
    if readers < 1:
        raise ValueError("at least one reader is needed")
    if readers == 1:
        return []
    shares = F.array(*[F.lit(i / readers) for i in range(1, readers)])
    accuracy = F.lit(readers * ACCURACY)
    row = df.agg(F.percentile_approx(F.col(f"`{column}`"), shares, accuracy).alias("q"), F.min(f"`{column}`").alias("lo")).first()
    return [b for b in sorted(set(row["q"] or ())) if b > row["lo"]]


def reader_of(column: str, bounds: Sequence) -> Column:
    """Number of the range, from 0, that a row falls into; NULLs go to the first."""
    value = F.col(f"`{column}`")
    out = F.lit(0)
    for bound in bounds:
        out = out + F.coalesce((value >= F.lit(bound)).cast("int"), F.lit(0))
    return out


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """One condition a reader, for ``predicates`` of ``spark.read.jdbc``.  Each row meets exactly one."""
    if not bounds:
        return ["1 = 1"]
    texts = [f"'{b}'" if isinstance(b, (date, str)) else str(b) for b in bounds]
    name = f"`{column}`"
    first, last = f"{name} < {texts[0]} OR {name} IS NULL", f"{name} >= {texts[-1]}"
    inner = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(texts, texts[1:])]
    return [first, *inner, last]
