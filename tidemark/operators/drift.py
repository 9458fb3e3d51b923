"""Additive schema drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.layers import AUDIT, CONTROL, business_fields


@dataclass(frozen=True)
class Drift:
    """Columns new at the source (in source order) and columns it no longer has."""

    added: tuple[T.StructField, ...] = ()
    dropped: tuple[str, ...] = ()

    @property
    def added_names(self) -> list[str]:
        return [f.name for f in self.added]


def detect_drift(source: T.StructType, target: T.StructType | None) -> Drift:
    """Compare a source schema with a layer's business columns, ignoring case.

    Changed types are not drift.  A layer that does not exist yet has none either.
    """
    known = {f.name.upper() for f in business_fields(target)} if target is not None else set()
    if not known:
        return Drift()
    offered = {f.name.upper() for f in source.fields}
    return Drift(
        added=tuple(
            T.StructField(f.name.upper(), f.dataType) for f in source.fields if f.name.upper() not in known
        ),
        dropped=tuple(sorted(known - offered)),
    )


def widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of ``have`` is one of ``want``, and files of the first read as the second."""
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    if type(have) in whole and type(want) in whole:
        return whole.index(type(have)) < whole.index(type(want))
    if isinstance(want, T.DecimalType):
        if isinstance(have, T.DecimalType):
            return want != have and want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
        return type(have) in digits and want.precision - want.scale >= digits[type(have)]
    if isinstance(want, T.DoubleType):
        return isinstance(have, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    return isinstance(have, T.DateType) and isinstance(want, T.TimestampNTZType)


def widened(schema: T.StructType, source: T.StructType, reset: bool = False) -> T.StructType:
    """``schema`` with the source's type where that is wider; with ``reset`` wherever it differs."""
    offered = {f.name.upper(): f.dataType for f in source.fields}
    business = {f.name for f in business_fields(schema)}

    def kind(field: T.StructField) -> T.DataType:
        new = offered.get(field.name.upper(), field.dataType)
        return new if field.name in business and (reset or widens(field.dataType, new)) else field.dataType

    return T.StructType([T.StructField(f.name, kind(f), f.nullable) for f in schema.fields])


def evolve(schema: T.StructType, drift: Drift) -> T.StructType:
    """``schema`` with the added columns after its business columns."""
    have = {f.name.upper() for f in schema.fields}
    extra = [f for f in drift.added if f.name.upper() not in have]
    trailing = {c for c in (*AUDIT, *CONTROL) if c != "DIM_KEY"}
    head = [f for f in schema.fields if f.name not in trailing]
    tail = [f for f in schema.fields if f.name in trailing]
    return T.StructType([*head, *extra, *tail])


def apply_drift(df: DataFrame, drift: Drift) -> DataFrame:
    """``df`` with the added columns, NULL in every existing row."""
    have = {f.name.upper() for f in df.schema.fields}
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name.upper() in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in evolve(df.schema, drift).fields
        ]
    )
