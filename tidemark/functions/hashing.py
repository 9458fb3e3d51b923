"""Change-detection hashes and the order-independent table fingerprint."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import second_text

# Both sides of a parity check must build the same row text.
NULL_TEXT = "~N~"
SEPARATOR = "~|~"
HEX_DIGITS = 15


def canonical_text(field: T.StructField, seconds: bool = False) -> Column:
    """Text of one column: different for different values.

    ``seconds`` cuts timestamps to the second, for a side that keeps no fractions.
    """
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = second_text(col) if seconds else col.cast("string")
    elif isinstance(kind, T.BooleanType):
        text = col.cast("int").cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(col)
    elif isinstance(kind, T.VariantType):
        text = F.to_json(col)
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def canonical_row(fields: Iterable[T.StructField], seconds: bool = False) -> Column:
    return F.concat_ws(SEPARATOR, *[canonical_text(f, seconds) for f in fields])


def md5_slice(fields: Iterable[T.StructField], seconds: bool = False) -> Column:
    """First 60 bits of the MD5 of the row text: the same on any engine with MD5."""
    digest = F.substring(F.md5(canonical_row(fields, seconds)), 1, HEX_DIGITS)
    return F.conv(digest, 16, 10).cast("long")


def row_hash(fields: Iterable[T.StructField]) -> Column:
    """64-bit change hash of the tracked columns.

    ``xxhash64`` skips NULLs, so a value that moves from one nullable column to
    its neighbour would hash the same; hashing each null flag as well keeps the
    two rows apart.
    """
    parts: list[Column] = []
    for field in fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.VariantType):
            col = F.to_json(col)
        parts += [col.isNull(), col]
    return F.xxhash64(*parts)


def fingerprint_columns(fields: Iterable[T.StructField], seconds: bool = False) -> dict[str, Column]:
    """Aggregates ``count``, ``bit_xor`` and ``sum`` of a 60-bit slice of each row's MD5.

    XOR alone cannot see rows that occur an even number of times; count and sum can.
    """
    slice_ = md5_slice(fields, seconds)
    return {
        "rows": F.count(slice_),
        "hash_xor": F.coalesce(F.bit_xor(slice_), F.lit(0).cast("long")),
        "hash_sum": F.coalesce(
            # decimal(28,0) sums to decimal(38,0): room for 10^10 times 10^10 rows
            F.sum(slice_.cast("decimal(28,0)")),
            F.lit(0).cast("decimal(38,0)"),
        ),
    }
