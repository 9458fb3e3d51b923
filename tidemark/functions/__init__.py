from tidemark.functions.hashing import (
    canonical_row,
    canonical_text,
    fingerprint_columns,
    md5_slice,
    row_hash,
)
from tidemark.functions.moments import change_time, ntz, second_text, typed

__all__ = [
    "canonical_row",
    "canonical_text",
    "change_time",
    "fingerprint_columns",
    "md5_slice",
    "ntz",
    "row_hash",
    "second_text",
    "typed",
]
