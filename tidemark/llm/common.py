"""Helpers the operators share."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.staging import stage

__all__ = ["QUERIES", "REFERENCE_SQL", "query", "slices", "table", "stage", "map_rows", "row_key", "mix64", "sha256", "kept", "release"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = {}

SLICE = 128
SLICE_BYTES = 4_000_000  # of text in one slice; a longer text is a slice of its own


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its reference SQL."""

    def register(function):
        @functools.wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            REFERENCE_SQL[name] = sql
        return function

    return register


def importable(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver has it.

    Enough where all machines see that folder; elsewhere the package is installed or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH", "")]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE, size: int = SLICE_BYTES) -> Iterator[dict[str, list]]:
    """Columns of at most ``rows`` rows and about ``size`` bytes of text as Python lists, so that a task never holds many
    long texts at once.
    """
    for batch in batches:
        ends = np.cumsum(_text_bytes(batch))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            fit = int(np.searchsorted(ends, before + size, side="right")) - start
            number = max(1, min(rows, fit))
            yield batch.slice(start, number).to_pydict()
            start += number
    trim()


def _text_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of text and binary values in each row."""
    total = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return total


def map_rows(
    df: DataFrame, function: Callable[[dict[str, list]], dict[str, list] | None], schema: str, rows: int = SLICE
) -> DataFrame:
    """Apply ``function`` to column lists of at most ``rows`` rows at a time; it returns column lists in ``schema``."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = _arrow_schema(target)

    def run(batches):
        for part in slices(batches, rows):
            out = function(part)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, target)


def _arrow_schema(target: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(target)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key for one document row: rows equal in id and text share it, and everything said of one holds for the other."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.xxhash64(F.col(text)).cast("string"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEPT: dict = {}


def kept(key: tuple, make: Callable[[], object]):
    """What a Python worker keeps from task to task: one thing at a time, so that operators in turn do not add up."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drop what other operators' tasks have left in this worker."""
    if _KEPT:
        _KEPT.clear()
        trim()


def trim() -> None:
    """Hand freed memory back to the system: workers wait for their next task, and several share a machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _system_trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


_TRIM = _system_trim()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
