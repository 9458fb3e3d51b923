"""Options for Spark's JDBC reader: projection, window and range partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.layers import INTEGER_TYPES, SourceColumn, is_wide_decimal

RANGE_TYPES = INTEGER_TYPES | {"date", "datetime", "timestamp"}


def projection(columns: Sequence[SourceColumn]) -> str:
    """Explicit column list.  A decimal wider than 38 digits is read as text, losslessly."""
    return ", ".join(
        f"CAST(`{c.name}` AS CHAR) AS `{c.name}`" if is_wide_decimal(c) else f"`{c.name}`"
        for c in columns
    )


DEFAULT_READERS = 8


def partitioning(
    columns: Sequence[SourceColumn], keys: Sequence[str], partition_col: str | None, partition_num: int
) -> tuple[str | None, int]:
    """Column and number of ranges of a parallel read: as configured, else by the only key if that is an integer."""
    if partition_col is not None:
        return partition_col, max(partition_num, 1) if partition_num > 1 else DEFAULT_READERS
    kinds = {c.name.upper(): c.data_type.lower() for c in columns}
    if len(keys) == 1 and kinds.get(keys[0].upper()) in INTEGER_TYPES:
        return keys[0], partition_num if partition_num > 1 else DEFAULT_READERS
    return None, 1


def _where(watermark: str | None, low: str | None, high: str | None) -> str:
    conditions = []
    if watermark and low is not None:
        conditions.append(f"`{watermark}` > '{low}'")
    if watermark and high is not None:
        conditions.append(f"`{watermark}` <= '{high}'")
    return " WHERE " + " AND ".join(conditions) if conditions else ""


def bounds_query(
    source_db: str,
    source_table: str,
    column: str,
    watermark: str | None = None,
    low: str | None = None,
    high: str | None = None,
) -> str:
    """One-row query for the ``bounds`` of a partitioned read of the window, so that new rows spread over all readers."""
    what = f"SELECT MIN(`{column}`) AS lo, MAX(`{column}`) AS hi FROM `{source_db}`.`{source_table}`"
    return what + _where(watermark, low, high)


def jdbc_options(
    url: str,
    source_db: str,
    source_table: str,
    columns: Sequence[SourceColumn],
    watermark: str | None = None,
    low: str | None = None,
    high: str | None = None,
    partition_col: str | None = None,
    partition_num: int = 1,
    bounds: tuple[object, object] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    The window is part of the pushed query.  The read is split into
    ``partition_num`` ranges when ``partition_col`` is an integer, date or
    timestamp column and its ``bounds`` (one ``min``/``max`` query) are known;
    otherwise one reader is used.  Timestamps stay in source wall-clock time.
    """
    query = f"SELECT {projection(columns)} FROM `{source_db}`.`{source_table}`" + _where(watermark, low, high)
    options = {
        "url": url,
        "dbtable": f"({query}) AS src",
        "preferTimestampNTZ": "true",
        "fetchsize": str(fetch_size),
    }
    kinds = {c.name.upper(): c.data_type.lower() for c in columns}
    splittable = partition_col is not None and kinds.get(partition_col.upper()) in RANGE_TYPES
    if splittable and partition_num > 1 and bounds is not None and None not in bounds:
        options |= {
            "partitionColumn": partition_col,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partition_num),
        }
    return options
