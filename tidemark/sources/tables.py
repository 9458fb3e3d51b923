"""Where a configured table's rows come from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from tidemark.layers import SourceColumn, conform, target_schema
from tidemark.sources.dump import PATTERN, read_dump
from tidemark.sources.files import read_by_name
from tidemark.sources.relational import bounds_query, jdbc_options, partitioning
from tidemark.spec import TableSpec

PARQUET, DUMP, JDBC = "parquet", "dump", "jdbc"


@dataclass(frozen=True)
class SourceSpec:
    """A parquet folder, a folder of dump files, or a relational source.

    ``location`` is a path or a JDBC URL.  ``columns`` describe the source table;
    a parquet folder may leave them out and keep its own types.
    """

    kind: str
    location: str
    columns: tuple[SourceColumn, ...] = ()
    pattern: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    # Time zone of the source's wall clock; a relational source is asked instead.
    zone: str = "UTC"


def open_table(
    spark: SparkSession, source: SourceSpec, spec: TableSpec, window: tuple[str | None, str | None] = (None, None)
) -> DataFrame:
    """The source table, lazily.

    A watermark window put on the result reaches a parquet scan through Catalyst's
    own filter pushdown.  A relational read is split into ranges beforehand, so
    there ``window`` is part of the query and of the bounds.
    """
    if source.kind == PARQUET:
        if not source.columns:
            return spark.read.option("pathGlobFilter", source.pattern or "*.parquet").parquet(source.location)
        return read_by_name(spark, source.location, target_schema(source.columns), source.pattern or "*.parquet")
    if source.kind == DUMP:
        return read_dump(spark, source.location, target_schema(source.columns), source.pattern or PATTERN)
    if source.kind == JDBC:
        return conform(_read_jdbc(spark, source, spec, *window), target_schema(source.columns))
    raise ValueError(f"unknown source kind {source.kind!r}")


def _read_jdbc(
    spark: SparkSession, source: SourceSpec, spec: TableSpec, low: str | None, high: str | None
) -> DataFrame:
    bounds = None
    watermark = spec.watermark_col if low is not None or high is not None else None
    column, number = partitioning(source.columns, spec.keys, spec.partition_col, spec.partition_num)
    if column is not None and number > 1:
        # One row: the range to split.
        query = bounds_query(spec.source_db, spec.source_table, column, watermark, low, high)
        reader = spark.read.format("jdbc").options(url=source.location, query=query, **source.options)
        bounds = tuple(reader.load().first())
    options = jdbc_options(
        source.location, spec.source_db, spec.source_table, source.columns, watermark, low, high, column, number, bounds
    )
    return spark.read.format("jdbc").options(**{**source.options, **options}).load()


class Opener:
    """A source for ``Sync``: looks tables up by ``(source_db, source_table)``."""

    def __init__(self, spark: SparkSession, sources: Mapping[tuple[str, str], SourceSpec]):
        self.spark, self.sources = spark, sources

    def __call__(self, spec: TableSpec) -> DataFrame:
        return open_table(self.spark, self.sources[(spec.source_db, spec.source_table)], spec)

    def window(self, spec: TableSpec, low: str | None, high: str | None) -> DataFrame:
        return open_table(self.spark, self.sources[(spec.source_db, spec.source_table)], spec, (low, high))


def opener(spark: SparkSession, sources: Mapping[tuple[str, str], SourceSpec]) -> Opener:
    return Opener(spark, sources)


def clocks(
    spark: SparkSession, sources: Mapping[tuple[str, str], SourceSpec], now: Callable[[], datetime] | None = None
) -> Callable[[TableSpec], datetime]:
    """The sources' wall clocks, for ``Sync(ceiling=...)``: a relational source's answer, else the time in its zone.

    ``now`` gives an instant with a zone and is the system clock by default.
    """

    def ceiling(spec: TableSpec) -> datetime:
        source = sources[(spec.source_db, spec.source_table)]
        if source.kind == JDBC:
            reader = spark.read.format("jdbc").options(
                url=source.location, query="SELECT CURRENT_TIMESTAMP AS t", preferTimestampNTZ="true", **source.options
            )
            return reader.load().first()["t"]
        zone = ZoneInfo(source.zone)
        return (now().astimezone(zone) if now else datetime.now(zone)).replace(tzinfo=None)

    return ceiling
