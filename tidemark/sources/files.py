"""Columnar delta files: a reader that matches by name, a size-bounded writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.layers import conform

DEFAULT_ROWS_PER_FILE = 1_000_000


def read_by_name(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    merge_schema: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """Parquet files matched to ``schema`` by column name, ignoring case.

    ``merge_schema`` reads every footer, for directories whose files differ.
    ``with_file`` adds ``_SRC_FILE``.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(path)
    if not with_file:
        return conform(df, schema)
    tagged = df.select("*", F.col("_metadata.file_path").alias("_SRC_FILE"))
    return conform(tagged, T.StructType([*schema.fields, T.StructField("_SRC_FILE", T.StringType())]))


def write_delta(df: DataFrame, path: str, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> None:
    """Snappy parquet with at most ``rows_per_file`` rows per file; 0 means no limit."""
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
