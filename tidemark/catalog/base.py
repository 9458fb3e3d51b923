"""Registration of queries, and the inputs they share.

Source and target states come from the given tables by time: what was loaded up
to a cut, and what changed since.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import second_text
from tidemark.layers import with_audit
from tidemark.sources.window import incremental_window

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
REFERENCE_SQL: dict[str, str] = {}

# Instants of the examples.  Orders span 1995 to 2001, events January 2024.
ORDERS_CUT = "1999-01-01 00:00:00"
ORDERS_OVERLAP = "1998-01-01 00:00:00"
ORDERS_SECOND_CUT = "2000-06-01 00:00:00"
LOADED_AT = datetime(2024, 2, 1, 3, 0, 0)
MERGED_AT = datetime(2024, 2, 2, 3, 0, 0)
LOG_AS_OF = datetime(2024, 1, 31, 0, 0, 0)

# SQL of the audit columns a fresh RAW row carries.
AUDIT_SQL = """timestamp '{at}' AS "_LOAD_TS", cast(NULL AS varchar) AS "_SRC_FILE",
       {batch} AS "_BATCH_ID", false AS "_IS_DELETED", cast(NULL AS timestamp) AS "_DELETED_AT\""""


def audit_sql(at: datetime, batch: str | None = None) -> str:
    return AUDIT_SQL.format(at=at, batch=f"'{batch}'" if batch else "cast(NULL AS varchar)")


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            REFERENCE_SQL[key] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(df: DataFrame) -> DataFrame:
    """Doubles as decimal(18,2), so both engines show the same value."""
    return df.select(
        *[
            F.col(f.name).cast("decimal(18,2)").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return money(table(spark, folder, "orders"))


def orders_until(spark: SparkSession, folder: str, cut: str) -> DataFrame:
    return incremental_window(orders(spark, folder), "o_orderdate", None, cut)


def orders_raw(spark: SparkSession, folder: str) -> DataFrame:
    """RAW after a load at the first cut."""
    return with_audit(orders_until(spark, folder, ORDERS_CUT), LOADED_AT, "load-1")


def orders_change(spark: SparkSession, folder: str) -> DataFrame:
    """The window after the cut with a one-year overlap, every price raised by one."""
    window = incremental_window(orders(spark, folder), "o_orderdate", ORDERS_OVERLAP, None)
    return window.withColumn("o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(18,2)"))


def flagged(df: DataFrame, deleted, deleted_at) -> DataFrame:
    """RAW rows whose delete flag and time come from expressions."""
    return with_audit(df, LOADED_AT, "load-1").withColumns(
        {"_IS_DELETED": deleted, "_DELETED_AT": F.when(deleted, deleted_at).otherwise(F.lit(None).cast("timestamp_ntz"))}
    )


def shown(dim: DataFrame) -> DataFrame:
    """A dimension with the open end date as text: year 9999 overflows many clients."""
    return dim.withColumn("EFF_TO", second_text(F.col("EFF_TO")))
