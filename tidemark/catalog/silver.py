"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import (
    LOADED_AT,
    ORDERS_CUT,
    ORDERS_SECOND_CUT,
    flagged,
    money,
    orders,
    orders_until,
    query,
    table,
)
from tidemark.layers import with_audit
from tidemark.operators.affected import refresh_silver
from tidemark.operators.silver import build_silver
from tidemark.sources.window import incremental_window
from tidemark.staging import stage

LATEST = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM (SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice,
               o_orderdate, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate {window}) WHERE rn = 1"""
BEFORE = LATEST.format(window=f"<= timestamp '{ORDERS_CUT}'")
AFTER = LATEST.format(window=f"> timestamp '{ORDERS_CUT}'")


@query(
    """SELECT event_id, ts, user_id, event_type, cast(value AS decimal(18,2)) AS value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
)
def silver_latest(spark: SparkSession, folder: str) -> DataFrame:
    """First build: the newest event of every user."""
    raw = with_audit(money(table(spark, folder, "events")), LOADED_AT)
    return build_silver(None, raw, ["user_id"], "ts")


def _state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """SILVER built at the cut, and a RAW holding only what came after."""
    silver = build_silver(
        None, with_audit(orders_until(spark, folder, ORDERS_CUT), LOADED_AT), ["o_custkey"], "o_orderdate"
    )
    later = incremental_window(orders(spark, folder), "o_orderdate", ORDERS_CUT, None)
    raw = flagged(later, F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return silver, raw


@query(
    f"""WITH t AS ({BEFORE}), s AS ({AFTER})
SELECT * FROM s WHERE o_orderstatus <> 'F'
UNION ALL
SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM s)"""
)
def silver_with_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """Replaced, inserted, removed and untouched keys; cancelled orders count as deleted."""
    silver, raw = _state(spark, folder)
    return build_silver(silver, raw, ["o_custkey"], "o_orderdate")


@query(f"SELECT * FROM ({AFTER}) WHERE o_orderstatus <> 'F'")
def silver_snapshot_sync(spark: SparkSession, folder: str) -> DataFrame:
    """RAW is the complete source: keys it lacks leave SILVER too."""
    silver, raw = _state(spark, folder)
    return build_silver(silver, raw, ["o_custkey"], "o_orderdate", snapshot=True)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"""
)
def silver_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    """No key: all live RAW rows."""
    raw = flagged(orders(spark, folder), F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return build_silver(None, raw, [])


@query(f"SELECT * FROM ({LATEST.format(window='IS NOT NULL')}) WHERE o_orderstatus <> 'F'")
def silver_two_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Two deltas, each refreshing only the customers it names; cancelled orders count as deleted."""
    raw = flagged(orders(spark, folder), F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    silver, seen = None, None
    for cut in (ORDERS_CUT, ORDERS_SECOND_CUT, None):
        upto = incremental_window(raw, "o_orderdate", None, cut) if cut else raw
        if silver is None:
            silver = build_silver(None, upto, ["o_custkey"], "o_orderdate")
        else:
            changed = incremental_window(raw, "o_orderdate", seen, cut).select("o_custkey").distinct()
            silver = refresh_silver(silver, upto, changed, ["o_custkey"], "o_orderdate")
        silver, seen = stage(silver, "silver"), cut
    return silver
