"""Versioned history of each customer's latest order.

Status and priority are tracked; the change hash is the portable MD5 slice, so
another engine arrives at the same value.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import (
    LOADED_AT,
    MERGED_AT,
    ORDERS_CUT,
    ORDERS_SECOND_CUT,
    flagged,
    orders,
    orders_until,
    query,
    shown,
    table,
)
from tidemark.functions import md5_slice
from tidemark.layers import with_audit
from tidemark.operators.lookup import fact_lookup
from tidemark.operators.scd2 import (
    NEW,
    as_of_versions,
    assign_surrogate,
    build_scd2,
    current_versions,
    empty_dimension,
    scd2_changes,
    scd2_source,
)
from tidemark.operators.splice import scd2_change_rows, splice_scd2
from tidemark.staging import stage

KEYS, WATERMARK, TRACK = ["o_custkey"], "o_orderdate", ["o_orderstatus", "o_orderpriority"]
THIRD_AT = datetime(2024, 2, 3, 3, 0, 0)

# --- the same builds in SQL -------------------------------------------------

COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
HIGH = "timestamp '9999-12-31 00:00:00'"
NEVER = "cast(NULL AS timestamp)"


def _source_sql(name: str, window: str = "true", deleted: str = "false", deleted_at: str = NEVER) -> str:
    return f"""{name} AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         {deleted} AS is_del, CASE WHEN {deleted} THEN {deleted_at} END AS del_at,
         cast('0x' || substr(md5(coalesce(o_orderstatus, '~N~') || '~|~' || coalesce(o_orderpriority, '~N~')), 1, 15)
              AS bigint) AS h
  FROM (SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice,
               o_orderdate, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE {window}) WHERE rn = 1)"""


def _first_sql(name: str, source: str, at: datetime, batch: str) -> str:
    business = ", ".join(COLUMNS)
    return f"""{name} AS (
  SELECT {business}, o_orderdate AS eff_from, {HIGH} AS eff_to, true AS cur, false AS del, h,
         timestamp '{at}' AS load_ts, '{batch}' AS batch FROM {source} WHERE NOT is_del)"""


def _next_sql(name: str, dim: str, source: str, at: datetime, batch: str) -> str:
    business, old, new = (", ".join(p + c for c in COLUMNS) for p in ("", "t.", "s."))
    return f"""{name} AS (
  SELECT {business}, eff_from, eff_to, cur, del, h, load_ts, batch FROM {dim} WHERE NOT cur
  UNION ALL
  SELECT {old}, t.eff_from,
         CASE WHEN s.is_del THEN coalesce(s.del_at, timestamp '{at}')
              WHEN s.h <> t.h THEN s.o_orderdate ELSE t.eff_to END,
         NOT coalesce(s.is_del OR s.h <> t.h, false), t.del OR coalesce(s.is_del, false), t.h, t.load_ts, t.batch
  FROM {dim} t LEFT JOIN {source} s ON s.o_custkey = t.o_custkey WHERE t.cur
  UNION ALL
  SELECT {new}, s.o_orderdate, {HIGH}, true, false, s.h, timestamp '{at}', '{batch}'
  FROM {source} s WHERE NOT s.is_del AND NOT EXISTS (
    SELECT 1 FROM {dim} t WHERE t.cur AND t.o_custkey = s.o_custkey AND t.h = s.h))"""


def _shown_sql(dim: str, where: str = "true") -> str:
    return f"""SELECT {", ".join(COLUMNS)}, eff_from AS "EFF_FROM",
       strftime(eff_to, '%Y-%m-%d %H:%M:%S') AS "EFF_TO", cur AS "IS_CURRENT", del AS "IS_DELETED",
       h AS "ROW_HASH", load_ts AS "_LOAD_TS", batch AS "_BATCH_ID" FROM {dim} WHERE {where}"""


SOURCE_1 = _source_sql("s1", f"o_orderdate <= timestamp '{ORDERS_CUT}'")
SOURCE_2 = _source_sql("s2", f"o_orderdate <= timestamp '{ORDERS_SECOND_CUT}'")
SOURCE_3 = _source_sql("s3")
ONE = f"WITH {SOURCE_1}, {_first_sql('d1', 's1', LOADED_AT, 'b1')}"
TWO = f"{ONE}, {SOURCE_2}, {_next_sql('d2', 'd1', 's2', MERGED_AT, 'b2')}"
THREE = f"{TWO}, {SOURCE_3}, {_next_sql('d3', 'd2', 's3', THIRD_AT, 'b3')}"
# The newest order of a customer being low-priority stands for a deleted customer.
GONE, GONE_AT = "o_orderpriority = '5-LOW'", "o_orderdate + INTERVAL 30 DAY"
SOURCE_DELETED = _source_sql("sd", deleted=GONE, deleted_at=GONE_AT)
DELETED = f"{ONE}, {SOURCE_DELETED}, {_next_sql('d2', 'd1', 'sd', MERGED_AT, 'b2')}"
RETURNED = f"{DELETED}, {SOURCE_3}, {_next_sql('d3', 'd2', 's3', THIRD_AT, 'b3')}"


# --- builds -----------------------------------------------------------------

def _build(dim: DataFrame | None, raw: DataFrame, at: datetime, batch: str) -> DataFrame:
    """One build; the dimension it starts from is a written table, as in a run."""
    stored = None if dim is None else stage(dim, "dimension")
    return build_scd2(stored, raw, KEYS, WATERMARK, at, TRACK, batch, md5_slice)


def _one(spark: SparkSession, folder: str) -> DataFrame:
    return _build(None, with_audit(orders_until(spark, folder, ORDERS_CUT), LOADED_AT), LOADED_AT, "b1")


def _two(spark: SparkSession, folder: str) -> DataFrame:
    raw = with_audit(orders_until(spark, folder, ORDERS_SECOND_CUT), MERGED_AT)
    return _build(_one(spark, folder), raw, MERGED_AT, "b2")


def _three(spark: SparkSession, folder: str) -> DataFrame:
    return _build(_two(spark, folder), with_audit(orders(spark, folder), THIRD_AT), THIRD_AT, "b3")


def _deleted(spark: SparkSession, folder: str) -> DataFrame:
    raw = flagged(
        orders(spark, folder),
        F.col("o_orderpriority") == "5-LOW",
        F.col("o_orderdate") + F.make_dt_interval(days=F.lit(30)),
    )
    return _build(_one(spark, folder), raw, MERGED_AT, "b2")


@query(f"{ONE} {_shown_sql('d1')}")
def scd2_initial(spark: SparkSession, folder: str) -> DataFrame:
    """The first build: one current version per customer."""
    return shown(_one(spark, folder))


@query(f"{TWO} {_shown_sql('d2')}")
def scd2_two_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Changed, unchanged and new customers."""
    return shown(_two(spark, folder))


@query(f"{DELETED} {_shown_sql('d2')}")
def scd2_with_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Deleted customers close without a successor."""
    return shown(_deleted(spark, folder))


@query(f"{RETURNED} {_shown_sql('d3')}")
def scd2_returning_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Customers that come back after deletion open a new version."""
    raw = with_audit(orders(spark, folder), THIRD_AT)
    return shown(_build(_deleted(spark, folder), raw, THIRD_AT, "b3"))


@query(f"{THREE} {_shown_sql('d3')}")
def scd2_three_batches(spark: SparkSession, folder: str) -> DataFrame:
    """History grows; versions closed earlier pass through."""
    return shown(_three(spark, folder))


# Orders of the middle years arrive first, then the oldest, then the newest; each order is a change of its customer.
ARRIVALS = (
    f"o_orderdate > timestamp '{ORDERS_CUT}' AND o_orderdate <= timestamp '{ORDERS_SECOND_CUT}'",
    f"o_orderdate <= timestamp '{ORDERS_CUT}'",
    f"o_orderdate > timestamp '{ORDERS_SECOND_CUT}'",
)


def _arrival_sql(n: int) -> str:
    """Versions after one more arrival: a change to what is in force is none."""
    kept = f"SELECT * FROM k{n - 1} UNION ALL " if n else ""
    return f"""k{n} AS (SELECT {", ".join(COLUMNS)}, h, n FROM ({kept}SELECT {", ".join(COLUMNS)}, h, {n} AS n FROM changes
    WHERE {ARRIVALS[n]}) QUALIFY n < {n} OR h IS DISTINCT FROM lag(h) OVER (PARTITION BY o_custkey ORDER BY o_orderdate))"""


@query(
    f"""WITH {_source_sql("s").replace("PARTITION BY o_custkey ORDER BY o_orderdate DESC", "PARTITION BY o_custkey, o_orderdate ORDER BY o_orderdate DESC")},
changes AS (SELECT * FROM s), {", ".join(_arrival_sql(n) for n in range(3))},
v AS (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS until FROM k2)
SELECT {", ".join(COLUMNS)}, o_orderdate AS "EFF_FROM",
       coalesce(strftime(until, '%Y-%m-%d %H:%M:%S'), '9999-12-31 00:00:00') AS "EFF_TO", until IS NULL AS "IS_CURRENT",
       false AS "IS_DELETED", h AS "ROW_HASH", timestamp '{LOADED_AT}' AS "_LOAD_TS", 'b' || n AS "_BATCH_ID" FROM v"""
)
def scd2_late_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A history built from three arrivals out of order: late changes are cut into closed versions."""
    dim = None
    for n, arrived in enumerate(ARRIVALS):
        raw = with_audit(orders(spark, folder).where(arrived), LOADED_AT)
        changes = scd2_change_rows(raw, KEYS, WATERMARK, LOADED_AT, TRACK, md5_slice)
        dim = stage(splice_scd2(dim, changes, KEYS, LOADED_AT, f"b{n}"), "dimension")
    return shown(dim)


@query(f'{TWO} SELECT {", ".join(COLUMNS)}, eff_from AS "EFF_FROM" FROM d2 WHERE cur')
def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    """The current-version view."""
    return current_versions(_two(spark, folder))


# The last instant at which a version ended: there half-open and closed intervals differ.
BOUNDARY_SQL = "(SELECT max(eff_to) FROM d3 WHERE eff_to < timestamp '9999-01-01')"


def _boundary(dim: DataFrame) -> str:
    ended = dim.where(F.col("EFF_TO") < F.lit("9999-01-01 00:00:00").cast("timestamp_ntz"))
    return str(ended.agg(F.max("EFF_TO")).first()[0])


@query(f"{THREE} {_shown_sql('d3', f'eff_from <= {BOUNDARY_SQL} AND eff_to > {BOUNDARY_SQL}')}")
def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Versions in force at an instant, end exclusive."""
    dim = stage(_three(spark, folder), "dimension")
    return shown(as_of_versions(dim, _boundary(dim)))


@query(f"{THREE} {_shown_sql('d3', f'{BOUNDARY_SQL} BETWEEN eff_from AND eff_to')}")
def scd2_as_of_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    """The same with both ends inclusive."""
    dim = stage(_three(spark, folder), "dimension")
    return shown(as_of_versions(dim, _boundary(dim), inclusive=True))


@query(
    f"""{THREE}
SELECT o.o_orderkey AS fact_orderkey, o.o_custkey AS fact_custkey, o.o_orderdate AS fact_date,
       d.o_orderkey AS version_orderkey, d.o_orderstatus AS version_status, d.o_orderpriority AS version_priority
FROM orders o JOIN d3 d ON d.o_custkey = o.o_custkey AND o.o_orderdate >= d.eff_from AND o.o_orderdate < d.eff_to"""
)
def scd2_fact_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the customer version in force at its date."""
    fact = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("fact_orderkey"),
        F.col("o_custkey").alias("fact_custkey"),
        F.col("o_orderdate").alias("fact_date"),
    )
    dim = stage(_three(spark, folder), "dimension")
    found = fact_lookup(fact, dim, [("fact_custkey", "o_custkey")], "fact_date")
    return found.select(
        "fact_orderkey",
        "fact_custkey",
        "fact_date",
        F.col("o_orderkey").alias("version_orderkey"),
        F.col("o_orderstatus").alias("version_status"),
        F.col("o_orderpriority").alias("version_priority"),
    )


@query(
    """WITH d AS (SELECT user_id AS dim_user, date_trunc('day', ts) + INTERVAL 1 DAY AS eff_from,
        date_trunc('day', ts) + INTERVAL 2 DAY AS eff_to, count(*) AS events_before,
        max(cast(value AS decimal(18,2))) AS top_value
      FROM events GROUP BY user_id, date_trunc('day', ts))
SELECT e.event_id, e.user_id, e.ts, d.events_before, d.top_value
FROM events e LEFT JOIN d ON d.dim_user = e.user_id AND e.ts >= d.eff_from AND e.ts < d.eff_to"""
)
def scd2_fact_lookup_long(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension with one version per user and day; the facts keep their unmatched rows."""
    events = table(spark, folder, "events")
    day = F.to_date("ts").cast("timestamp_ntz")
    dim = (
        events.groupBy(F.col("user_id").alias("dim_user"), day.alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events_before"),
            F.max(F.col("value").cast("decimal(18,2)")).alias("top_value"),
        )
        .select(
            "dim_user",
            (F.col("day") + F.make_dt_interval(days=F.lit(1))).alias("EFF_FROM"),
            (F.col("day") + F.make_dt_interval(days=F.lit(2))).alias("EFF_TO"),
            "events_before",
            "top_value",
        )
    )
    found = fact_lookup(events, stage(dim, "dimension"), [("user_id", "dim_user")], "ts", how="left")
    return found.select("event_id", "user_id", "ts", "events_before", "top_value")


HOT_SUPPLIER = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END"


@query(
    f"""WITH items AS (SELECT l_orderkey, l_linenumber, {HOT_SUPPLIER} AS seller, l_shipdate,
        cast(l_extendedprice AS decimal(18,2)) AS price FROM lineitem),
d AS (SELECT seller AS dim_seller, date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS eff_from,
        date_trunc('month', l_shipdate) + INTERVAL 2 MONTH AS eff_to, count(*) AS items_before, max(price) AS top_price
      FROM items GROUP BY seller, date_trunc('month', l_shipdate))
SELECT i.l_orderkey, i.l_linenumber, i.seller, i.price, d.items_before, d.top_price
FROM items i LEFT JOIN d ON d.dim_seller = i.seller AND i.l_shipdate >= d.eff_from AND i.l_shipdate < d.eff_to"""
)
def scd2_fact_lookup_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with what their supplier sold in the month before; one supplier has a third of all lines."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr(HOT_SUPPLIER).alias("seller"),
        "l_shipdate",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    sold = items.groupBy(F.col("seller").alias("dim_seller"), month.alias("month")).agg(
        F.count(F.lit(1)).alias("items_before"), F.max("price").alias("top_price")
    )
    dim = sold.select(
        "dim_seller",
        (F.col("month") + F.make_ym_interval(months=F.lit(1))).alias("EFF_FROM"),
        (F.col("month") + F.make_ym_interval(months=F.lit(2))).alias("EFF_TO"),
        "items_before",
        "top_price",
    )
    found = fact_lookup(
        items, stage(dim, "dimension"), [("seller", "dim_seller")], "l_shipdate", how="left", range_rows=10_000
    )
    return found.select("l_orderkey", "l_linenumber", "seller", "price", "items_before", "top_price")


@query(
    f"""{ONE} SELECT row_number() OVER (ORDER BY o_custkey) AS "DIM_KEY", o_custkey, o_orderkey,
       eff_from AS "EFF_FROM" FROM d1"""
)
def scd2_surrogate(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate keys of a first build, in key order."""
    raw = with_audit(orders_until(spark, folder, ORDERS_CUT), LOADED_AT)
    source = scd2_source(raw, KEYS, WATERMARK, LOADED_AT, TRACK, md5_slice)
    changes = scd2_changes(empty_dimension(source, surrogate=True), source, KEYS, LOADED_AT, "b1")
    new = assign_surrogate(changes.where(F.col("_op") == NEW).drop("_op"), KEYS)
    return new.select("DIM_KEY", "o_custkey", "o_orderkey", "EFF_FROM")
