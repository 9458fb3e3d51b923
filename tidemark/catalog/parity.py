"""Source against target: counts, watermarks, fingerprints, boards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import (
    LOADED_AT,
    MERGED_AT,
    ORDERS_CUT,
    flagged,
    money,
    orders,
    orders_raw,
    orders_until,
    query,
    table,
)
from tidemark.catalog.dimensions import KEYS, TWO, WATERMARK
from tidemark.catalog.dimensions import _two as two_batches
from tidemark.layers import live, with_audit
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.difference import differing_keys
from tidemark.operators.parity import (
    BoardEntry,
    board_totals,
    count_board,
    fingerprint,
    layer_counts,
    max_watermark,
    parity_board,
    parity_report,
)
from tidemark.operators.silver import build_silver

CUT_SQL = f"o_orderdate <= timestamp '{ORDERS_CUT}'"


def _row_text(*columns: str) -> str:
    return " || '~|~' || ".join(f"coalesce({c}, '~N~')" for c in columns)


def _slice(text: str) -> str:
    return f"cast('0x' || substr(md5({text}), 1, 15) AS bigint)"


ORDERS_TEXT = _row_text(
    "cast(o_orderkey AS varchar)",
    "cast(o_custkey AS varchar)",
    "o_orderstatus",
    "cast(cast(o_totalprice AS decimal(18,2)) AS varchar)",
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "o_orderpriority",
)
LINEITEM_TEXT = _row_text(
    *[f"cast({c} AS varchar)" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
    *[
        f"cast(cast({c} AS decimal(18,2)) AS varchar)"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ],
    "l_returnflag",
    "l_linestatus",
    "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
)


@query(
    f"""SELECT source, raw_live, source - raw_live AS delta, source = raw_live AS count_ok
FROM (SELECT count(*) AS source, count(*) FILTER (WHERE {CUT_SQL}) AS raw_live FROM orders)"""
)
def parity_count(spark: SparkSession, folder: str) -> DataFrame:
    """A RAW that lags behind its source."""
    report = parity_report(orders(spark, folder), orders_raw(spark, folder))
    return report.select("source", "raw_live", "delta", "count_ok")


@query(
    f"""SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS source_wm,
  strftime(max(o_orderdate) FILTER (WHERE {CUT_SQL}), '%Y-%m-%d %H:%M:%S') AS raw_wm,
  max(o_orderdate) = max(o_orderdate) FILTER (WHERE {CUT_SQL}) AS wm_ok FROM orders"""
)
def parity_watermark(spark: SparkSession, folder: str) -> DataFrame:
    report = parity_report(orders(spark, folder), orders_raw(spark, folder), watermark="o_orderdate")
    return report.select("source_wm", "raw_wm", "wm_ok")


@query(
    f"""SELECT count(*) AS "rows", bit_xor(h) AS hash_xor, cast(sum(cast(h AS decimal(28,0))) AS decimal(38,0)) AS hash_sum
FROM (SELECT {_slice(LINEITEM_TEXT)} AS h FROM lineitem)"""
)
def parity_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint(money(table(spark, folder, "lineitem")))


@query(
    f"""WITH s AS (SELECT *, {_slice(ORDERS_TEXT)} AS h FROM orders),
a AS (SELECT count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS wm, bit_xor(h) AS x FROM s),
b AS (SELECT count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS wm, bit_xor(h) AS x FROM s
      WHERE o_orderstatus <> 'F'),
t AS (SELECT count(DISTINCT o_custkey) AS n FROM s WHERE o_orderstatus <> 'F')
SELECT a.n AS source, b.n AS raw_live, t.n AS target, 'SILVER' AS target_layer, a.n = b.n AS count_ok,
  a.n - b.n AS delta, true AS has_wm, a.wm AS source_wm, b.wm AS raw_wm, a.wm = b.wm AS wm_ok, true AS deep,
  a.x AS source_hash, b.x AS raw_hash, a.x = b.x AS hash_ok, a.n = b.n AND a.wm = b.wm AND a.x = b.x AS ok
FROM a, b, t"""
)
def parity_report_deep(spark: SparkSession, folder: str) -> DataFrame:
    """Everything at once; RAW has soft-deleted rows the source still holds."""
    source = orders(spark, folder)
    raw = flagged(source, F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    silver = latest_per_key(live(raw).select(*source.columns), ["o_custkey"], "o_orderdate")
    return parity_report(source, raw, silver, "o_orderdate", deep=True)


@query(
    f"""{TWO}, s AS (SELECT count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS wm FROM orders)
SELECT s.n AS source, s.n AS raw_live, (SELECT count(*) FROM d2 WHERE cur) AS target,
  'SCD2 (current)' AS target_layer, true AS count_ok, cast(0 AS bigint) AS delta, true AS has_wm, s.wm AS source_wm,
  s.wm AS raw_wm, true AS wm_ok, false AS deep, cast(NULL AS bigint) AS source_hash, cast(NULL AS bigint) AS raw_hash,
  true AS hash_ok, true AS ok FROM s""",
    name="parity_report",
)
def parity_report_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A table in step, with a dimension as its target."""
    source = orders(spark, folder)
    return parity_report(source, with_audit(source, LOADED_AT), two_batches(spark, folder), "o_orderdate", scd2=True)


@query("SELECT cast(max(ts) AS varchar) AS max_watermark FROM events")
def raw_max_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """The value the next window starts from."""
    return max_watermark(with_audit(table(spark, folder, "events"), LOADED_AT), "ts")


def _entries(spark: SparkSession, folder: str) -> list[BoardEntry]:
    source = orders(spark, folder)
    flagged_raw = flagged(source, F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    events, items = table(spark, folder, "events"), table(spark, folder, "lineitem")
    events_raw, items_raw = with_audit(events, LOADED_AT), with_audit(items, LOADED_AT)
    return [
        BoardEntry("shop.orders", flagged_raw, build_silver(None, flagged_raw, ["o_custkey"], "o_orderdate"), source),
        BoardEntry("shop.lineitem", items_raw, build_silver(None, items_raw, []), items),
        BoardEntry("web.events", events_raw, build_silver(None, events_raw, ["user_id"], "ts"), events),
        BoardEntry(
            "crm.customer_order",
            with_audit(orders_until(spark, folder, ORDERS_CUT), MERGED_AT),
            two_batches(spark, folder),
            source,
            scd2=True,
        ),
        BoardEntry("web.documents", None, None, table(spark, folder, "documents")),
    ]


BOARD_SQL = f"""{TWO}, lo AS (SELECT * FROM orders QUALIFY
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
counts(table_name, target_layer, source_rows, raw_all, raw_live, target_rows) AS (
  SELECT 'shop.orders', 'SILVER', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders),
         (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F'), (SELECT count(*) FROM lo WHERE o_orderstatus <> 'F')
  UNION ALL SELECT 'shop.lineitem', 'SILVER', count(*), count(*), count(*), count(*) FROM lineitem
  UNION ALL SELECT 'web.events', 'SILVER', count(*), count(*), count(*), count(DISTINCT user_id) FROM events
  UNION ALL SELECT 'crm.customer_order', 'SCD2 (current)', count(*), count(*) FILTER (WHERE {CUT_SQL}),
         count(*) FILTER (WHERE {CUT_SQL}), (SELECT count(*) FROM d2 WHERE cur) FROM orders
  UNION ALL SELECT 'web.documents', 'SILVER', count(*), NULL, NULL, NULL FROM documents)"""
COUNT_BOARD_SQL = f"""{BOARD_SQL} SELECT table_name, target_layer, raw_all AS raw_rows, target_rows,
  CASE WHEN raw_all = target_rows THEN 'ok' WHEN raw_all <> target_rows THEN 'differs' END AS match
FROM counts WHERE table_name <> 'web.documents'"""
PARITY_BOARD_SQL = f"""{BOARD_SQL} SELECT table_name, target_layer, source_rows, raw_live AS raw_rows, target_rows,
  source_rows - raw_live AS delta,
  CASE WHEN source_rows = raw_live THEN 'ok' WHEN source_rows <> raw_live THEN 'differs' END AS parity FROM counts"""


def _readable(spark: SparkSession, folder: str) -> list[BoardEntry]:
    return [e for e in _entries(spark, folder) if e.raw is not None]


@query(COUNT_BOARD_SQL, name="count_board")
def board_of_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_board(_readable(spark, folder))


@query(PARITY_BOARD_SQL, name="parity_board")
def board_of_parity(spark: SparkSession, folder: str) -> DataFrame:
    """Includes a table that was never loaded."""
    return parity_board(_entries(spark, folder))


@query(
    f"""SELECT cast(sum(coalesce(source_rows, 0)) AS bigint) AS total_source_rows,
  cast(sum(coalesce(raw_rows, 0)) AS bigint) AS total_raw_rows,
  cast(sum(coalesce(target_rows, 0)) AS bigint) AS total_target_rows,
  count(*) FILTER (WHERE parity = 'ok') AS matched, count(*) FILTER (WHERE parity = 'differs') AS mismatched
FROM ({PARITY_BOARD_SQL})""",
    name="board_totals",
)
def totals_of_parity(spark: SparkSession, folder: str) -> DataFrame:
    return board_totals(parity_board(_entries(spark, folder)), "parity")


@query(
    """WITH c(raw_schema, table_name, raw_rows, silver_rows) AS (
  SELECT 'SHOP_RAW', 'ORDERS', count(*), count(DISTINCT o_custkey) FROM orders
  UNION ALL SELECT 'SHOP_RAW', 'LINEITEM', count(*), count(DISTINCT row(l_orderkey, l_linenumber)) FROM lineitem
  UNION ALL SELECT 'WEB_RAW', 'DOCUMENTS', count(*), cast(0 AS bigint) FROM documents)
SELECT *, raw_rows - silver_rows AS dedupe_diff,
  CASE WHEN raw_rows > 0 AND silver_rows = 0 THEN 'CHECK: SILVER empty' END AS flag FROM c""",
    name="layer_counts",
)
def layer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """RAW beside SILVER; one SILVER build did not populate."""
    order, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    documents = table(spark, folder, "documents")
    stored = [
        ("SHOP_RAW", "ORDERS", order),
        ("SHOP_SILVER", "ORDERS", latest_per_key(order, KEYS, WATERMARK)),
        ("SHOP_RAW", "LINEITEM", items),
        ("SHOP_SILVER", "LINEITEM", latest_per_key(items, ["l_orderkey", "l_linenumber"], "l_shipdate")),
        ("WEB_RAW", "DOCUMENTS", documents),
        ("WEB_SILVER", "DOCUMENTS", documents.where(F.lit(False))),
    ]
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "row_count"
        )
        for schema, name, df in stored
    ]
    tables = counted[0]
    for one in counted[1:]:
        tables = tables.unionByName(one)
    return layer_counts(tables)


@query(
    """SELECT o_orderkey, 'only_left' AS difference, 1 AS left_rows, 0 AS right_rows FROM orders WHERE o_orderkey % 101 = 0
UNION ALL SELECT o_orderkey, 'changed', 1, 1 FROM orders WHERE o_orderkey % 97 = 0 AND o_orderkey % 101 <> 0
UNION ALL SELECT o_orderkey + 100000000, 'only_right', 0, 1 FROM orders WHERE o_orderkey % 103 = 0""".replace(
        "1 AS left_rows, 0 AS right_rows", "1::bigint AS left_rows, 0::bigint AS right_rows"
    )
)
def parity_differing_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Which keys two versions of a table differ in: gone, changed and new orders."""
    before = orders(spark, folder)
    key = F.col("o_orderkey")
    price = F.when(key % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast("decimal(18,2)")
    after = before.where(key % 101 != 0).withColumn("o_totalprice", price)
    new = before.where(key % 103 == 0).withColumn("o_orderkey", key + 100_000_000)
    return differing_keys(before, after.unionByName(new), ["o_orderkey"], few_rows=1_000)
