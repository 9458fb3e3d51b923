"""Snapshots, windows, files and RAW."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog.base import (
    LOADED_AT,
    LOG_AS_OF,
    MERGED_AT,
    ORDERS_CUT,
    ORDERS_OVERLAP,
    audit_sql,
    money,
    orders,
    orders_change,
    orders_raw,
    query,
    table,
)
from tidemark.layers import SourceColumn, conform, target_schema, with_audit
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.drift import apply_drift, detect_drift
from tidemark.operators.merge import replace_raw, upsert_raw
from tidemark.operators.sketch import missing_keys_by_sketch
from tidemark.operators.reconcile import missing_keys, soft_delete
from tidemark.sources.dump import read_dump, write_dump
from tidemark.sources.files import read_by_name, write_delta
from tidemark.sources.ranges import balanced_bounds, range_predicates, reader_of
from tidemark.sources.window import incremental_window, window_bounds
from tidemark.staging import scratch_path, stage

ORDERS_COLUMNS = (
    SourceColumn("o_orderkey", "bigint"),
    SourceColumn("o_custkey", "bigint"),
    SourceColumn("o_orderstatus", "char", length=1),
    SourceColumn("o_totalprice", "decimal", precision=18, scale=2),
    SourceColumn("o_orderdate", "datetime"),
    SourceColumn("o_orderpriority", "varchar", length=15),
)
EVENTS_LOW = "2024-01-15 00:00:00"

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders"""


@query(
    """SELECT event_id, ts, user_id, event_type, cast(value AS decimal(18,2)) AS value, props
FROM events WHERE ts > timestamp '2024-01-15 00:00:00' AND ts <= timestamp '2024-01-30 23:55:00'""",
    name="incremental_window",
)
def window_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """The delta of one run: above the stored watermark, up to five minutes ago."""
    low, high = window_bounds(LOG_AS_OF, EVENTS_LOW)
    return money(incremental_window(table(spark, folder, "events"), "ts", low, high))


@query(
    """SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS",
       cast(o_totalprice AS decimal(18,2)) AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
       o_orderpriority AS "O_ORDERPRIORITY" FROM orders"""
)
def full_snapshot_conform(spark: SparkSession, folder: str) -> DataFrame:
    """A full snapshot in the target's column order, names and types."""
    return conform(table(spark, folder, "orders"), target_schema(ORDERS_COLUMNS))


@query(f"SELECT s.*, {audit_sql(LOADED_AT, 'load-1')} FROM ({ORDERS_SQL}) s")
def raw_replace(spark: SparkSession, folder: str) -> DataFrame:
    """RAW after a full load."""
    return replace_raw(orders(spark, folder), LOADED_AT, "load-1")


@query(
    """SELECT doc_id AS "DOC_ID", text AS "TEXT", lang AS "LANG", source AS "SOURCE", n_chars AS "N_CHARS"
FROM documents"""
)
def dump_read(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts through the dump dialect and back."""
    documents = table(spark, folder, "documents")
    path = scratch_path(spark, "dump")
    write_dump(documents, path)
    schema = T.StructType([T.StructField(f.name.upper(), f.dataType) for f in documents.schema.fields])
    return read_dump(spark, path, schema, pattern="*.txt")


@query(
    """SELECT event_id AS "EVENT_ID", json_extract_string(props, '$.k') AS "K", hex(md5(props)) AS "DIGEST" FROM events"""
)
def dump_read_types(spark: SparkSession, folder: str) -> DataFrame:
    """JSON and bytes through the dump dialect and back: every byte value occurs."""
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("EVENT_ID"),
        F.parse_json("props").alias("PROPS"),
        F.encode(F.md5(F.col("props").cast("binary")), "UTF-8").alias("DIGEST"),
        F.unhex(F.md5(F.col("props").cast("binary"))).alias("BYTES"),
    )
    path = scratch_path(spark, "dump")
    write_dump(events, path)
    back = read_dump(spark, path, events.schema, pattern="*.txt", base64=["DIGEST", "BYTES"])
    same = F.lower(F.hex("BYTES")) == F.decode("DIGEST", "UTF-8")
    digest = F.when(same, F.hex(F.decode("DIGEST", "UTF-8").cast("binary")))
    return back.select("EVENT_ID", F.variant_get("PROPS", "$.k", "string").alias("K"), digest.alias("DIGEST"))


@query(
    """SELECT l_shipdate AS "L_SHIPDATE", l_orderkey AS "L_ORDERKEY", cast(l_linenumber AS bigint) AS "L_LINENUMBER",
       cast(l_extendedprice AS decimal(18,2)) AS "L_EXTENDEDPRICE", cast(NULL AS varchar) AS "L_COMMENT"
FROM lineitem"""
)
def parquet_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Delta files read by name: other order and case, a wider type, a missing column."""
    path = scratch_path(spark, "delta")
    write_delta(table(spark, folder, "lineitem"), path)
    schema = T.StructType(
        [
            T.StructField("L_SHIPDATE", T.TimestampNTZType()),
            T.StructField("L_ORDERKEY", T.LongType()),
            T.StructField("L_LINENUMBER", T.LongType()),
            T.StructField("L_EXTENDEDPRICE", T.DecimalType(18, 2)),
            T.StructField("L_COMMENT", T.StringType()),
        ]
    )
    return read_by_name(spark, path, schema)


@query("SELECT true AS within_limit, count(*) AS row_count FROM lineitem")
def rows_per_file(spark: SparkSession, folder: str) -> DataFrame:
    """A delta split into files of at most 1,000 rows."""
    path = scratch_path(spark, "split")
    items = table(spark, folder, "lineitem")
    write_delta(items, path, rows_per_file=1_000)
    files = read_by_name(spark, path, items.schema, with_file=True).groupBy("_SRC_FILE").count()
    return files.agg((F.max("count") <= 1_000).alias("within_limit"), F.sum("count").alias("row_count"))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity AS decimal(18,2)) AS l_quantity,
                   cast(l_extendedprice AS decimal(18,2)) AS l_extendedprice,
                   cast(l_discount AS decimal(18,2)) AS l_discount, cast(l_tax AS decimal(18,2)) AS l_tax,
                   l_returnflag, l_linestatus, l_shipdate FROM lineitem))
WHERE rn = 1"""
)
def delta_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """One row per composite key, newest first, ties settled by the other columns."""
    return money(latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"))


@query(
    f"""WITH o AS ({ORDERS_SQL}),
t AS (SELECT * FROM o WHERE o_orderdate <= timestamp '{ORDERS_CUT}'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice + 1 AS decimal(18,2)) AS o_totalprice,
             o_orderdate, o_orderpriority FROM o WHERE o_orderdate > timestamp '{ORDERS_OVERLAP}')
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
       CASE WHEN t.o_orderkey IS NULL THEN timestamp '{MERGED_AT}' ELSE timestamp '{LOADED_AT}' END AS "_LOAD_TS",
       cast(NULL AS varchar) AS "_SRC_FILE",
       CASE WHEN t.o_orderkey IS NULL THEN 'load-2' ELSE 'load-1' END AS "_BATCH_ID",
       false AS "_IS_DELETED", cast(NULL AS timestamp) AS "_DELETED_AT"
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""
)
def raw_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Matched, inserted and untouched RAW rows of one incremental load."""
    delta = stage(latest_per_key(orders_change(spark, folder), ["o_orderkey"], "o_orderdate"), "delta")
    return upsert_raw(orders_raw(spark, folder), delta, ["o_orderkey"], MERGED_AT, "load-2")


@query(
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        cast(l_quantity AS decimal(18,2)) AS l_quantity, l_shipdate FROM lineitem),
t AS (SELECT * FROM l WHERE l_shipdate <= timestamp '{ORDERS_CUT}'),
d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity + 1 AS decimal(18,2)) AS l_quantity,
             l_shipdate,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
      FROM l WHERE l_shipdate > timestamp '{ORDERS_OVERLAP}'),
s AS (SELECT * FROM d WHERE rn = 1)
SELECT t.l_orderkey, t.l_linenumber, coalesce(s.l_partkey, t.l_partkey) AS l_partkey,
       coalesce(s.l_suppkey, t.l_suppkey) AS l_suppkey, coalesce(s.l_quantity, t.l_quantity) AS l_quantity,
       coalesce(s.l_shipdate, t.l_shipdate) AS l_shipdate, {audit_sql(LOADED_AT, 'load-1')}
FROM t LEFT JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, {audit_sql(MERGED_AT, 'load-2')}
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)"""
)
def raw_upsert_composite(spark: SparkSession, folder: str) -> DataFrame:
    """A composite key that RAW holds more than once: every copy is updated."""
    items = money(table(spark, folder, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    keys = ["l_orderkey", "l_linenumber"]
    raw = with_audit(incremental_window(items, "l_shipdate", None, ORDERS_CUT), LOADED_AT, "load-1")
    change = incremental_window(items, "l_shipdate", ORDERS_OVERLAP, None).withColumn(
        "l_quantity", (F.col("l_quantity") + 1).cast("decimal(18,2)")
    )
    delta = stage(latest_per_key(change, keys, "l_shipdate"), "delta")
    return upsert_raw(raw, delta, keys, MERGED_AT, "load-2")


# An order whose lines are all gone counts as deleted at the source.
def _surviving(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))


@query(
    """SELECT o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def reconcile_missing_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Live RAW keys the source no longer has."""
    raw = with_audit(table(spark, folder, "orders"), LOADED_AT)
    return missing_keys(raw, _surviving(spark, folder), ["o_orderkey"])


@query(
    """WITH k AS (SELECT 'K-' || o_orderkey AS code, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey, o_orderkey FROM orders)
SELECT code, o_custkey FROM k WHERE o_orderkey % 251 = 0 UNION ALL SELECT NULL, NULL"""
)
def reconcile_by_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Vanished keys of text and numbers, NULLs among them; the source has keys of its own too."""
    key = F.col("o_orderkey")
    customer = F.when(key % 5 != 0, F.col("o_custkey")).alias("o_custkey")
    have = table(spark, folder, "orders").select(F.concat(F.lit("K-"), key).alias("code"), customer, "o_orderkey")
    nobody = spark.range(1).select(F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("o_custkey"))
    raw = with_audit(have.drop("o_orderkey").unionByName(nobody), LOADED_AT)
    new = have.where(key % 241 == 0).withColumn("code", F.concat(F.lit("N-"), key))
    source = have.where(key % 251 != 0).unionByName(new)
    return missing_keys_by_sketch(raw, source, ["code", "o_custkey"])


@query(
    f"""SELECT o.*, timestamp '{LOADED_AT}' AS "_LOAD_TS", cast(NULL AS varchar) AS "_SRC_FILE", 'load-1' AS "_BATCH_ID",
       l.l_orderkey IS NULL AS "_IS_DELETED",
       CASE WHEN l.l_orderkey IS NULL THEN timestamp '{MERGED_AT}' END AS "_DELETED_AT"
FROM ({ORDERS_SQL}) o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON o.o_orderkey = l.l_orderkey"""
)
def reconcile_soft_delete(spark: SparkSession, folder: str) -> DataFrame:
    """RAW with the vanished keys flagged."""
    raw = with_audit(orders(spark, folder), LOADED_AT, "load-1")
    missing = stage(missing_keys(raw, _surviving(spark, folder), ["o_orderkey"]), "missing")
    return soft_delete(raw, missing, ["o_orderkey"], MERGED_AT)


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       cast(NULL AS varchar) AS "O_ORDERPRIORITY", {audit_sql(LOADED_AT, 'load-1')}
FROM ({ORDERS_SQL})"""
)
def drift_add_column(spark: SparkSession, folder: str) -> DataFrame:
    """RAW rows after the source gained a column."""
    source = orders(spark, folder)
    raw = with_audit(source.drop("o_orderpriority"), LOADED_AT, "load-1")
    return apply_drift(raw, detect_drift(source.schema, raw.schema))


@query(
    """SELECT 'O_ORDERPRIORITY' AS column_name, 'added' AS change, count(o_orderpriority) AS populated_rows FROM orders
UNION ALL
SELECT 'O_YEAR', 'dropped', count(o_orderdate) FROM orders"""
)
def drift_report(spark: SparkSession, folder: str) -> DataFrame:
    """Added and dropped columns, with the rows that hold a value in them."""
    source = orders(spark, folder)
    raw = with_audit(source.drop("o_orderpriority").withColumn("o_year", F.year("o_orderdate")), LOADED_AT)
    drift = detect_drift(source.schema, raw.schema)
    lines = [
        df.agg(F.count(F.col(name)).alias("populated_rows")).select(
            F.lit(name).alias("column_name"), F.lit(change).alias("change"), "populated_rows"
        )
        for change, df, names in (("added", source, drift.added_names), ("dropped", raw, drift.dropped))
        for name in names
    ]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


READERS = 8
SKEWED = "l_orderkey * l_orderkey"


@query(
    f"""SELECT cast({READERS} AS bigint) AS readers, count(*) AS row_count, sum({SKEWED})::decimal(38,0) AS key_sum,
  true AS met_by_one, true AS balanced FROM lineitem"""
)
def balanced_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A skewed column dealt to eight readers: each row meets one reader's condition, none has 1.5 times the mean."""
    lines = table(spark, folder, "lineitem").select(F.expr(SKEWED).alias("k"))
    bounds = balanced_bounds(lines, "k", READERS)
    met = sum((F.expr(p).cast("int") for p in range_predicates("k", bounds)), F.lit(0))
    readers = lines.groupBy(reader_of("k", bounds).alias("reader")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("k").cast("decimal(28,0)")).alias("s"),
        F.min(met).alias("least"), F.max(met).alias("most"),
    )
    return readers.agg(
        F.count(F.lit(1)).alias("readers"),
        F.sum("n").alias("row_count"),
        F.sum("s").cast("decimal(38,0)").alias("key_sum"),
        ((F.min("least") == 1) & (F.max("most") == 1)).alias("met_by_one"),
        (F.max("n") * READERS <= F.sum("n") * 1.5).alias("balanced"),
    )
