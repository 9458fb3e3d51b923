"""Configured tables.  A customer stands for one table's entry."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import money, query, table
from tidemark.catalog.log import LOG_SQL, run_log
from tidemark.operators import monitor
from tidemark.operators.keys import minimal_keys
from tidemark.operators.registry import keep_existing, profile_table, replace_entries

REGISTRY_SQL = """registry AS (SELECT 'DB' || cast(c_custkey // 50 AS varchar) AS source_db,
  't' || cast(c_custkey AS varchar) AS source_table, 'T' || cast(c_custkey AS varchar) AS target_table,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'full' ELSE 'incremental' END AS load_type,
  CASE WHEN c_nationkey < 5 THEN 'scd2' ELSE 'silver' END AS table_type,
  CASE WHEN c_acctbal > 0 THEN '2024-01-01 00:00:00' END AS last_loaded_at,
  c_nationkey <> 24 AS active FROM customer)"""
TUNED_SQL = "SELECT * REPLACE ('full' AS load_type) FROM registry WHERE last_loaded_at IS NOT NULL"


def entries(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        F.concat(F.lit("DB"), F.floor(F.col("c_custkey") / 50).cast("string")).alias("source_db"),
        F.concat(F.lit("t"), key).alias("source_table"),
        F.concat(F.lit("T"), key).alias("target_table"),
        F.when(F.col("c_mktsegment") == "BUILDING", "full").otherwise("incremental").alias("load_type"),
        F.when(F.col("c_nationkey") < 5, "scd2").otherwise("silver").alias("table_type"),
        F.when(F.col("c_acctbal") > 0, F.lit("2024-01-01 00:00:00")).alias("last_loaded_at"),
        (F.col("c_nationkey") != 24).alias("active"),
    )


def _tuned(registry: DataFrame) -> DataFrame:
    """Entries already loaded, set to full load by hand."""
    return registry.where(F.col("last_loaded_at").isNotNull()).withColumn("load_type", F.lit("full"))


@query(
    f"""WITH {REGISTRY_SQL}, tuned AS ({TUNED_SQL})
SELECT * FROM tuned UNION ALL SELECT * FROM registry r
WHERE NOT EXISTS (SELECT 1 FROM tuned t WHERE t.source_db = r.source_db AND t.source_table = r.source_table)"""
)
def config_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Newly found tables join the configuration; tuned entries stay."""
    registry = entries(spark, folder)
    return keep_existing(_tuned(registry), registry)


@query(
    f"""WITH {REGISTRY_SQL}, tuned AS ({TUNED_SQL})
SELECT * FROM registry WHERE (source_db, source_table) NOT IN (SELECT (source_db, source_table) FROM tuned)
UNION ALL SELECT * FROM tuned"""
)
def config_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Entries set by hand replace those of the same table."""
    registry = entries(spark, folder)
    return replace_entries(registry, _tuned(registry))


@query(
    f"""WITH {LOG_SQL}, {REGISTRY_SQL},
latest AS (SELECT "SOURCE_DB" AS db, "TARGET_TABLE" AS tbl, "STATUS" AS s FROM log QUALIFY row_number() OVER (
  PARTITION BY "SOURCE_DB", "TARGET_TABLE" ORDER BY "INSERTED_AT" DESC, "RUN_ID" DESC) = 1),
r AS (SELECT registry.*, s FROM registry LEFT JOIN latest ON db = source_db AND tbl = target_table)
SELECT count(*) FILTER (WHERE s = 'success') AS success, count(*) FILTER (WHERE s = 'failed') AS failed,
  count(*) FILTER (WHERE s = 'skipped') AS skipped, count(*) FILTER (WHERE s IS NULL) AS pending,
  count(*) FILTER (WHERE active) AS active, count(*) FILTER (WHERE active AND load_type = 'full') AS full_load,
  count(*) FILTER (WHERE active AND load_type = 'incremental') AS incremental_load,
  count(*) FILTER (WHERE active AND table_type = 'scd2') AS scd2,
  count(*) FILTER (WHERE active AND last_loaded_at IS NULL) AS never_loaded,
  count(*) FILTER (WHERE active AND s = 'failed') AS active_failed FROM r"""
)
def status_tally(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.status_tally(entries(spark, folder), run_log(spark, folder))


def _profile_sql(source: str, keys: str, watermark: str | None, split: str | None) -> str:
    text = "cast({}({}) AS varchar)"
    low, high = (text.format(f, watermark) if watermark else "cast(NULL AS varchar)" for f in ("min", "max"))
    mark = f"'{watermark}'" if watermark else "cast(NULL AS varchar)"
    split = f"CASE WHEN is_key THEN '{split}' END" if split else "cast(NULL AS varchar)"
    return f"""SELECT *, CASE WHEN is_key AND watermark_col IS NOT NULL THEN 'incremental' ELSE 'full' END AS load_type,
  {split} AS partition_col, cast(CASE WHEN {split} IS NULL THEN 1 ELSE 8 END AS bigint) AS partition_num
FROM (SELECT '{keys}' AS candidate_key, count(*) AS row_count, count(DISTINCT row({keys})) AS distinct_keys,
  cast(0 AS bigint) AS null_keys, count(*) = count(DISTINCT row({keys})) AS is_key, {mark} AS watermark_col,
  {low} AS watermark_min, {high} AS watermark_max FROM {source})"""


LINEITEM_KEYS = (["l_orderkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query(
    " UNION ALL ".join(
        [
            _profile_sql("lineitem", ",".join(k), "l_shipdate", k[0] if len(k) == 1 else None)
            for k in LINEITEM_KEYS
        ]
    )
)
def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate keys of a table whose obvious composite key repeats."""
    return profile_table(table(spark, folder, "lineitem"), LINEITEM_KEYS, "l_shipdate")


@query(
    " UNION ALL ".join(
        _profile_sql("events", k, "ts", k) for k in ("event_id", "user_id")
    ),
    name="profile_table",
)
def profile_events(spark: SparkSession, folder: str) -> DataFrame:
    """A real key with a watermark, and a column that is no key."""
    return profile_table(table(spark, folder, "events"), [["event_id"], ["user_id"]], "ts")


@query(
    " UNION ALL ".join(
        _profile_sql("conversations", k, None, "conv_id" if k == "conv_id" else None)
        for k in ("conv_id", "conv_id,turn")
    )
)
def profile_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """A composite key without a watermark: full loads only."""
    return profile_table(table(spark, folder, "conversations"), [["conv_id"], ["conv_id", "turn"]])


LINEITEM_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
    "l_shipdate"
).split()
LINEITEM_MONEY = """(SELECT * REPLACE (cast(l_quantity AS decimal(18,2)) AS l_quantity, cast(l_discount AS decimal(18,2))
  AS l_discount, cast(l_extendedprice AS decimal(18,2)) AS l_extendedprice, cast(l_tax AS decimal(18,2)) AS l_tax)
  FROM lineitem)"""


def _keys_sql(source: str, columns: list[str], most: int) -> str:
    """Every set of columns counted, then those without a smaller key in them."""
    sets = [s for width in range(1, most + 1) for s in combinations(columns, width)]
    counted = " UNION ALL ".join(
        f"SELECT {list(s)} AS c, count(DISTINCT row({', '.join(s)})) AS d, count(*) AS n, "
        f"count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in s)}) AS nulls FROM {source}"
        for s in sets
    )
    return f"""WITH k AS (SELECT c, n FROM ({counted}) WHERE d = n AND nulls = 0 AND n > 0)
SELECT array_to_string(c, ',') AS key_columns, cast(len(c) AS integer) AS width, n AS row_count FROM k
WHERE NOT EXISTS (SELECT 1 FROM k AS part WHERE len(part.c) < len(k.c) AND list_has_all(k.c, part.c))"""


@query(_keys_sql(LINEITEM_MONEY, LINEITEM_COLUMNS, 3))
def keys_of_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of up to three columns, no candidate given, in a table whose obvious key repeats."""
    return minimal_keys(money(table(spark, folder, "lineitem")), 3)


@query(_keys_sql("conversations", ["conv_id", "turn", "role", "text"], 3))
def keys_of_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of a table of texts: what is compared is hashes, however long the values."""
    return minimal_keys(table(spark, folder, "conversations"), 3)
