"""The run log.  Events stand for runs: a user is a table, an event type a status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import LOG_AS_OF, orders, query, table
from tidemark.functions import second_text
from tidemark.layers import RUN_LOG_SCHEMA, conform
from tidemark.operators import monitor

LOG_SQL = """log AS (SELECT 'R' || lpad(cast(event_id AS varchar), 12, '0') AS "RUN_ID",
  strftime(ts, 'B%Y%m%d') AS "BATCH_ID", 'DB' || cast(user_id // 50 AS varchar) AS "SOURCE_DB",
  't' || cast(user_id AS varchar) AS "SOURCE_TABLE", 'T' || cast(user_id AS varchar) AS "TARGET_TABLE",
  CASE event_type WHEN 'signup' THEN 'validate' WHEN 'click' THEN 'full' ELSE 'incremental' END AS "LOAD_TYPE",
  CASE event_type WHEN 'signup' THEN 'parity' WHEN 'click' THEN 'snapshot' ELSE 'window' END AS "ENGINE",
  cast(json_extract_string(props, '$.k') AS bigint) AS "ROWS_EXTRACTED",
  cast(json_extract_string(props, '$.k') AS bigint) AS "ROWS_RAW",
  cast(NULL AS bigint) AS "ROWS_SILVER", strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS "WATERMARK_FROM",
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "WATERMARK_TO",
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' WHEN 'signup' THEN 'mismatch'
       ELSE 'success' END AS "STATUS",
  CASE WHEN event_type = 'error' THEN 'engine said ' || props END AS "ERROR_MESSAGE",
  CASE WHEN event_type = 'error' AND value > 10 THEN 'merge' END AS "FAILED_STEP",
  cast(value AS decimal(38,2)) AS "DURATION_SEC", ts AS "RUN_START_UTC",
  ts + INTERVAL 1 MINUTE AS "RUN_END_UTC", ts AS "INSERTED_AT" FROM events)"""

AS_OF_SQL = f"timestamp '{LOG_AS_OF}'"


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    kind, user = F.col("event_type"), F.col("user_id")
    rows = F.get_json_object("props", "$.k").cast("long")

    def by_kind(default: str, **values: str):
        out = None
        for name, value in values.items():
            out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
        return out.otherwise(default)

    return conform(
        events.select(
            F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("RUN_ID"),
            F.concat(F.lit("B"), F.replace(F.to_date("ts").cast("string"), F.lit("-"), F.lit(""))).alias("BATCH_ID"),
            F.concat(F.lit("DB"), F.floor(user / 50).cast("string")).alias("SOURCE_DB"),
            F.concat(F.lit("t"), user.cast("string")).alias("SOURCE_TABLE"),
            F.concat(F.lit("T"), user.cast("string")).alias("TARGET_TABLE"),
            by_kind("incremental", signup="validate", click="full").alias("LOAD_TYPE"),
            by_kind("window", signup="parity", click="snapshot").alias("ENGINE"),
            rows.alias("ROWS_EXTRACTED"),
            rows.alias("ROWS_RAW"),
            second_text(F.to_date("ts").cast("timestamp_ntz")).alias("WATERMARK_FROM"),
            second_text(F.col("ts")).alias("WATERMARK_TO"),
            by_kind("success", error="failed", view="skipped", signup="mismatch").alias("STATUS"),
            F.when(kind == "error", F.concat(F.lit("engine said "), "props")).alias("ERROR_MESSAGE"),
            F.when((kind == "error") & (F.col("value") > 10), F.lit("merge")).alias("FAILED_STEP"),
            F.col("value").alias("DURATION_SEC"),
            F.col("ts").alias("RUN_START_UTC"),
            (F.col("ts") + F.make_dt_interval(mins=F.lit(1))).alias("RUN_END_UTC"),
            F.col("ts").alias("INSERTED_AT"),
        ),
        RUN_LOG_SCHEMA,
    )


@query(
    f"""WITH {LOG_SQL} SELECT "BATCH_ID", "SOURCE_DB", "SOURCE_TABLE", "TARGET_TABLE", "LOAD_TYPE", "ENGINE", "STATUS",
  "ERROR_MESSAGE", "RUN_START_UTC", "RUN_END_UTC" FROM log
WHERE "STATUS" = 'failed' AND "INSERTED_AT" > {AS_OF_SQL} - INTERVAL 24 HOUR ORDER BY "INSERTED_AT" DESC"""
)
def failed_runs(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.failed_runs(run_log(spark, folder), LOG_AS_OF)


@query(
    f"""WITH {LOG_SQL} SELECT "SOURCE_DB", "TARGET_TABLE", "LOAD_TYPE", "ENGINE", "STATUS", "ROWS_EXTRACTED", "ROWS_RAW",
  "WATERMARK_FROM", "WATERMARK_TO", "RUN_END_UTC" FROM log
QUALIFY row_number() OVER (PARTITION BY "SOURCE_DB", "TARGET_TABLE" ORDER BY "INSERTED_AT" DESC, "RUN_ID" DESC) = 1
ORDER BY "SOURCE_DB", "TARGET_TABLE\""""
)
def latest_runs(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.latest_runs(run_log(spark, folder))


@query(
    f"""WITH {LOG_SQL} SELECT "SOURCE_DB", "TARGET_TABLE",
  max("INSERTED_AT") FILTER (WHERE "STATUS" = 'success') AS last_success FROM log
GROUP BY ALL HAVING last_success IS NULL OR last_success < {AS_OF_SQL} - INTERVAL 24 HOUR
ORDER BY last_success NULLS FIRST"""
)
def stale_tables(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.stale_tables(run_log(spark, folder), LOG_AS_OF)


@query(
    f"""WITH {LOG_SQL} SELECT left("ERROR_MESSAGE", 120) AS error_prefix, count(*) AS occurrences,
  max("INSERTED_AT") AS last_seen FROM log WHERE "STATUS" = 'failed' AND "ERROR_MESSAGE" IS NOT NULL
GROUP BY 1 ORDER BY occurrences DESC"""
)
def error_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.error_frequency(run_log(spark, folder))


@query(
    f"""WITH {LOG_SQL} SELECT 'DB0.T8' AS tbl,
  (SELECT "WATERMARK_TO" FROM log WHERE "SOURCE_DB" = 'DB0' AND "TARGET_TABLE" = 'T8'
   ORDER BY "INSERTED_AT" DESC, "RUN_ID" DESC LIMIT 1) AS logged_wm,
  (SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders) AS actual_max"""
)
def watermark_drift(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.watermark_drift(run_log(spark, folder), orders(spark, folder), "DB0", "T8", "o_orderdate")


@query(
    f"""WITH {LOG_SQL} SELECT {", ".join(f'"{c}"' for c in monitor.HISTORY)} FROM log
ORDER BY "INSERTED_AT" DESC, "RUN_ID" DESC LIMIT 100"""
)
def run_history(spark: SparkSession, folder: str) -> DataFrame:
    """The history page: the newest hundred runs."""
    return monitor.history(run_log(spark, folder), 100)


@query(
    f"""WITH {LOG_SQL} SELECT "SOURCE_DB", "TARGET_TABLE", coalesce("FAILED_STEP", '?') AS "FAILED_STEP", "INSERTED_AT",
  coalesce("ERROR_MESSAGE", 'No error message') AS "ERROR_MESSAGE" FROM log WHERE "STATUS" = 'failed'"""
)
def failure_details(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.failure_details(run_log(spark, folder))
