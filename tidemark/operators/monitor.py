"""Questions asked of the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.parity import watermark_text

HISTORY = (
    "INSERTED_AT", "BATCH_ID", "SOURCE_DB", "SOURCE_TABLE", "TARGET_TABLE", "LOAD_TYPE", "ENGINE", "STATUS",
    "FAILED_STEP", "DURATION_SEC", "ROWS_EXTRACTED", "ROWS_RAW", "ROWS_SILVER", "WATERMARK_FROM",
    "WATERMARK_TO", "ERROR_MESSAGE",
)
ERROR_PREFIX = 120


def _hours_before(as_of: object, hours: int) -> Column:
    return ntz(as_of) - F.make_dt_interval(hours=F.lit(hours))


def failed_runs(log: DataFrame, as_of: object, hours: int = 24) -> DataFrame:
    """Runs that failed in the last ``hours``, newest first."""
    return (
        log.where((F.col("STATUS") == "failed") & (F.col("INSERTED_AT") > _hours_before(as_of, hours)))
        .orderBy(F.desc("INSERTED_AT"))
        .select(
            "BATCH_ID", "SOURCE_DB", "SOURCE_TABLE", "TARGET_TABLE", "LOAD_TYPE", "ENGINE", "STATUS",
            "ERROR_MESSAGE", "RUN_START_UTC", "RUN_END_UTC",
        )
    )


def latest_per_table(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ["SOURCE_DB", "TARGET_TABLE"], "INSERTED_AT", tiebreak=["RUN_ID"])


def latest_runs(log: DataFrame) -> DataFrame:
    """The newest run of every table."""
    return (
        latest_per_table(log)
        .select(
            "SOURCE_DB", "TARGET_TABLE", "LOAD_TYPE", "ENGINE", "STATUS", "ROWS_EXTRACTED", "ROWS_RAW",
            "WATERMARK_FROM", "WATERMARK_TO", "RUN_END_UTC",
        )
        .orderBy("SOURCE_DB", "TARGET_TABLE")
    )


def stale_tables(log: DataFrame, as_of: object, hours: int = 24) -> DataFrame:
    """Tables without a successful run in the last ``hours``, never loaded ones first."""
    success = F.max(F.when(F.col("STATUS") == "success", F.col("INSERTED_AT"))).alias("last_success")
    return (
        log.groupBy("SOURCE_DB", "TARGET_TABLE")
        .agg(success)
        .where(F.col("last_success").isNull() | (F.col("last_success") < _hours_before(as_of, hours)))
        .orderBy(F.asc_nulls_first("last_success"), "SOURCE_DB", "TARGET_TABLE")
    )


def error_frequency(log: DataFrame, width: int = ERROR_PREFIX) -> DataFrame:
    """Failures by the start of their message, most frequent first."""
    return (
        log.where((F.col("STATUS") == "failed") & F.col("ERROR_MESSAGE").isNotNull())
        .groupBy(F.left("ERROR_MESSAGE", F.lit(width)).alias("error_prefix"))
        .agg(F.count(F.lit(1)).alias("occurrences"), F.max("INSERTED_AT").alias("last_seen"))
        .orderBy(F.desc("occurrences"), "error_prefix")
    )


def watermark_drift(
    log: DataFrame, raw: DataFrame, source_db: str, target_table: str, watermark: str
) -> DataFrame:
    """Watermark of a table's newest log row beside the newest one in RAW."""
    logged = (
        log.where((F.col("SOURCE_DB") == source_db) & (F.col("TARGET_TABLE") == target_table))
        .orderBy(F.desc("INSERTED_AT"), F.desc("RUN_ID"))
        .limit(1)
        .select(F.col("WATERMARK_TO").alias("logged_wm"), F.lit(None).cast("string").alias("actual_max"))
    )
    actual = raw.agg(watermark_text(raw.schema, watermark).alias("actual_max")).select(
        F.lit(None).cast("string").alias("logged_wm"), "actual_max"
    )
    return (
        logged.unionByName(actual)
        .groupBy()
        .agg(F.max("logged_wm").alias("logged_wm"), F.max("actual_max").alias("actual_max"))
        .select(F.lit(f"{source_db.upper()}.{target_table}").alias("tbl"), "logged_wm", "actual_max")
    )


def history(log: DataFrame, rows: int = 100) -> DataFrame:
    """The newest ``rows`` log entries."""
    return log.orderBy(F.desc("INSERTED_AT"), F.desc("RUN_ID")).limit(rows).select(*HISTORY)


def failure_details(log: DataFrame) -> DataFrame:
    """Every failed run with its step and message."""
    return log.where(F.col("STATUS") == "failed").select(
        "SOURCE_DB",
        "TARGET_TABLE",
        F.coalesce("FAILED_STEP", F.lit("?")).alias("FAILED_STEP"),
        "INSERTED_AT",
        F.coalesce("ERROR_MESSAGE", F.lit("No error message")).alias("ERROR_MESSAGE"),
    )


def status_tally(registry: DataFrame, log: DataFrame) -> DataFrame:
    """Tables by outcome of their newest run and by configuration, in one row.

    ``registry`` has one row per configured table: ``source_db, source_table,
    target_table, load_type, table_type, last_loaded_at, active``.
    """
    newest = latest_per_table(log).select(
        F.col("SOURCE_DB").alias("_db"), F.col("TARGET_TABLE").alias("_table"), F.col("STATUS").alias("_status")
    )
    tables = registry.join(
        newest,
        (F.col("source_db") == F.col("_db")) & (F.col("target_table") == F.col("_table")),
        "left",
    )
    active = F.coalesce(F.col("active"), F.lit(True))

    def tally(test: Column, name: str) -> Column:
        return F.count_if(F.coalesce(test, F.lit(False))).alias(name)

    return tables.agg(
        *[tally(F.col("_status") == s, s) for s in ("success", "failed", "skipped")],
        tally(F.col("_status").isNull(), "pending"),
        tally(active, "active"),
        tally(active & (F.col("load_type") == "full"), "full_load"),
        tally(active & (F.col("load_type") == "incremental"), "incremental_load"),
        tally(active & (F.col("table_type") == "scd2"), "scd2"),
        tally(active & F.col("last_loaded_at").isNull(), "never_loaded"),
        tally(active & (F.col("_status") == "failed"), "active_failed"),
    )
