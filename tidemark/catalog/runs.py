"""Whole runs against a table store in the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import ORDERS_CUT, orders, orders_until, query, shown, table
from tidemark.plans.store import TableStore
from tidemark.plans.sync import RunResult, Sync
from tidemark.spec import INCREMENTAL, SCD2, TableSpec
from tidemark.staging import scratch_path

ORDERS = TableSpec(
    source_db="shop",
    source_table="orders",
    target_table="ORDERS",
    keys=("O_CUSTKEY",),
    load_type=INCREMENTAL,
    watermark_col="O_ORDERDATE",
    buckets=8,
    reconcile=True,
)
DIMENSION = ORDERS.with_(
    target_table="CUSTOMER_ORDER", table_type=SCD2, track_columns=("O_ORDERSTATUS", "O_ORDERPRIORITY")
)
UPPER = """o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS",
  cast(o_totalprice AS decimal(18,2)) AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
  o_orderpriority AS "O_ORDERPRIORITY\""""


def _runner(spark: SparkSession, current: dict[str, DataFrame], when: list[datetime]) -> Sync:
    """A sync whose source and clock the query moves on by hand."""
    store = TableStore(spark, scratch_path(spark, "store"))
    return Sync(spark, store, lambda spec: current["now"], clock=lambda: when[-1])


def _must(result: RunResult) -> None:
    for record in result.records:
        if record["STATUS"] == "failed":
            raise RuntimeError(f"{record['FAILED_STEP']}: {record['ERROR_MESSAGE']}")


def _two_loads(spark: SparkSession, folder: str, spec: TableSpec) -> tuple[Sync, Callable[[DataFrame], None]]:
    """A full seed up to the cut, then one incremental run over the rest."""
    current = {"now": orders_until(spark, folder, ORDERS_CUT)}
    when = [datetime(2024, 2, 1, 3)]
    runner = _runner(spark, current, when)
    _must(runner.run([spec]))
    current["now"] = orders(spark, folder)
    when.append(datetime(2024, 2, 2, 3))
    _must(runner.run([spec]))
    when.append(datetime(2024, 2, 3, 3))
    return runner, lambda df: current.__setitem__("now", df)


@query(
    f"""SELECT {UPPER} FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def sync_full_then_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """SILVER after the seed and one delta."""
    runner, _ = _two_loads(spark, folder, ORDERS)
    return runner.target(ORDERS)


@query(
    f"""WITH a AS (SELECT * FROM orders WHERE o_orderdate <= timestamp '{ORDERS_CUT}' QUALIFY
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
b AS (SELECT * FROM orders QUALIFY
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
changed AS (SELECT b.* FROM b LEFT JOIN a ON a.o_custkey = b.o_custkey
  WHERE a.o_custkey IS NULL OR a.o_orderstatus <> b.o_orderstatus OR a.o_orderpriority <> b.o_orderpriority),
versions AS (
  SELECT row_number() OVER (ORDER BY o_custkey) AS "DIM_KEY", a.*,
         (SELECT c.o_orderdate FROM changed c WHERE c.o_custkey = a.o_custkey) AS closed_at FROM a
  UNION ALL
  SELECT (SELECT count(*) FROM a) + row_number() OVER (ORDER BY o_custkey), changed.*, NULL FROM changed)
SELECT "DIM_KEY", {UPPER}, o_orderdate AS "EFF_FROM",
  coalesce(strftime(closed_at, '%Y-%m-%d %H:%M:%S'), '9999-12-31 00:00:00') AS "EFF_TO",
  closed_at IS NULL AS "IS_CURRENT", false AS "IS_DELETED" FROM versions"""
)
def sync_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension with surrogate keys after the seed and one delta."""
    runner, _ = _two_loads(spark, folder, DIMENSION)
    dim = runner.target(DIMENSION).drop("ROW_HASH", "_LOAD_TS", "_BATCH_ID")
    return shown(dim)


@query(
    f"""SELECT {UPPER} FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def sync_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """SILVER after orders without lines vanished at the source."""
    spec = ORDERS.with_(keys=("O_ORDERKEY",))
    runner, set_source = _two_loads(spark, folder, spec)
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    set_source(orders(spark, folder).join(lines, "o_orderkey", "left_semi"))
    _must(runner.reconcile([spec]))
    return runner.target(spec)


class _BrokenOnce(Sync):
    """A sync whose next target build fails after RAW was committed."""

    broken = False

    def _build_target(self, *args, **options):
        if self.broken:
            self.broken = False
            raise RuntimeError("stopped on purpose")
        return super()._build_target(*args, **options)


@query(
    f"""SELECT * REPLACE (cast("O_TOTALPRICE" + 1 AS decimal(18,2)) AS "O_TOTALPRICE") FROM (SELECT {UPPER} FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
)
def sync_after_failed_build(spark: SparkSession, folder: str) -> DataFrame:
    """SILVER after a forced full load whose build failed and an incremental run."""
    current = {"now": orders_until(spark, folder, ORDERS_CUT)}
    when = [datetime(2024, 2, 1, 3)]
    store = TableStore(spark, scratch_path(spark, "store"))
    runner = _BrokenOnce(spark, store, lambda spec: current["now"], clock=lambda: when[-1])
    _must(runner.run([ORDERS]))
    raised = (F.col("o_totalprice") + 1).cast("decimal(18,2)")
    current["now"] = orders(spark, folder).withColumn("o_totalprice", raised)
    runner.broken = True
    runner.run([ORDERS], force_full=True)
    _must(runner.run([ORDERS]))
    return runner.target(ORDERS)


@query(
    f"""SELECT {UPPER} FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def sync_reconcile_after_failed_build(spark: SparkSession, folder: str) -> DataFrame:
    """SILVER after a reconciliation whose build failed and one that finds nothing more to delete."""
    spec = ORDERS.with_(keys=("O_ORDERKEY",))
    current = {"now": orders(spark, folder)}
    store = TableStore(spark, scratch_path(spark, "store"))
    runner = _BrokenOnce(spark, store, lambda spec: current["now"], clock=lambda: datetime(2024, 2, 1, 3))
    _must(runner.run([spec]))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    current["now"] = orders(spark, folder).join(lines, "o_orderkey", "left_semi")
    runner.broken = True
    runner.reconcile([spec])
    _must(runner.reconcile([spec]))
    return runner.target(spec)


@query(
    """SELECT o_orderkey AS "O_ORDERKEY", o_orderdate + to_hours(o_orderkey % 24) AS "CHANGED" FROM orders"""
)
def sync_source_clock(spark: SparkSession, folder: str) -> DataFrame:
    """A source eight hours behind UTC whose open transactions show up late: windows end by its clock, so no row is lost."""
    spec = ORDERS.with_(keys=("O_ORDERKEY",), watermark_col="CHANGED", last_loaded_at="1990-01-01 00:00:00")
    hours = F.make_dt_interval(hours=F.pmod(F.col("o_orderkey"), F.lit(24)).cast("int"))
    everything = orders(spark, folder).select("o_orderkey", (F.col("o_orderdate") + hours).alias("changed"))
    source_now = [datetime(1998, 6, 1, 12), datetime(2024, 2, 1)]
    # Half of what changed in the last four hours before the first run's clock is not committed yet.
    late = (F.col("changed") > F.lit("1998-06-01 08:00:00").cast("timestamp_ntz")) & (F.col("o_orderkey") % 2 == 0)
    seen = everything.where(F.col("changed") <= F.lit("1998-06-01 12:00:00").cast("timestamp_ntz")).where(~late)
    current, at = {"now": seen.limit(0)}, [0]
    store = TableStore(spark, scratch_path(spark, "store"))
    runner = Sync(
        spark,
        store,
        lambda spec: current["now"],
        clock=lambda: source_now[at[0]] + timedelta(hours=8),
        lag_minutes=240,
        ceiling=lambda spec: source_now[at[0]],
    )
    _must(runner.run([spec]))  # an empty source seeds the table
    current["now"] = seen
    _must(runner.run([spec]))
    current["now"], at[0] = everything, 1
    _must(runner.run([spec]))
    return runner.target(spec)


@query(
    f"""SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderdate AS "O_ORDERDATE",
  CASE WHEN o_orderdate <= timestamp '{ORDERS_CUT}' THEN o_orderstatus END AS "O_ORDERSTATUS",
  CASE WHEN o_orderdate > timestamp '{ORDERS_CUT}' THEN o_orderpriority END AS "O_ORDERPRIORITY" FROM orders"""
)
def sync_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Between two loads a column widens, one appears and one goes."""
    spec = ORDERS.with_(keys=("O_ORDERKEY",))
    narrow = orders_until(spark, folder, ORDERS_CUT).select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderdate", "o_orderstatus"
    )
    current = {"now": narrow}
    when = [datetime(2024, 2, 1, 3)]
    runner = _runner(spark, current, when)
    _must(runner.run([spec]))
    wide = F.col("o_custkey").cast("bigint").alias("o_custkey")
    current["now"] = orders(spark, folder).select("o_orderkey", wide, "o_orderdate", "o_orderpriority")
    when.append(datetime(2024, 2, 2, 3))
    _must(runner.run([spec]))
    return runner.target(spec)


@query(
    """SELECT * FROM (VALUES ('full', 'success'), ('incremental', 'success'), ('validate', 'success'),
  ('incremental', 'skipped')) AS r("LOAD_TYPE", "STATUS")
CROSS JOIN (SELECT 'shop' AS "SOURCE_DB", 'orders' AS "SOURCE_TABLE", 'ORDERS' AS "TARGET_TABLE")
JOIN (SELECT 'full' AS "LOAD_TYPE", 'success' AS "STATUS", count(*) AS "ROWS_RAW" FROM orders
        WHERE o_orderdate <= timestamp '1999-01-01'
      UNION ALL SELECT 'incremental', 'success', count(*) FROM orders WHERE o_orderdate > (
        SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= timestamp '1999-01-01')
      UNION ALL SELECT 'validate', 'success', count(*) FROM orders
      UNION ALL SELECT 'incremental', 'skipped', 0) USING ("LOAD_TYPE", "STATUS")"""
)
def sync_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """What the log says of a seed, a delta, an empty delta and a deep validation."""
    spec = ORDERS.with_(keys=("O_ORDERKEY",))
    runner, _ = _two_loads(spark, folder, spec)
    _must(runner.run([spec]))
    _must(runner.validate([spec], deep=True))
    return runner.audit.log().select(
        "SOURCE_DB", "SOURCE_TABLE", "TARGET_TABLE", "LOAD_TYPE", "STATUS", "ROWS_RAW"
    )


def _log_sql(batch: int, name: str, kind: str, status: str, rows: str, rest: str) -> str:
    """One line of the log; ``rest`` is target rows, step, and the watermark's ends."""
    return f"""SELECT cast({batch} AS integer) AS batch, '{name}' AS "SOURCE_TABLE", '{kind}' AS "LOAD_TYPE",
  '{status}' AS "STATUS", {rows} AS "ROWS_EXTRACTED", {rest}"""


_END = "strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S')"
_NOTHING = "cast(NULL AS varchar)"


@query(
    " UNION ALL ".join(
        [
            _log_sql(
                1, "orders", "full", "success", "count(*)",
                f"""count(*) AS "ROWS_SILVER", {_NOTHING} AS "FAILED_STEP", {_NOTHING} AS "WATERMARK_FROM",
  {_END} AS "WATERMARK_TO" FROM orders WHERE o_orderdate <= timestamp '{ORDERS_CUT}'""",
            ),
            _log_sql(
                1, "customer", "full", "failed", "0::bigint",
                f"0::bigint, 'load_full', {_NOTHING}, {_NOTHING}",
            ),
            _log_sql(
                2, "orders", "incremental", "success",
                f"count(*) FILTER (WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= timestamp '{ORDERS_CUT}'))",
                f"count(*), {_NOTHING}, (SELECT {_END} FROM orders WHERE o_orderdate <= timestamp '{ORDERS_CUT}'), {_END} FROM orders",
            ),
            _log_sql(
                2, "customer", "full", "success", "count(*)",
                f"count(*), {_NOTHING}, {_NOTHING}, {_NOTHING} FROM customer",
            ),
        ]
    )
)
def sync_isolated_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The log of two tables run side by side: a source that fails while it is read stops neither the other nor the next run."""
    by_order = ORDERS.with_(keys=("O_ORDERKEY",))
    customers = TableSpec("shop", "customer", "CUSTOMER", keys=("C_CUSTKEY",))
    whole = table(spark, folder, "customer").select("c_custkey", "c_name")
    lost = F.when(F.col("c_custkey") % 10 == 0, F.raise_error(F.lit("connection lost"))).otherwise(F.col("c_name"))
    current = {"orders": orders_until(spark, folder, ORDERS_CUT), "customer": whole.withColumn("c_name", lost)}
    when = [datetime(2024, 2, 1, 3)]
    store = TableStore(spark, scratch_path(spark, "store"))
    runner = Sync(spark, store, lambda spec: current[spec.source_table], clock=lambda: when[-1])
    runner.run([customers, by_order])
    current |= {"orders": orders(spark, folder), "customer": whole}
    when.append(datetime(2024, 2, 2, 3))
    _must(runner.run([customers, by_order]))
    return runner.audit.log().select(
        F.when(F.col("RUN_START_UTC") < F.lit(when[-1]), 1).otherwise(2).alias("batch"),
        "SOURCE_TABLE", "LOAD_TYPE", "STATUS", "ROWS_EXTRACTED", "ROWS_SILVER", "FAILED_STEP", "WATERMARK_FROM", "WATERMARK_TO",
    )
