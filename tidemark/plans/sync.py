"""Runs over configured tables: load, reconcile deletes, validate."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import typed
from tidemark.layers import DIM_KEY, business_fields, conform, scd2_schema, upper_names
from tidemark.operators.dedupe import key_struct, latest_per_key
from tidemark.operators.drift import detect_drift, evolve, widened
from tidemark.operators.merge import replace_raw, upsert_raw
from tidemark.operators.parity import BoardEntry, parity_report, watermark_text
from tidemark.operators.reconcile import count_hits, missing_keys, soft_delete
from tidemark.operators.scd2 import CLOSED as CLOSED_OP
from tidemark.operators.scd2 import KEEP, NEW, assign_surrogate, late_keys, scd2_changes, scd2_source
from tidemark.operators.silver import build_silver
from tidemark.operators.splice import splice_scd2
from tidemark.plans.audit import AuditLog, log_key
from tidemark.staging import scratch_path, stage
from tidemark.plans.store import CLOSED, CURRENT, TableStore, bucket_sizes, bucketed, touched_buckets
from tidemark.sources.files import write_delta
from tidemark.sources.window import LAG_MINUTES, incremental_window, window_bounds
from tidemark.spec import FULL, SCD2, SILVER, TableSpec

RAW = "raw"
SUCCESS, FAILED, SKIPPED, MISMATCH = "success", "failed", "skipped", "mismatch"

Source = Callable[[TableSpec], DataFrame]
Ceiling = Callable[[TableSpec], datetime]

log = logging.getLogger("tidemark")


def wall_clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class RunResult:
    batch_id: str
    records: list[dict]

    @property
    def failed(self) -> int:
        return sum(r["STATUS"] == FAILED for r in self.records)

    @property
    def mismatches(self) -> int:
        return sum(r["STATUS"] in (MISMATCH, FAILED) for r in self.records)


class Sync:
    """Keeps the layers of many tables in step with their sources.

    ``source`` returns the current source table of a spec as a DataFrame; if it has
    a method ``window(spec, low, high)``, that reads the rows of a window.
    ``ceiling`` is the source's own wall clock: watermarks are in source time, so
    windows end ``lag_minutes`` below it (see ``sources.clocks``).  Without one,
    the source is taken to keep the time of ``clock``, which stamps audit columns.
    After a run of a table the versions of its layers but the newest
    ``keep_versions`` are removed; frames read from older ones stop working.
    Tables are independent, so they run side by side as jobs of one session; a
    failing table is logged and does not stop the others.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: TableStore,
        source: Source,
        clock: Callable[[], datetime] = wall_clock,
        lag_minutes: int = LAG_MINUTES,
        lookback_minutes: int = 0,
        parallel: int = 4,
        revive: bool = False,
        ceiling: Ceiling | None = None,
        keep_versions: int = 10,
    ):
        self.spark = spark
        self.store = store
        self.audit = AuditLog(spark, store.base)
        self.source = source
        self.clock = clock
        self.lag_minutes = lag_minutes
        self.lookback_minutes = lookback_minutes
        self.parallel = parallel
        self.revive = revive
        self.ceiling = ceiling
        self.keep_versions = keep_versions

    # -- entry points -------------------------------------------------------

    def run(
        self, specs: Iterable[TableSpec], force_full: bool = False, only_table: str | None = None
    ) -> RunResult:
        """Load every active table and build its target."""
        chosen = self._chosen(specs, only_table)
        marks = self.audit.stored()
        return self._each(
            chosen,
            lambda spec, batch: self._load(spec, batch, force_full, marks.get(log_key(spec)) or spec.last_loaded_at),
        )

    def reconcile(
        self, specs: Iterable[TableSpec], only_table: str | None = None, allow_empty_source: bool = False
    ) -> RunResult:
        """Soft-delete rows that vanished at the source, for tables that ask for it."""
        chosen = [s for s in self._chosen(specs, only_table) if s.reconcile]
        return self._each(chosen, lambda spec, batch: self._reconcile(spec, batch, allow_empty_source))

    def validate(
        self, specs: Iterable[TableSpec], only_table: str | None = None, deep: bool = False
    ) -> RunResult:
        """Compare every active table with its source."""
        chosen = self._chosen(specs, only_table)
        return self._each(chosen, lambda spec, batch: self._validate(spec, batch, deep))

    def board(self, specs: Iterable[TableSpec], with_source: bool = False) -> list[BoardEntry]:
        """Frames for ``count_board`` / ``parity_board``."""
        return [
            BoardEntry(
                label=spec.label,
                raw=self.store.read(spec, RAW),
                target=self.target(spec),
                source=self._read_source(spec) if with_source else None,
                scd2=spec.table_type == SCD2,
            )
            for spec in specs
            if spec.active
        ]

    def table_counts(self, specs: Iterable[TableSpec]) -> DataFrame | None:
        """Rows of every stored RAW and SILVER table, for ``layer_counts``; reads footers only."""
        counted = None
        for spec in specs:
            for layer in (RAW, SILVER):
                df = self.store.read(spec, layer)
                if df is None:
                    continue
                one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(spec.namespace(layer)).alias("table_schema"),
                    F.lit(spec.target_table).alias("table_name"),
                    "row_count",
                )
                counted = one if counted is None else counted.unionByName(one)
        return counted

    def target(self, spec: TableSpec) -> DataFrame | None:
        return self.store.read(spec, spec.target_layer)

    def register_views(self, spec: TableSpec) -> list[str]:
        """Temp views of the layers, and ``..._CURRENT`` for a dimension."""
        made = []
        for layer in (RAW, spec.target_layer):
            df = self.store.read(spec, layer)
            if df is not None:
                name = self.store.view_name(spec, layer)
                df.createOrReplaceTempView(name)
                made.append(name)
        if spec.table_type == SCD2:
            current = self.store.read(spec, SCD2, part=CURRENT)
            if current is not None:
                name = f"{self.store.view_name(spec, SCD2)}_CURRENT"
                business = [f.name for f in business_fields(current.schema)]
                current.select(*business, "EFF_FROM").createOrReplaceTempView(name)
                made.append(name)
        return made

    # -- shared -------------------------------------------------------------

    @staticmethod
    def _chosen(specs: Iterable[TableSpec], only_table: str | None) -> list[TableSpec]:
        return [s for s in specs if s.active and (only_table is None or s.source_table == only_table)]

    def _each(self, specs: Sequence[TableSpec], work: Callable[[TableSpec, str], dict]) -> RunResult:
        batch = uuid.uuid4().hex[:12]
        if not specs:
            return RunResult(batch, [])
        with ThreadPoolExecutor(max_workers=max(1, min(self.parallel, len(specs)))) as pool:
            return RunResult(batch, list(pool.map(lambda spec: work(spec, batch), specs)))

    def _read_source(self, spec: TableSpec) -> DataFrame:
        return _demanded(spec, upper_names(self.source(spec)))

    def _read_window(self, spec: TableSpec, low: str | None, high: str | None) -> DataFrame:
        reader = getattr(self.source, "window", None)
        return self._read_source(spec) if reader is None else _demanded(spec, upper_names(reader(spec, low, high)))

    def _behind(self, spec: TableSpec) -> tuple[bool, bool]:
        """Whether the target was built from older RAW rows, and whether a full load came between.

        RAW and target are two commits; a run that fails between them leaves the
        target behind, and the next run has to rebuild all of it.
        """
        raw, target = self.store.version(spec, RAW), self.store.version(spec, spec.target_layer)
        if raw is None or target is None:
            return raw is not None, False
        built = target.notes.get("raw_data", 0)
        return built != raw.notes.get("data", 0), raw.notes.get("full", 0) > built

    def _tidy(self, spec: TableSpec) -> None:
        for layer in (RAW, spec.target_layer):
            self.store.expire(spec, layer, self.keep_versions)

    def _record(self, spec: TableSpec, batch: str, load_type: str, engine: str) -> dict:
        return {
            "BATCH_ID": batch,
            "SOURCE_DB": spec.source_db,
            "SOURCE_TABLE": spec.source_table,
            "TARGET_TABLE": spec.target_table,
            "LOAD_TYPE": load_type,
            "ENGINE": engine,
            "ROWS_EXTRACTED": 0,
            "ROWS_RAW": 0,
            "ROWS_SILVER": 0,
            "STATUS": FAILED,
            "RUN_START_UTC": self.clock(),
        }

    def _guarded(self, record: dict, steps: Callable[[dict], None]) -> dict:
        """Run ``steps``; whatever happens, finish the record and log it."""
        started = time.monotonic()
        record["FAILED_STEP"] = "start"
        try:
            steps(record)
            if record["STATUS"] in (SUCCESS, SKIPPED):
                record["FAILED_STEP"] = None
            for text in record.get("WARNINGS", ()):
                log.warning("%s.%s: %s", record["SOURCE_DB"], record["SOURCE_TABLE"], text)
        except Exception as error:  # noqa: BLE001 - one table must not stop the run
            record["STATUS"] = FAILED
            record["ERROR_MESSAGE"] = str(error)
        record["DURATION_SEC"] = round(time.monotonic() - started, 2)
        record["RUN_END_UTC"] = self.clock()
        try:
            self.audit.write(record, record["RUN_END_UTC"])
        except Exception as error:  # noqa: BLE001 - the log also holds the watermark, so this run counts as failed
            record |= {"STATUS": FAILED, "FAILED_STEP": "run_log", "ERROR_MESSAGE": str(error)}
        return record

    # -- load ---------------------------------------------------------------

    def _load(self, spec: TableSpec, batch: str, force_full: bool, last: str | None) -> dict:
        seeded = self.store.version(spec, RAW) is not None
        full = force_full or spec.load_type == FULL or last is None or not seeded
        record = self._record(spec, batch, "full" if full else "incremental", "snapshot" if full else "window")
        record["WATERMARK_FROM"] = last

        def steps(rec: dict) -> None:
            as_of = self.clock()
            behind, snapshot = self._behind(spec)
            if full:
                rec["FAILED_STEP"] = "extract"
                source = self._read_source(spec)
                rec["FAILED_STEP"] = "schema_drift"
                shape = self._absorb_drift(spec, source.schema, rec, full=True)
                rec["FAILED_STEP"] = "load_full"
                touched, snapshot = None, True
                rec["ROWS_RAW"] = rec["ROWS_EXTRACTED"] = self.store.commit(
                    spec, RAW, replace_raw(_fitted(source, shape), as_of, batch, _origin()), full=True
                )
            else:
                rec["FAILED_STEP"] = "extract_window"
                now = self.ceiling(spec) if self.ceiling is not None else as_of
                low, high = window_bounds(now, last, self.lag_minutes, self.lookback_minutes)
                rec["WATERMARK_TO"] = high
                source = self._read_window(spec, low, high)
                rec["FAILED_STEP"] = "schema_drift"
                shape = self._absorb_drift(spec, source.schema, rec, full=False)
                rec["FAILED_STEP"] = "extract_window"
                window = incremental_window(source, spec.watermark_col, low, high)
                landed = self._land(spec, _fitted(window, shape))
                rec["ROWS_EXTRACTED"] = landed.count()
                touched: list[int] | None = None
                if rec["ROWS_EXTRACTED"]:
                    rec["FAILED_STEP"] = "merge"
                    if not spec.keys:
                        raise ValueError(f"{spec.label}: an incremental merge needs keys")
                    delta = stage(latest_per_key(landed, spec.keys, spec.watermark_col), "delta")
                    sizes = bucket_sizes(delta, spec)
                    rec["ROWS_RAW"] = sum(sizes.values())
                    touched = sorted(sizes) if bucketed(spec) else None
                    raw = self.store.read(spec, RAW, buckets=touched)
                    merged = upsert_raw(raw, delta, spec.keys, as_of, batch, revive=self.revive)
                    self.store.commit(spec, RAW, merged, keep=_outside(touched), count=False)
                elif not behind:
                    rec["STATUS"], rec["ERROR_MESSAGE"] = SKIPPED, "no rows in the window"
                    return
            rec["FAILED_STEP"] = "build_target"
            rec["ROWS_SILVER"] = self._build_target(spec, as_of, batch, None if behind else touched, snapshot)
            rec["FAILED_STEP"] = "watermark"
            if full or rec["ROWS_EXTRACTED"]:
                rec["WATERMARK_TO"] = self._newest_watermark(spec, touched, None if full else last)
            else:
                rec["WATERMARK_TO"] = last
            self._tidy(spec)
            rec["STATUS"] = SUCCESS

        return self._guarded(record, steps)

    def _absorb_drift(self, spec: TableSpec, source: T.StructType, rec: dict, full: bool) -> T.StructType | None:
        """Bring the layers to the source's columns; returns the business columns to load, ``None`` for the first load.

        New columns read NULL in existing rows and a wider type takes the stored
        values; a full load takes whatever types the source has now, except in a
        dimension, whose history keeps what it can hold.  Columns the source no
        longer has stay, and are reported.
        """
        raw = self.store.version(spec, RAW)
        if raw is None:
            return None
        drift = detect_drift(source, raw.schema)
        if drift.dropped:
            rec.setdefault("WARNINGS", []).append(f"gone from the source, NULL from now on: {', '.join(drift.dropped)}")
        for layer in (RAW, spec.target_layer):
            version = self.store.version(spec, layer)
            if version is None:
                continue
            schema = widened(evolve(version.schema, drift), source)
            if schema != version.schema:
                self.store.evolve(spec, layer, schema)
        reset = full and spec.table_type != SCD2
        return T.StructType(business_fields(widened(evolve(raw.schema, drift), source, reset)))

    def _land(self, spec: TableSpec, window: DataFrame) -> DataFrame:
        """Write the window to landing files, so the source is read exactly once."""
        path = scratch_path(self.spark, f"landing-{spec.target_table}")
        traced = window.withColumn("_SRC_FILE", _origin())
        write_delta(traced, path, spec.rows_per_file)
        landed = self.spark.read.schema(traced.schema).parquet(path)
        return landed.withColumn("_SRC_FILE", F.coalesce("_SRC_FILE", F.col("_metadata.file_name")))

    def _build_target(
        self, spec: TableSpec, as_of: datetime, batch: str, touched: list[int] | None, snapshot: bool
    ) -> int:
        raw = self.store.read(spec, RAW, buckets=touched)
        if spec.table_type == SCD2:
            return self._build_dimension(spec, raw, as_of, batch, touched, snapshot)
        silver = self.store.read(spec, spec.target_layer, buckets=touched)
        built = build_silver(silver, raw, spec.keys, spec.watermark_col, snapshot)
        return self.store.commit(spec, spec.target_layer, built, keep=_outside(touched), notes=self._origin_of(spec))

    def _origin_of(self, spec: TableSpec) -> dict:
        """Notes that say which RAW rows a target was built from."""
        return {"raw_data": self.store.version(spec, RAW).notes.get("data", 0)}

    def _build_dimension(
        self, spec: TableSpec, raw: DataFrame, as_of: datetime, batch: str, touched: list[int] | None, snapshot: bool
    ) -> int:
        if not spec.keys:
            raise ValueError(f"{spec.label}: a versioned dimension needs keys")
        before = self.store.version(spec, SCD2)
        shape = before.schema if before else scd2_schema(T.StructType(business_fields(raw.schema)))
        current = (
            self.store.read(spec, SCD2, part=CURRENT, buckets=touched)
            if before
            else self.spark.createDataFrame([], shape)
        )
        source = scd2_source(raw, spec.keys, spec.watermark_col, as_of, spec.track_columns)
        late = stage(late_keys(current, source, spec.keys), "late")
        has_late = before is not None and not late.isEmpty()
        if has_late:
            # Their whole histories are spliced, so closed versions of these buckets are written again.
            history = self.store.read(spec, SCD2, buckets=touched).withColumn("_key", key_struct(spec.keys))
            changed = source.join(late, "_key", "left_semi").select(*source.columns)
            own = history.join(late, "_key", "left_semi").select(*shape.names)
            spliced = splice_scd2(own, changed, spec.keys, as_of, batch)
            spliced = spliced.withColumn("_op", F.when(F.col(DIM_KEY.name).isNull(), NEW).otherwise(CLOSED_OP))
            others = history.join(late, "_key", "left_anti")
            source = source.join(late, "_key", "left_anti").select(*source.columns)
            current = others.where("IS_CURRENT").select(*shape.names)
            rest = others.where("NOT IS_CURRENT").select(*shape.names, F.lit(KEEP).alias("_op"))
            spliced = spliced.unionByName(rest)
        changes = scd2_changes(current, source, spec.keys, as_of, batch, snapshot=snapshot)
        changes = stage(changes.unionByName(spliced) if has_late else changes, "versions")
        sizes = {r["_op"]: r["n"] for r in changes.groupBy("_op").agg(F.count(F.lit(1)).alias("n")).collect()}
        moved = before is not None and before.buckets != spec.buckets
        if before and not moved and not sizes.get(NEW) and not sizes.get(CLOSED_OP):
            self.store.annotate(spec, SCD2, self._origin_of(spec))
            return 0
        base = before.notes.get("max_key", 0) if before else 0
        rows = changes.where(F.col("_op") != NEW)
        if sizes.get(NEW):
            new = assign_surrogate(changes.where(F.col("_op") == NEW), spec.keys, base)
            rows = rows.unionByName(new)
        rows, drop_current = rows.drop("_op"), _outside(touched)
        if moved and touched is None and not has_late:  # another number of buckets: closed versions move with the others
            rows = rows.unionByName(self.store.read(spec, SCD2, part=CLOSED))
        self.store.commit(
            spec,
            SCD2,
            rows,
            keep=lambda piece: not (moved and touched is None)
            and ((piece.part == CLOSED and not has_late) or drop_current(piece)),
            part=F.when(F.col("IS_CURRENT"), F.lit(CURRENT)).otherwise(F.lit(CLOSED)),
            notes={"max_key": base + sizes.get(NEW, 0), **self._origin_of(spec)},
            count=False,
        )
        return sizes.get(NEW, 0) + sizes.get(CLOSED_OP, 0)

    def _newest_watermark(self, spec: TableSpec, touched: list[int] | None, last: str | None) -> str | None:
        """``max(watermark)`` of RAW.

        An incremental run only has to look at the buckets it rewrote: the others
        cannot exceed the stored value.
        """
        if not spec.watermark_col:
            return None
        raw = self.store.read(spec, RAW, buckets=touched)
        value = F.max(F.col(spec.watermark_col))
        if touched is not None and last is not None:
            value = F.greatest(value, typed(last, raw.schema[spec.watermark_col].dataType))
        text = raw.agg(value.alias(spec.watermark_col))
        return text.agg(watermark_text(text.schema, spec.watermark_col, precise=True)).first()[0]

    # -- reconcile ----------------------------------------------------------

    def _reconcile(self, spec: TableSpec, batch: str, allow_empty_source: bool) -> dict:
        record = self._record(spec, batch, "reconcile", "reconcile")
        record |= {"ROWS_EXTRACTED": None, "ROWS_SILVER": None}

        def steps(rec: dict) -> None:
            rec["FAILED_STEP"] = "reconcile"
            if not spec.keys:
                rec["STATUS"], rec["ERROR_MESSAGE"] = SKIPPED, "the table has no keys to compare"
                return
            as_of = self.clock()
            behind, snapshot = self._behind(spec)
            source, raw = self._read_source(spec), self.store.read(spec, RAW)
            if not allow_empty_source and source.isEmpty():
                raise ValueError(f"{spec.label}: the source is empty; refusing to delete every row")
            missing = stage(missing_keys(raw, source, spec.keys), "missing")
            touched: list[int] | None = None
            vanished = not missing.isEmpty()
            if vanished:
                touched = touched_buckets(missing, spec)
                part = self.store.read(spec, RAW, buckets=touched)
                rec["ROWS_RAW"] = count_hits(part, missing, spec.keys)
                flagged = soft_delete(part, missing, spec.keys, as_of)
                self.store.commit(spec, RAW, flagged, keep=_outside(touched), count=False)
            if vanished or behind:
                rec["FAILED_STEP"] = "build_target"
                rec["ROWS_SILVER"] = self._build_target(spec, as_of, batch, None if behind else touched, snapshot)
                self._tidy(spec)
            rec["STATUS"] = SUCCESS

        return self._guarded(record, steps)

    # -- validate -----------------------------------------------------------

    def _validate(self, spec: TableSpec, batch: str, deep: bool) -> dict:
        record = self._record(spec, batch, "validate", "parity")

        def steps(rec: dict) -> None:
            rec["FAILED_STEP"] = "parity"
            raw = self.store.read(spec, RAW)
            if raw is None:
                raise ValueError(f"{spec.label}: never loaded")
            behind, _ = self._behind(spec)
            report = parity_report(
                _fitted(self._read_source(spec), T.StructType(business_fields(raw.schema))),
                raw,
                self.target(spec),
                spec.watermark_col,
                deep,
                scd2=spec.table_type == SCD2,
            ).first()
            rec |= {
                "ROWS_EXTRACTED": report["source"],
                "ROWS_RAW": report["raw_live"],
                "ROWS_SILVER": report["target"],
                "STATUS": SUCCESS if report["ok"] and not behind else MISMATCH,
            }
            if not report["ok"] or behind:
                rec["ERROR_MESSAGE"] = _mismatch(report.asDict(), behind)

        return self._guarded(record, steps)


def _mismatch(report: dict, behind: bool = False) -> str:
    """Names every failed check."""
    found = []
    if behind:
        found.append("the target was built from older RAW rows")
    if not report["count_ok"]:
        found.append(f"{report['source']} rows at the source, {report['raw_live']} live in RAW, off by {report['delta']}")
    if not report["wm_ok"]:
        found.append(f"watermark {report['source_wm']} != {report['raw_wm']}")
    if not report["hash_ok"]:
        found.append(f"fingerprint {report['source_hash']} != {report['raw_hash']}")
    return "; ".join(found)


def _fitted(source: DataFrame, shape: T.StructType | None) -> DataFrame:
    """Source rows in the order and types of ``shape``; the first load sets them."""
    return source if shape is None else conform(source, shape)


def _demanded(spec: TableSpec, source: DataFrame) -> DataFrame:
    """The source, if it has the columns that tell rows apart; NULLs in their place would fold all rows into one."""
    have = {c.upper() for c in source.columns}
    watermark = [spec.watermark_col] if spec.watermark_col and spec.load_type != FULL else []
    absent = [c for c in (*spec.keys, *watermark) if c.upper() not in have]
    if absent:
        raise ValueError(f"{spec.label}: the source lacks {', '.join(absent)}")
    return source


def _origin() -> Column:
    """Source file of a row; NULL when it does not come from a file."""
    return F.nullif(F.input_file_name(), F.lit(""))


def _outside(touched: list[int] | None) -> Callable:
    """Keeps the directories of buckets that were not rewritten; ``None`` rewrote all."""
    if touched is None:
        return lambda piece: False
    rewritten = set(touched)
    return lambda piece: piece.bucket not in rewritten
