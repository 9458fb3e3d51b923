"""Source/target parity: counts, newest watermark and content fingerprint."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fingerprint_columns, second_text
from tidemark.layers import business_columns, is_deleted
from tidemark.operators.dedupe import latest_per_key

# Labels of the boards.
SILVER_LABEL, SCD2_LABEL = "SILVER", "SCD2 (current)"
STAGING_SUFFIX = "_STAGE_TMP"


def watermark_text(schema: T.StructType, watermark: str, precise: bool = False) -> Column:
    """``max(watermark)`` as text; to the second, or at full precision."""
    kind = schema[watermark].dataType
    top = F.max(F.col(watermark))
    if precise:
        return top.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return second_text(top)
    if isinstance(kind, T.DateType):
        return second_text(top.cast("timestamp_ntz"))
    return top.cast("string")


def max_watermark(raw: DataFrame, watermark: str) -> DataFrame:
    """Newest watermark in RAW, soft-deleted rows included, as one text row."""
    return raw.agg(watermark_text(raw.schema, watermark, precise=True).alias("max_watermark"))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``rows, hash_xor, hash_sum``: independent of row order and partitioning."""
    names = list(columns) if columns is not None else business_columns(df)
    aggregates = fingerprint_columns([df.schema[c] for c in names])
    return df.agg(*[col.alias(name) for name, col in aggregates.items()])


def _side(df: DataFrame, name: str, watermark: str | None, deep: bool, columns: Sequence[str]) -> DataFrame:
    """One row per side: count, newest watermark and fingerprint in a single scan."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    aggregates.append(
        (watermark_text(df.schema, watermark) if watermark else F.max(F.lit(None).cast("string"))).alias("wm")
    )
    fields = [next(f for f in df.schema.fields if f.name.upper() == c.upper()) for c in columns]
    for key, col in (fingerprint_columns(fields) if deep else {}).items():
        if key != "rows":
            aggregates.append(col.alias(key))
    side = df.agg(*aggregates)
    if not deep:
        side = side.withColumns(
            {"hash_xor": F.lit(None).cast("long"), "hash_sum": F.lit(None).cast("decimal(38,0)")}
        )
    return side.select(F.lit(name).alias("side"), "n", "wm", "hash_xor", "hash_sum")


def parity_report(
    source: DataFrame,
    raw: DataFrame,
    target: DataFrame | None = None,
    watermark: str | None = None,
    deep: bool = False,
    scd2: bool = False,
) -> DataFrame:
    """One row saying whether live RAW equals the source.

    ``ok`` needs equal counts, equal newest watermarks (NULL equals NULL; only if
    a watermark is given) and, with ``deep``, equal fingerprints over the source's
    columns.  The target's count is informational.  The sides are single-row
    aggregates lined up by one small aggregate, so no join is needed.
    """
    columns = business_columns(source)
    live_raw = raw.where(~is_deleted()) if "_IS_DELETED" in raw.columns else raw
    sides = _side(source, "source", watermark, deep, columns).unionByName(
        _side(live_raw, "raw", watermark, deep, columns)
    )
    if target is not None:
        counted = target.where("IS_CURRENT") if scd2 else target
        sides = sides.unionByName(_side(counted, "target", None, False, []))

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    line = sides.groupBy().agg(
        of("source", "n").alias("source"),
        of("raw", "n").alias("raw_live"),
        of("target", "n").alias("target"),
        of("source", "wm").alias("source_wm"),
        of("raw", "wm").alias("raw_wm"),
        of("source", "hash_xor").alias("source_hash"),
        of("raw", "hash_xor").alias("raw_hash"),
        of("source", "hash_sum").alias("_source_sum"),
        of("raw", "hash_sum").alias("_raw_sum"),
    )
    same_hash = F.col("source_hash").eqNullSafe(F.col("raw_hash")) & F.col("_source_sum").eqNullSafe(F.col("_raw_sum"))
    return (
        line.withColumns(
            {
                "count_ok": F.col("source") == F.col("raw_live"),
                "wm_ok": F.col("source_wm").eqNullSafe(F.col("raw_wm")) if watermark else F.lit(True),
                "hash_ok": same_hash if deep else F.lit(True),
            }
        )
        .select(
            "source",
            "raw_live",
            "target",
            F.lit(SCD2_LABEL if scd2 else SILVER_LABEL).alias("target_layer"),
            "count_ok",
            (F.col("source") - F.col("raw_live")).alias("delta"),
            F.lit(bool(watermark)).alias("has_wm"),
            "source_wm",
            "raw_wm",
            "wm_ok",
            F.lit(deep).alias("deep"),
            "source_hash",
            "raw_hash",
            "hash_ok",
            (F.col("count_ok") & F.col("wm_ok") & F.col("hash_ok")).alias("ok"),
        )
    )


# --- boards over many tables -----------------------------------------------

@dataclass(frozen=True)
class BoardEntry:
    """The frames of one table on a board; ``None`` is a layer that cannot be read."""

    label: str
    raw: DataFrame | None
    target: DataFrame | None
    source: DataFrame | None = None
    scd2: bool = False


def _counts(df: DataFrame | None, label: str, layer: str, kind: str) -> DataFrame | None:
    if df is None:
        return None
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(label).alias("table_name"), F.lit(layer).alias("target_layer"), F.lit(kind).alias("kind"), "n"
    )


def _lined_up(frames: list[DataFrame], kinds: Sequence[str]) -> DataFrame:
    """Union of single-row counts, one output row per table."""
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows.groupBy("table_name", "target_layer").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in kinds]
    )


def _frames(entries: Sequence[BoardEntry], live_only: bool, with_source: bool) -> list[DataFrame]:
    frames = []
    for e in entries:
        layer = SCD2_LABEL if e.scd2 else SILVER_LABEL
        raw = e.raw
        if raw is not None and live_only:
            raw = raw.where(~is_deleted())
        target = e.target
        if target is not None and e.scd2:
            target = target.where("IS_CURRENT")
        sides = [("raw_rows", raw), ("target_rows", target)]
        if with_source:
            sides.append(("source_rows", e.source))
        made = [_counts(df, e.label, layer, kind) for kind, df in sides]
        frames += [m for m in made if m is not None]
    return frames


def _parity(left: str, right: str) -> Column:
    """``ok``, ``differs``, or NULL when a side could not be counted."""
    return F.when(F.col(left) == F.col(right), F.lit("ok")).when(F.col(left) != F.col(right), F.lit("differs"))


def count_board(entries: Sequence[BoardEntry], log: DataFrame | None = None) -> DataFrame:
    """RAW (soft-deleted rows included) against target rows, per table.

    With the run log also the end and the status of each table's newest run.
    """
    board = _lined_up(_frames(entries, live_only=False, with_source=False), ["raw_rows", "target_rows"])
    board = board.withColumn("match", _parity("raw_rows", "target_rows"))
    if log is None:
        return board
    newest = latest_per_key(log, ["SOURCE_DB", "SOURCE_TABLE"], "INSERTED_AT", tiebreak=["RUN_ID"]).select(
        F.concat_ws(".", "SOURCE_DB", "SOURCE_TABLE").alias("table_name"),
        F.col("RUN_END_UTC").alias("last_sync"),
        F.col("STATUS").alias("last_status"),
    )
    return board.join(newest, "table_name", "left")


def parity_board(entries: Sequence[BoardEntry]) -> DataFrame:
    """Source against live RAW rows, per table, with the target for reference."""
    kinds = ["source_rows", "raw_rows", "target_rows"]
    board = _lined_up(_frames(entries, live_only=True, with_source=True), kinds)
    return board.withColumns(
        {
            "delta": F.col("source_rows") - F.col("raw_rows"),
            "parity": _parity("source_rows", "raw_rows"),
        }
    )


def board_totals(board: DataFrame, verdict: str = "match") -> DataFrame:
    """Totals and tallies of a count or parity board; uncounted sides add nothing."""
    sums = [
        F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"total_{c}")
        for c in ("source_rows", "raw_rows", "target_rows")
        if c in board.columns
    ]
    return board.agg(
        *sums,
        F.count_if(F.coalesce(F.col(verdict) == "ok", F.lit(False))).alias("matched"),
        F.count_if(F.coalesce(F.col(verdict) == "differs", F.lit(False))).alias("mismatched"),
    )


def layer_counts(tables: DataFrame) -> DataFrame:
    """RAW rows beside SILVER rows of the same table, flagging an empty SILVER.

    ``tables`` has one row per stored table: ``table_schema`` (``X_RAW`` or
    ``X_SILVER``), ``table_name``, ``row_count``.  Staging tables do not count.
    """
    named = tables.where(~F.col("table_name").endswith(STAGING_SUFFIX))

    def side(suffix: str, rows: str) -> DataFrame:
        return named.where(F.col("table_schema").endswith(suffix)).select(
            F.expr(f"left(table_schema, length(table_schema) - {len(suffix)})").alias("_base"),
            F.col("table_schema").alias(f"_schema{suffix}"),
            "table_name",
            F.col("row_count").alias(rows),
        )

    pairs = side("_RAW", "raw_rows").join(side("_SILVER", "silver_rows"), ["_base", "table_name"])
    flag = F.when((F.col("raw_rows") > 0) & (F.col("silver_rows") == 0), F.lit("CHECK: SILVER empty"))
    return pairs.select(
        F.col("_schema_RAW").alias("raw_schema"),
        "table_name",
        "raw_rows",
        "silver_rows",
        (F.col("raw_rows") - F.col("silver_rows")).alias("dedupe_diff"),
        flag.alias("flag"),
    ).orderBy(F.asc_nulls_last("flag"), F.desc("dedupe_diff"), "raw_schema", "table_name")
