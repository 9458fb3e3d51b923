"""Per-table configuration."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

FULL, INCREMENTAL = "full", "incremental"
SILVER, SCD2 = "silver", "scd2"


@dataclass(frozen=True)
class TableSpec:
    """One synchronised table.  Column names are upper case, keys are always a list."""

    source_db: str
    source_table: str
    target_table: str
    keys: tuple[str, ...] = ()
    load_type: str = FULL
    watermark_col: str | None = None
    last_loaded_at: str | None = None
    partition_col: str | None = None
    partition_num: int = 1
    rows_per_file: int = 1_000_000
    reconcile: bool = False
    table_type: str = SILVER
    track_columns: tuple[str, ...] = ()
    active: bool = True
    # Hash buckets of the stored layers: an incremental run rewrites only the
    # buckets its keys fall into.
    buckets: int = 1

    @classmethod
    def from_config(cls, entry: dict[str, Any]) -> TableSpec:
        """Read one configuration entry; ``merge_keys`` wins over ``primary_key``."""
        keys = entry.get("merge_keys") or (
            [entry["primary_key"]] if entry.get("primary_key") else []
        )
        track = (entry.get("scd2") or {}).get("track_columns") or []
        watermark = entry.get("watermark_col")
        partition = entry.get("partition_col")
        return cls(
            source_db=entry["source_db"],
            source_table=entry["source_table"],
            target_table=entry.get("target_table") or entry["source_table"].upper(),
            keys=tuple(str(k).upper() for k in keys),
            load_type=entry.get("load_type", FULL),
            watermark_col=watermark.upper() if watermark else None,
            last_loaded_at=entry.get("last_loaded_at"),
            partition_col=partition.upper() if partition else None,
            partition_num=int(entry.get("partition_num") or 1),
            rows_per_file=int(entry.get("rows_per_file", 1_000_000) or 0),
            reconcile=bool(entry.get("reconcile", False)),
            table_type=SCD2 if entry.get("table_type") == SCD2 else SILVER,
            track_columns=tuple(str(c).upper() for c in track),
            active=bool(entry.get("active", True)),
            buckets=int(entry.get("buckets") or 1),
        )

    def with_(self, **changes: Any) -> TableSpec:
        return replace(self, **changes)

    @property
    def label(self) -> str:
        return f"{self.source_db}.{self.source_table}"

    @property
    def target_layer(self) -> str:
        return SCD2 if self.table_type == SCD2 else SILVER

    def namespace(self, layer: str) -> str:
        """``<SOURCE_DB>_<LAYER>``, the schema part of a layer table's name."""
        return f"{self.source_db.strip().upper()}_{layer.upper()}"
