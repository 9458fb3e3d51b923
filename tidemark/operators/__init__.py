from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.drift import Drift, apply_drift, detect_drift
from tidemark.operators.lookup import fact_lookup
from tidemark.operators.merge import replace_raw, upsert_raw
from tidemark.operators.reconcile import missing_keys, soft_delete
from tidemark.operators.scd2 import (
    as_of_versions,
    build_scd2,
    current_versions,
    scd2_changes,
    scd2_source,
)
from tidemark.operators.silver import build_silver

__all__ = [
    "Drift",
    "apply_drift",
    "as_of_versions",
    "build_scd2",
    "build_silver",
    "current_versions",
    "detect_drift",
    "fact_lookup",
    "latest_per_key",
    "missing_keys",
    "replace_raw",
    "scd2_changes",
    "scd2_source",
    "soft_delete",
    "upsert_raw",
]
