"""Landing a snapshot or a delta in RAW."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.layers import AUDIT, NTZ, business_columns, is_deleted, with_audit
from tidemark.staging import fits_broadcast


def replace_raw(
    snapshot: DataFrame, as_of: object, batch_id: str | None = None, src_file: Column | str | None = None
) -> DataFrame:
    """The RAW content after a full load: the snapshot with fresh audit columns."""
    return with_audit(snapshot, as_of, batch_id, src_file)


def upsert_raw(
    raw: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    as_of: object,
    batch_id: str | None = None,
    src_file: Column | str | None = None,
    revive: bool = False,
) -> DataFrame:
    """Merge a delta with one row per key into RAW.

    Every RAW row whose key is in the delta takes all its non-key business
    columns, whatever the watermarks say; audit columns stay as they are.  Other
    delta rows are inserted.  A NULL in a key matches nothing.  ``revive`` also
    clears the delete flag of matched rows.  A ``_SRC_FILE`` column of the delta
    becomes that of the inserted rows.

    Planned as ``raw LEFT JOIN delta`` plus ``delta ANTI JOIN raw keys`` instead
    of one full outer join: a left join can broadcast a small delta, so RAW is not
    shuffled at all, and otherwise lets adaptive execution split a hot RAW key,
    neither of which a full outer join allows.  Pass a staged delta (its size is
    then known and it is computed once).
    """
    keys = list(keys)
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    business = business_columns(raw)
    key_set = {k.upper() for k in keys}
    values = [c for c in business if c.upper() not in key_set]

    right = delta.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`").alias(f"_s_{c}") for c in values],
        F.lit(True).alias("_hit"),
    )
    match = None
    for i, k in enumerate(keys):
        equal = F.col(f"`{k}`") == F.col(f"_k{i}")
        match = equal if match is None else match & equal

    audit = {c: F.col(c) for c in AUDIT}
    if revive:
        back = F.col("_hit") & is_deleted()
        audit["_IS_DELETED"] = F.when(back, F.lit(False)).otherwise(F.col("_IS_DELETED"))
        audit["_DELETED_AT"] = F.when(back, F.lit(None).cast(NTZ)).otherwise(F.col("_DELETED_AT"))
    if values or revive:
        kept = raw.join(right, match, "left").select(
            *[
                F.col(f"`{c}`")
                if c.upper() in key_set
                else F.when(F.col("_hit"), F.col(f"`_s_{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
                for c in business
            ],
            *[col.alias(name) for name, col in audit.items()],
        )
    else:
        kept = raw.select(*business, *AUDIT)

    known = raw.select(*keys)
    if fits_broadcast(delta):
        # Reduce RAW's keys to the few in the delta without shuffling them.
        known = known.join(delta.select(*keys), keys, "left_semi")
    origin = ["_SRC_FILE"] if "_SRC_FILE" in delta.columns else []
    fresh = delta.select(*business, *origin).join(known.distinct(), keys, "left_anti").select(*business, *origin)
    if origin:
        src_file = F.col("_SRC_FILE")
    return kept.unionByName(with_audit(fresh, as_of, batch_id, src_file))
