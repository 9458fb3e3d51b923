"""Changes put in their place in a versioned history, in whatever order they arrive.

``build_scd2`` takes the newest row of a key as its state from now on.  Here every change takes effect at its own time: one older
than the current version is cut into the closed version it falls into, or fills a gap, and lasts until whatever followed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import change_time, ntz, row_hash
from tidemark.layers import DIM_KEY, business_columns, is_deleted
from tidemark.operators.dedupe import key_struct, latest_per_key
from tidemark.operators.scd2 import HIGH_DATE, HashFunction, empty_dimension, tracked_columns
from tidemark.staging import stage

ENDED, STARTED, CHANGED = 0, 1, 2


def scd2_change_rows(
    raw: DataFrame,
    keys: Sequence[str],
    watermark: str | None,
    as_of: object,
    track: Sequence[str] = (),
    hash_function: HashFunction = row_hash,
) -> DataFrame:
    """All rows of RAW as changes, one per key and moment: ``scd2_source`` without its choice of the newest row."""
    business = business_columns(raw)
    fields = {f.name: f for f in raw.schema.fields}
    when = F.when(is_deleted(), F.coalesce("_DELETED_AT", ntz(as_of))).otherwise(change_time(raw.schema, watermark, as_of))
    keyed = raw.select(*business, "_IS_DELETED", "_DELETED_AT", key_struct(keys).alias("_key"), when.alias("_ct"))
    # Of changes at one moment the newest row counts, then the greatest.
    keyed = keyed.withColumn("_moment", F.struct("_key", "_ct"))
    latest = latest_per_key(keyed, [*keys, "_key", "_ct"], watermark, by="_moment")
    return latest.select(
        *business,
        "_key",
        is_deleted().alias("_is_del"),
        F.col("_DELETED_AT").alias("_del_at"),
        "_ct",
        hash_function([fields[c] for c in tracked_columns(business, keys, track)]).alias("_hash"),
    )


def splice_scd2(
    dim: DataFrame | None, changes: DataFrame, keys: Sequence[str], as_of: object, batch_id: str | None = None
) -> DataFrame:
    """The dimension with ``changes`` (see ``scd2_change_rows``) spliced in.

    A key's history is a step function of time.  A change sets it from its moment to
    the next step, a delete empties it until then.  A change to what is already in
    force is none (a NULL hash equals any), a delete of what is not there neither.
    The version that a change or delete falls into ends there; at the very start of a
    version that leaves it without duration.  No version ends before it starts; stored
    versions without duration stay as they are.  New versions have no ``DIM_KEY`` yet.

    Only histories of changed keys are read into the one exchange; all others pass
    through, without a shuffle where the keys are few enough to be broadcast.
    """
    if not keys:
        raise ValueError("a versioned dimension needs at least one key column")
    if dim is None:
        dim = empty_dimension(changes)
    changes = stage(changes, "changes")
    touched = stage(changes.select("_key").distinct(), "changed-keys")
    keyed = dim.withColumn("_key", key_struct(keys))
    lasting = F.coalesce(F.col("EFF_FROM") < F.col("EFF_TO"), F.lit(False))
    own = keyed.where(lasting).join(touched, "_key", "left_semi")
    # One way past: keys without changes, and versions without duration.
    past = keyed.where(lasting).join(touched, "_key", "left_anti").unionByName(keyed.where(~lasting)).drop("_key")

    kinds = {f.name: f.dataType for f in dim.schema.fields}
    fresh = {
        "EFF_FROM": F.col("_ct"),
        "EFF_TO": ntz(HIGH_DATE),
        "IS_CURRENT": F.lit(True),
        "IS_DELETED": F.lit(False),
        "ROW_HASH": F.col("_hash"),
        "_LOAD_TS": ntz(as_of),
        "_BATCH_ID": F.lit(batch_id),
        DIM_KEY.name: F.lit(None),
    }
    version = F.struct(*[fresh.get(c, F.col(f"`{c}`")).cast(kinds[c]).alias(c) for c in dim.columns])
    state = F.struct(*[F.col(f"`{c}`") for c in dim.columns])
    nothing = F.lit(None).cast(own.select(state.alias("s")).schema["s"].dataType)

    def step(df: DataFrame, at: Column, kind: int, what: Column) -> DataFrame:
        return df.select("_key", at.alias("_at"), F.lit(kind).alias("_kind"), what.alias("_version"))

    steps = (
        step(own, F.col("EFF_FROM"), STARTED, state)
        .unionByName(step(own.where(F.col("EFF_TO") < ntz(HIGH_DATE)), F.col("EFF_TO"), ENDED, nothing))
        .unionByName(step(changes, F.col("_ct"), CHANGED, F.when(~F.col("_is_del"), version)))
    )
    along = Window.partitionBy("_key").orderBy("_at", "_kind")
    before, after = F.lag("_version").over(along), F.lead(F.struct("_at", "_kind")).over(along)
    steps = steps.withColumns({"_before": before, "_after": after, "_gone": F.col("_version").isNull()})
    continued = (F.col("_kind") == ENDED) & F.coalesce((F.col("_after._at") == F.col("_at")) & (F.col("_after._kind") == STARTED), F.lit(False))
    same = ~F.coalesce(F.col("_version.ROW_HASH") != F.col("_before.ROW_HASH"), F.lit(False))
    idle = (F.col("_kind") == CHANGED) & F.when(F.col("_gone"), F.col("_before").isNull()).otherwise(F.col("_before").isNotNull() & same)
    steps = steps.where(~continued & ~idle)
    steps = steps.withColumns({"_until": F.lead("_at").over(along), "_to_nothing": F.coalesce(F.lead("_gone").over(along), F.lit(False))})
    # A stored version that still ends where it did stays as it was.
    cut = (F.col("_kind") == CHANGED) | F.coalesce(F.col("_until") != F.col("_version.EFF_TO"), F.lit(False))
    final = {
        "EFF_TO": F.when(cut, F.coalesce("_until", ntz(HIGH_DATE))).otherwise(F.col("_version.EFF_TO")),
        "IS_CURRENT": F.when(cut, F.col("_until").isNull()).otherwise(F.col("_version.IS_CURRENT")),
        "IS_DELETED": F.when(cut, F.col("_to_nothing")).otherwise(F.col("_version.IS_DELETED")),
    }
    spliced = steps.where(~F.col("_gone")).select(
        *[final.get(c, F.col(f"_version.`{c}`")).cast(kinds[c]).alias(c) for c in dim.columns]
    )
    return past.unionByName(spliced)
