"""SCD2: versioned history of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import change_time, ntz, row_hash
from tidemark.layers import DIM_KEY, NTZ, business_columns, is_deleted
from tidemark.operators.dedupe import key_struct, latest_per_key
from tidemark.operators.lookup import covers
from tidemark.staging import stage

HIGH_DATE = "9999-12-31 00:00:00"
HashFunction = Callable[[Sequence[T.StructField]], Column]

KEEP, CLOSED, NEW = "keep", "closed", "new"


def tracked_columns(business: Sequence[str], keys: Sequence[str], track: Sequence[str] = ()) -> list[str]:
    """Columns whose change opens a version: the given ones, else all non-key, else all."""
    if track:
        wanted = {c.upper() for c in track}
        unknown = wanted - {c.upper() for c in business}
        if unknown:
            raise ValueError(f"tracked columns not in the table: {sorted(unknown)}")
        order = {c.upper(): c for c in business}
        return [order[c.upper()] for c in track]
    key_set = {k.upper() for k in keys}
    return [c for c in business if c.upper() not in key_set] or list(business)


def scd2_source(
    raw: DataFrame,
    keys: Sequence[str],
    watermark: str | None,
    as_of: object,
    track: Sequence[str] = (),
    hash_function: HashFunction = row_hash,
) -> DataFrame:
    """Latest RAW row per key with the keys as ``_key``, delete flag, delete time, change time and hash."""
    business = business_columns(raw)
    fields = {f.name: f for f in raw.schema.fields}
    keyed = raw.select(*business, "_IS_DELETED", "_DELETED_AT", key_struct(keys).alias("_key"))
    latest = latest_per_key(keyed, keys, watermark, by="_key")
    return latest.select(
        *business,
        "_key",
        is_deleted().alias("_is_del"),
        F.col("_DELETED_AT").alias("_del_at"),
        change_time(raw.schema, watermark, as_of).alias("_ct"),
        hash_function([fields[c] for c in tracked_columns(business, keys, track)]).alias("_hash"),
    )


def scd2_changes(
    current: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: object,
    batch_id: str | None = None,
    snapshot: bool = False,
) -> DataFrame:
    """What one build does to the current versions, one row per resulting version.

    ``_op`` is ``keep`` (unchanged), ``closed`` (expired by this build) or ``new``.
    A version expires when its key is deleted or its hash differs (a NULL hash
    counts as equal); every live key left without a current version gets a new one.
    With ``snapshot`` the source is complete, so a key it lacks counts as deleted;
    otherwise such a key stays current.  A change older than the current version has
    no place here: ``late_keys`` names such keys, ``splice_scd2`` takes them.

    Both inputs hold one row per key, so the full outer join has no hot key, and
    the source side reuses the partitioning of its latest-row window.  A joined
    row yields up to two versions, emitted by one ``inline`` instead of three
    passes over the join.
    """
    business = [c for c in business_columns(current)]
    surrogate = DIM_KEY.name in current.columns
    target = current.select(
        *[F.col(f"`{c}`").alias(f"_t_{c}") for c in current.columns], F.lit(True).alias("_old"), key_struct(keys).alias("_t_key")
    )
    # NULL keys are one key, as in the latest-row window, so a rerun changes nothing.
    joined = target.join(source, F.col("_t_key") == F.col("_key"), "full_outer")

    has_source = F.col("_is_del").isNotNull()
    has_target = F.col("_old").isNotNull()
    differs = F.coalesce(F.col("_t_ROW_HASH") != F.col("_hash"), F.lit(False))
    gone = has_target & (~has_source if snapshot else F.lit(False))
    deleted = F.coalesce(F.col("_is_del"), F.lit(True))
    expire = gone | (has_target & has_source & (F.col("_is_del") | differs))
    insert = has_source & ~F.col("_is_del") & (~has_target | differs)

    kinds = {f.name: f.dataType for f in current.schema.fields}

    def version(op: str, overrides: dict[str, Column], business_from: str) -> Column:
        out = [F.lit(op).alias("_op")]
        for c in current.columns:
            if c in overrides:
                col = overrides[c]
            elif c in business:
                col = F.col(f"`{business_from}{c}`")
            else:
                col = F.col(f"`_t_{c}`")
            out.append(col.cast(kinds[c]).alias(c))
        return F.struct(*out)

    old = F.when(
        expire,
        version(
            CLOSED,
            {
                "EFF_TO": F.when(deleted, F.greatest("_t_EFF_FROM", F.coalesce("_del_at", ntz(as_of)))).otherwise(F.col("_ct")),
                "IS_CURRENT": F.lit(False),
                "IS_DELETED": F.coalesce("_t_IS_DELETED", F.lit(False)) | deleted,
            },
            "_t_",
        ),
    ).when(has_target, version(KEEP, {}, "_t_"))
    fresh = {
        "EFF_FROM": F.col("_ct"),
        "EFF_TO": ntz(HIGH_DATE),
        "IS_CURRENT": F.lit(True),
        "IS_DELETED": F.lit(False),
        "ROW_HASH": F.col("_hash"),
        "_LOAD_TS": ntz(as_of),
        "_BATCH_ID": F.lit(batch_id).cast("string"),
    }
    if surrogate:
        fresh[DIM_KEY.name] = F.lit(None)
    new = F.when(insert, version(NEW, fresh, ""))
    return joined.select(F.inline(F.array(old, new))).where(F.col("_op").isNotNull())


def late_keys(current: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_key`` of the keys whose newest row differs from the current version and is older."""
    versions = current.select(key_struct(keys).alias("_key"), "EFF_FROM", "ROW_HASH")
    differs = F.coalesce(F.col("ROW_HASH") != F.col("_hash"), F.lit(False))
    older = ~F.col("_is_del") & differs & (F.col("_ct") < F.col("EFF_FROM"))
    return source.join(versions, "_key").where(older).select("_key")


def empty_dimension(source: DataFrame, surrogate: bool = False) -> DataFrame:
    """A dimension without versions, shaped after ``source`` (see ``scd2_source``)."""
    hash_type = source.schema["_hash"].dataType
    return source.limit(0).select(
        *([F.lit(None).cast("long").alias(DIM_KEY.name)] if surrogate else []),
        *[F.col(f"`{c}`") for c in source.columns if c not in ("_is_del", "_del_at", "_ct", "_hash", "_key")],
        F.lit(None).cast(NTZ).alias("EFF_FROM"),
        F.lit(None).cast(NTZ).alias("EFF_TO"),
        F.lit(None).cast("boolean").alias("IS_CURRENT"),
        F.lit(None).cast("boolean").alias("IS_DELETED"),
        F.lit(None).cast(hash_type).alias("ROW_HASH"),
        F.lit(None).cast(NTZ).alias("_LOAD_TS"),
        F.lit(None).cast("string").alias("_BATCH_ID"),
    )


def build_scd2(
    dim: DataFrame | None,
    raw: DataFrame,
    keys: Sequence[str],
    watermark: str | None,
    as_of: object,
    track: Sequence[str] = (),
    batch_id: str | None = None,
    hash_function: HashFunction = row_hash,
    snapshot: bool = False,
) -> DataFrame:
    """The dimension after one build.  Closed history passes through unshuffled."""
    if not keys:
        raise ValueError("a versioned dimension needs at least one key column")
    source = scd2_source(raw, keys, watermark, as_of, track, hash_function)
    if dim is None:
        dim = empty_dimension(source)
    changed = scd2_changes(dim.where("IS_CURRENT"), source, keys, as_of, batch_id, snapshot).drop("_op")
    history = dim.where(~F.col("IS_CURRENT") | F.col("IS_CURRENT").isNull())
    return history.unionByName(changed)


def assign_surrogate(new: DataFrame, order: Sequence[str], base: int = 0) -> DataFrame:
    """Fill ``DIM_KEY`` with ``base + 1, base + 2, ...`` in the order of ``order``.

    A global ``row_number`` would sort everything in one task.  Here the rows are
    range-partitioned and sorted, staged together with their position inside the
    partition, and each partition's offset comes from the row counts of the
    partitions before it (one small row per partition).
    """
    columns = new.columns
    sort = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    # Position inside a task is the low 33 bits, the task number the rest.
    placed = stage(
        new.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id()),
        "surrogate",
    )
    part, position = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per shuffle partition, so collecting it is bounded.
    offsets, total = [], base
    for row in sorted(sizes.collect(), key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["_n"]
    starts = new.sparkSession.createDataFrame(offsets, "_part long, _start long")
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        *[
            (F.col("_start") + position + 1).alias(c) if c == DIM_KEY.name else F.col(f"`{c}`")
            for c in columns
        ]
    )


# --- reading a dimension ---------------------------------------------------

def current_versions(dim: DataFrame) -> DataFrame:
    """Business columns and ``EFF_FROM`` of the current versions."""
    return dim.where("IS_CURRENT").select(*business_columns(dim), "EFF_FROM")


def as_of_versions(dim: DataFrame, moment: object, inclusive: bool = False) -> DataFrame:
    """Versions in force at ``moment``.

    A version ends where the next one starts, so the closed interval
    (``inclusive``) returns both at that instant; the default is half-open.
    """
    return dim.where(covers(ntz(moment), inclusive))
