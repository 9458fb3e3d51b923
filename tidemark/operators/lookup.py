"""Lookup of facts in a versioned dimension by a sweep over time.

Facts and versions are put in one order, by key and time, and every fact takes the last version that started before it.  Tasks
hold ranges of that order: a key with a large share of all rows is cut at moments taken from a sample, and the version in force
at a cut is carried over it into the next range.  An instant that by itself holds more than a range is dealt over several tasks,
each of which gets the versions.  Nothing is compared with more than one version, however long histories are.

Only versions that overlap another of their key cannot be swept.  They are found while versions are sorted; the keys that have
any are joined on key and range instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.staging import stage

JOINS = ("inner", "left", "left_semi", "left_anti")
RANGE_ROWS = 1_000_000  # rows that one task sweeps without being cut
PER_CUT = 20  # sampled rows for each cut

CARRIED, STARTED, FACT = 0, 1, 2


def covers(moment: Column, inclusive: bool) -> Column:
    start = moment >= F.col("EFF_FROM")
    return start & ((moment <= F.col("EFF_TO")) if inclusive else (moment < F.col("EFF_TO")))


def _all_known(names: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return known


def _cuts(events: DataFrame, names: Sequence[str], range_rows: int) -> DataFrame | None:
    """Per key that has any, the moments at which its rows are cut and how many cuts fell on each.

    The sample, and the one task that orders it, hold PER_CUT rows for each shuffle partition.
    """
    total = events.count()
    number = min(math.ceil(total / range_rows), int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if number < 2:
        return None
    place = F.row_number().over(Window.orderBy(*names, "_at"))
    sampled = events.sample(min(1.0, number * PER_CUT / total), seed=1).withColumn("_place", place)
    cuts = sampled.where(F.col("_place") % PER_CUT == 0).groupBy(*names, "_at").agg(F.count(F.lit(1)).alias("tasks"))
    moments = F.sort_array(F.collect_list(F.struct(F.col("_at").alias("at"), "tasks")))
    return stage(cuts.groupBy(*names).agg(moments.alias("_cuts")), "cuts")


def _range_of(moment: Column) -> Column:
    """Number of the range that holds a moment; 0 where the key is not cut."""
    return F.coalesce(F.size(F.filter("_cuts", lambda cut: cut["at"] <= moment)), F.lit(0))


def _ranged(df: DataFrame, names: Sequence[str], cuts: DataFrame | None) -> DataFrame:
    """``df`` with ``_range`` of its ``_at``, ``_tasks`` of that range, and ``_cuts`` of its key."""
    if cuts is None:
        return df.withColumns({"_range": F.lit(0), "_tasks": F.lit(1).cast("long"), "_cuts": F.lit(None)})
    joined = df.join(cuts, list(names), "left").withColumn("_range", _range_of(F.col("_at")))
    return joined.withColumn("_tasks", F.coalesce(F.get("_cuts", F.col("_range") - 1)["tasks"], F.lit(1).cast("long")))


def _earlier(df: DataFrame, names: Sequence[str], cuts: DataFrame, value: Column) -> DataFrame:
    """``_range, _tasks, _at, carried`` of each range after the first: the aggregate ``value`` of the last range before it that has one.

    One row per cut, so a key has no more rows here than there are shuffle partitions.
    """
    own = df.where("_cuts IS NOT NULL").groupBy(*names, "_range").agg(value.alias("_value"))
    grid = cuts.select(*names, F.posexplode("_cuts").alias("_place", "_cut")).select(
        *names, (F.col("_place") + 1).alias("_range"), F.col("_cut.tasks").alias("_tasks"), F.col("_cut.at").alias("_at")
    )
    first = cuts.select(*names, F.lit(0).alias("_range"), F.lit(None).alias("_tasks"), F.lit(None).alias("_at"))
    along = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    filled = grid.unionByName(first).join(own, [*names, "_range"], "left")
    return filled.withColumn("carried", F.last("_value", ignorenulls=True).over(along)).where("_range > 0").drop("_value")


def _marked(versions: DataFrame, names: Sequence[str], cuts: DataFrame | None) -> DataFrame:
    """Versions with their range, and whether an earlier one of the key still lasts when they start."""
    ranged = _ranged(versions, names, cuts)
    along = Window.partitionBy(*names, "_range").orderBy("_at", "_end").rowsBetween(Window.unboundedPreceding, -1)
    marked = ranged.withColumn("_until", F.max("_end").over(along))
    if cuts is not None:
        # Over ranges the latest end so far counts, not that of the last range.
        ends = _earlier(ranged, names, cuts, F.max("_end"))
        so_far = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = ends.select(*names, "_range", F.max("carried").over(so_far).alias("_before"))
        marked = marked.join(ends, [*names, "_range"], "left").withColumn("_until", F.greatest("_until", "_before")).drop("_before")
    overlaps = F.coalesce(F.col("_until") > F.col("_at"), F.lit(False))
    return stage(marked.withColumn("_overlaps", overlaps).drop("_until", *(["_cuts"] if cuts is None else [])), "versions")


def _swept(facts: DataFrame, versions: DataFrame, names: Sequence[str], cuts: DataFrame | None) -> DataFrame:
    """``_fact, _version`` of each fact; the version is NULL where none is in force."""
    columns = [*names, "_range", "_salt", "_at", "_kind", "_fact", "_version"]
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tasks") - 1))
    facts = facts.withColumns({"_kind": F.lit(FACT), "_salt": F.pmod(F.monotonically_increasing_id(), F.col("_tasks"))})
    facts = facts.withColumn("_version", F.lit(None).cast(versions.schema["_version"].dataType))
    nothing = F.lit(None).cast(facts.schema["_fact"].dataType)
    events = facts.select(*columns)
    starts = versions.withColumns({"_kind": F.lit(STARTED), "_salt": salts, "_fact": nothing})
    events = events.unionByName(starts.select(*columns))
    if cuts is not None:
        carried = _earlier(versions, names, cuts, F.max_by("_version", "_at")).where("carried IS NOT NULL")
        carried = carried.withColumns({"_kind": F.lit(CARRIED), "_salt": salts, "_fact": nothing, "_version": F.col("carried")})
        events = events.unionByName(carried.select(*columns))
    along = Window.partitionBy(*names, "_range", "_salt").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("_version", F.last("_version", ignorenulls=True).over(along)).where(F.col("_kind") == FACT)
    return found.select(*names, "_at", "_fact", F.when(F.col("_at") < F.col("_version.EFF_TO"), F.col("_version")).alias("_version"))


def _overlapping(facts: DataFrame, versions: DataFrame, names: Sequence[str], cuts: DataFrame | None, inclusive: bool, how: str) -> DataFrame:
    """Facts and versions joined on key and range: each version stands in all ranges it reaches into."""
    last = _range_of(F.col("_end")) if cuts is not None else F.lit(0)
    spread = versions.withColumn("_range", F.explode(F.sequence(F.col("_range"), last)))
    other = spread.select(*[F.col(c).alias(f"_v{c}") for c in (*names, "_range", "_at", "_end")], "_version")
    match = (F.col("_at") >= F.col("_v_at")) & ((F.col("_at") <= F.col("_v_end")) if inclusive else (F.col("_at") < F.col("_v_end")))
    for c in (*names, "_range"):
        match = match & (F.col(c) == F.col(f"_v{c}"))
    return facts.join(other, match, how)


def fact_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    moment: str,
    how: str = "inner",
    inclusive: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Join facts to the dimension version in force at the fact's ``moment``.

    ``on`` pairs fact and dimension key columns; the dimension must not repeat a
    fact column name.  ``how`` keeps to JOINS, whose rows come from facts.  With
    ``inclusive`` versions also cover the instant they end at, where a fact then
    finds two.  Versions that overlap are all found.  A NULL key or moment finds
    nothing, and neither does anything find a version that ends before it starts.
    """
    how = how.lower().replace("leftsemi", "left_semi").replace("leftanti", "left_anti").replace("left_outer", "left")
    if how not in JOINS:
        raise ValueError(f"how must be one of {', '.join(JOINS)}")
    names = [f"_k{i}" for i in range(len(on))]
    fact_keys = [F.col(f"`{f}`").alias(n) for (f, _), n in zip(on, names)]
    dim_keys = [F.col(f"`{d}`").alias(n) for (_, d), n in zip(on, names)]
    everything = fact.select(*fact_keys, F.col(f"`{moment}`").alias("_at"), F.struct(*[F.col(f"`{c}`") for c in fact.columns]).alias("_fact"))
    usable = _all_known([*names, "_at"])
    facts, rest = everything.where(usable), everything.where(~usable)
    whole = dim.select(*dim_keys, F.col("EFF_FROM").alias("_at"), F.col("EFF_TO").alias("_end"), F.struct(*[F.col(f"`{c}`") for c in dim.columns]).alias("_version"))
    whole = whole.where(_all_known(names))
    # An instant more or less: what only lasts for the instant it ends at cannot be swept.
    versions = whole.where(F.col("_at") < F.col("_end"))

    cuts = _cuts(facts.select(*names, "_at").union(versions.select(*names, "_at")), names, range_rows)
    marked = _marked(versions, names, cuts)
    facts = _ranged(facts, names, cuts)
    version_type = marked.schema["_version"].dataType
    nothing = F.lit(None).cast(version_type).alias("_version")
    keeps_unmatched, pairs = how in ("left", "left_anti"), how in ("inner", "left")

    parts = []
    stray = marked.where("_overlaps")
    if not stray.isEmpty():
        keys = stage(stray.select(*names).distinct(), "overlapping")
        own = _ranged(whole.where(F.col("_at") <= F.col("_end")), names, cuts) if inclusive else marked
        joined = _overlapping(
            facts.join(keys, names, "left_semi"), own.join(keys, names, "left_semi"), names, cuts, inclusive, how
        )
        parts.append(joined.select("_fact", "_version") if pairs else joined.select("_fact", nothing))
        facts, marked = facts.join(keys, names, "left_anti"), marked.join(keys, names, "left_anti")
        whole = whole.join(keys, names, "left_anti")

    swept = _swept(facts, marked, names, cuts)
    found, missed = swept.where("_version IS NOT NULL"), swept.where("_version IS NULL")
    if inclusive:
        ends = whole.where(F.col("_at") <= F.col("_end")).select(*names, F.col("_end").alias("_at"), "_version")
        if pairs:
            touched = facts.select(*names, "_at", "_fact").join(ends, [*names, "_at"])
            parts += [found.select("_fact", "_version"), touched.select("_fact", "_version")]
        elif how == "left_semi":
            parts += [found.select("_fact", nothing), missed.join(ends, [*names, "_at"], "left_semi").select("_fact", nothing)]
        if keeps_unmatched:
            parts.append(missed.join(ends, [*names, "_at"], "left_anti").select("_fact", nothing))
    else:
        parts.append({"inner": found, "left": swept, "left_semi": found, "left_anti": missed}[how].select("_fact", "_version"))
    if keeps_unmatched:
        parts.append(rest.select("_fact", nothing))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    shown = [F.col(f"_fact.`{c}`").alias(c) for c in fact.columns]
    if pairs:
        shown += [F.col(f"_version.`{c}`").alias(c) for c in dim.columns]
    return out.select(*shown)
