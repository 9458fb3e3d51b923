"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions alone.

Sources share all words by weight, none above CAP times what it has.  A document is expected in the mix as often as its
source's target asks (in proportion to its merit, if documents have one, and CAP times at most).  The whole part of that
number is certain.  The fraction is an inclusion probability: documents are ranked by the odds of a random number over the odds
of that probability, and a source takes the beginning of its ranking, as many words as its target still lacks.  Where the next
document would go beyond, the gap is closed by the first further documents in the ranking that fit it, CLOSINGS times; no source
ends above its target.

Random numbers are digests of id, source, text and a running number among equal rows, so reruns agree however rows are
partitioned.  A ranking is never gathered: sizes are added up in about the square root of a source's documents many slices of
the ranking, the slice in which the target is reached is found from these sums, and only that slice is ranked row by row.

A null text has no words and a null source is a source, the last one; documents without words take part and take nothing; each of
several equal rows is drawn for itself; null ids are ids like others; an empty table gives an empty table.  A null, negative or
non-finite merit is none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

WEIGHTS = (5, 2, 1)
CAP = 3
CLOSINGS = 4  # times that gaps are closed
EQUAL_ROWS = 10_000  # equal rows drawn in one task
SEED = "mix"

WORD, BETWEEN = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text.  Each becomes one letter before letters are counted, so no list of words is made."""
    letters = F.regexp_replace(F.regexp_replace(text, WORD, "w"), BETWEEN, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def _rows(docs: DataFrame, merit: str | None) -> DataFrame:
    """Distinct documents without their texts, and how often each occurs."""
    value = F.lit(1.0) if merit is None else F.col(f"`{merit}`").cast("double")
    good = value.isNotNull() & ~F.isnan(value) & (value > 0) & (value < float("inf"))
    narrow = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-")).alias("digest"),
        F.when(good, value).otherwise(0.0).alias("merit"),
    )
    return narrow.groupBy("doc_id", "source", "size", "digest", "merit").agg(F.count(F.lit(1)).alias("number"))


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``nth, source, source_size, target`` of each source; ``rows`` have ``source, size, number``.

    Sources without a cap share what capped ones leave, by weight, until no share is above its cap.  What passes through the
    driver is the share of weight one.
    """
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("number")).alias("source_size"))
    # Numbered in order: the place within a task, after the sizes of the tasks before it.
    ordered = stage(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()), "sources")
    ordered = ordered.withColumn("_task", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("_task").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    nth = F.col("_start") + F.col("_at")
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    weight = F.get(cycle, F.pmod(nth, F.lit(len(weights))).cast("int"))
    most = F.col("source_size") * cap
    shares = ordered.join(starts, "_task").select(nth.alias("nth"), "source", "source_size", weight.alias("weight"), most.alias("most"))
    shares = stage(shares, "shares")
    total = shares.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.col("most") < F.lit(level) * F.col("weight")
        found = shares.agg(
            F.count_if(above).alias("capped"),
            F.sum(F.when(above, F.col("most")).otherwise(0)).alias("given"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if found["capped"] == capped or not found["weight"]:
            break
        capped, level = found["capped"], (total - found["given"]) / found["weight"]
    share = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    return shares.select("nth", "source", "source_size", share.alias("target"))


def _levelled(rows: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """``nth, level`` of each source: documents are expected ``level * merit`` times, ``cap`` at most, to give its target.

    Where merits are too few for the target, all documents that have one reach the cap.
    """
    words = F.col("size") * F.col("number")
    known = stage(rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select("nth", "target", "merit", words.alias("words")), "merits")
    known = stage(known.groupBy("nth", "target", "merit").agg(F.sum("words").alias("words")).where("merit > 0"), "merits")
    levels = stage(known.groupBy("nth").agg(F.lit(0.0).alias("level"), F.lit(-1).cast("long").alias("capped")), "levels")
    while True:
        above = F.col("merit") * F.col("level") > cap
        following = known.join(levels, "nth").groupBy("nth", "target", "level", F.col("capped").alias("before")).agg(
            F.count_if(above).alias("capped"),
            F.sum(F.when(above, F.col("words") * cap).otherwise(0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("merit") * F.col("words"))).alias("rest"),
        )
        moved = F.col("capped") != F.col("before")
        raised = F.when(moved & (F.col("rest") > 0), (F.col("target") - F.col("given")) / F.col("rest")).otherwise(F.col("level"))
        levels = stage(following.select("nth", raised.alias("level"), "capped", moved.alias("moved")), "levels")
        if levels.where("moved").isEmpty():
            return levels.select("nth", "level")
        levels = levels.drop("moved")


def _each(rows: DataFrame, seed: str) -> DataFrame:
    """One row per document with its random number; many equal rows are dealt over tasks."""
    few = rows.where(F.col("number") <= EQUAL_ROWS).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "number")))
    begin = F.explode(F.sequence(F.lit(1).cast("long"), "number", F.lit(EQUAL_ROWS).cast("long")))
    many = rows.where(F.col("number") > EQUAL_ROWS).withColumn("_begin", begin).repartition("digest", "_begin")
    last = F.least(F.col("_begin") + (EQUAL_ROWS - 1), F.col("number"))
    many = many.withColumn("_copy", F.explode(F.sequence("_begin", last))).drop("_begin")
    name = F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("source", F.lit("-")), "digest", F.col("_copy").cast("string")
    )
    digest = F.md5(name.cast("binary"))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    random = (number.cast("double") + 0.5) / float(2**52)
    return few.unionByName(many).withColumn("random", random).withColumn("tie", F.substring(digest, 14, 19))


def _first(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """``items`` with those chosen that come first in their source's ranking, ``room`` words of ``wanted`` at most.

    Only items not yet chosen that fit the room by themselves stand in line.
    """
    slices = F.greatest(F.ceil(F.sqrt(F.col("documents"))), F.lit(1)).cast("long")
    # A ranking has no hot source: wanted holds one row per source, and items are joined, not shuffled, where it is small.
    lined = items.join(wanted, "nth").withColumn(
        "_slice", F.when(~F.col("chosen") & (F.col("size") > 0) & (F.col("chance") > 0) & (F.col("size") <= F.col("room")), F.floor(F.col("rank") * slices))
    )
    sums = lined.where("_slice IS NOT NULL").groupBy("nth", "_slice", "room").agg(F.sum("size").alias("words"))
    upward = Window.partitionBy("nth").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = sums.withColumn("until", F.sum("words").over(upward)).where(F.col("until") > F.col("room"))
    # Of the slices that go beyond, the first is the edge.
    edge = stage(
        reached.groupBy("nth").agg(F.min_by(F.struct(F.col("_slice").alias("slice"), (F.col("until") - F.col("words")).alias("before")), "_slice").alias("edge")),
        "edges",
    )
    lined = lined.join(edge, "nth", "left")
    below = F.col("_slice").isNotNull() & (F.col("edge").isNull() | (F.col("_slice") < F.col("edge.slice")))
    at_edge = F.coalesce(F.col("_slice") == F.col("edge.slice"), F.lit(False))
    along = Window.partitionBy("nth").orderBy("rank", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = lined.where(at_edge).withColumn("_so_far", F.col("edge.before") + F.sum("size").over(along))
    near = near.withColumn("chosen", F.col("_so_far") <= F.col("room"))
    far = lined.where(~at_edge).withColumn("chosen", F.col("chosen") | below)
    return near.select(*items.columns).unionByName(far.select(*items.columns))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, merit: str | None = None, seed: str = SEED
) -> DataFrame:
    """One row per document: ``doc_id, source, digest, size, source_size, target, copies, taken``.

    ``digest`` tells texts apart (see ``texts``); ``copies`` is how often the mix takes the document, ``taken`` the words of that.
    """
    rows = stage(_rows(docs, merit), "documents")
    sources = stage(targets(rows, weights, cap), "targets")
    known = sources
    if merit is None:
        known = known.withColumn("level", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    else:
        known = known.join(_levelled(rows, sources, cap), "nth", "left").fillna(0.0, ["level"])
    known = known.withColumnRenamed("source", "_source")
    expected = F.least(F.col("level") * F.col("merit"), F.lit(float(cap)))
    whole = F.floor("expected")
    chance_odds = F.col("chance") / (1 - F.col("chance"))
    odds = F.col("random") / (1 - F.col("random")) / chance_odds
    items = (
        _each(rows, seed)
        .join(known, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("expected", expected)
        .withColumn("whole", whole)
        .withColumn("chance", F.col("expected") - F.col("whole"))
        .withColumn("odds", F.when(F.col("chance") > 0, odds))
        .withColumn("rank", F.col("odds") / (1 + F.col("odds")))
        .select("doc_id", "source", "digest", "size", "nth", "source_size", "target", "whole", "chance", "rank", "tie", F.lit(False).alias("chosen"))
    )
    items = stage(items, "items")
    for _ in range(1 + CLOSINGS):
        copies = F.col("whole") + F.col("chosen").cast("long")
        lacking = F.col("target") - F.sum(copies * F.col("size"))
        left = F.min(F.when(~F.col("chosen") & (F.col("size") > 0) & (F.col("chance") > 0), F.col("size")))
        wanted = items.groupBy("nth", "target").agg(lacking.alias("room"), left.alias("left"), F.count(F.lit(1)).alias("documents"))
        wanted = stage(wanted.select("nth", "room", "documents", (F.col("left") <= F.col("room")).alias("more")), "wanted")
        if wanted.where("more").isEmpty():
            break
        items = stage(_first(items, wanted.drop("more")), "items")
    return items.withColumn("copies", F.col("whole") + F.col("chosen").cast("long")).select(
        "doc_id", "source", "digest", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: ``doc_id, source, text``, one row per copy taken."""
    names = [F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "digest")]
    counted = mixed.groupBy(*names).agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    rows = rows.withColumn("digest", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-")))
    distinct = rows.dropDuplicates(["doc_id", "source", "digest"])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "source", "digest")]
    taken = distinct.join(counted, same)
    return taken.select("doc_id", "source", "text", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("copy")).drop("copy")


# The query in SQL.  The share of weight one comes from sources in the order in which they reach their caps; the ranking is
# followed row by row.
REFERENCE = rf"""WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size,
         coalesce(md5(text), '-') AS digest FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, digest) AS copy FROM docs),
sizes AS (SELECT source, sum(size)::bigint AS source_size FROM docs GROUP BY source),
shares AS (SELECT *, 3 * source_size AS most,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::bigint AS weight FROM sizes),
steps AS (SELECT 0::double AS level, -1::bigint AS capped, 0 AS step
  UNION ALL
  SELECT CASE WHEN f.weight > 0 THEN (f.total - f.given)::double / f.weight ELSE level END, f.capped, step + 1
  FROM (SELECT s.level, s.step, s.capped AS before, count(*) FILTER (most < s.level * weight)::bigint AS capped,
          coalesce(sum(most) FILTER (most < s.level * weight), 0)::bigint AS given, sum(source_size)::bigint AS total,
          coalesce(sum(weight) FILTER (NOT most < s.level * weight), 0)::bigint AS weight
        FROM steps s, shares GROUP BY ALL) f
  WHERE f.capped <> f.before AND f.weight > 0),
lev AS (SELECT max_by(level, step) AS level FROM steps),
known AS (SELECT source, source_size, least(most::double, level * weight) AS target FROM shares, lev),
drawn AS (SELECT n.*, k.source_size, k.target, CASE WHEN k.source_size > 0 THEN k.target / k.source_size ELSE 0 END AS expected,
    md5('{SEED}:' || coalesce(doc_id::varchar, '-') || ':' || coalesce(n.source, '-') || ':' || digest || ':' || copy::varchar) AS h
  FROM numbered n JOIN known k ON k.source IS NOT DISTINCT FROM n.source),
chances AS (SELECT *, floor(least(expected, 3))::bigint AS whole, least(expected, 3) - floor(least(expected, 3)) AS chance,
    (('0x' || substr(h, 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double AS random, substr(h, 14, 19) AS tie FROM drawn),
ranked AS (SELECT *, CASE WHEN chance > 0 THEN random / (1 - random) / (chance / (1 - chance)) END AS odds FROM chances),
r0 AS (SELECT * EXCLUDE (odds), odds / (1 + odds) AS rank, false AS chosen FROM ranked),
{{rounds}}
SELECT doc_id, source, digest, size, source_size, target, whole + chosen::bigint AS copies,
       (whole + chosen::bigint) * size AS taken FROM r{1 + CLOSINGS}""".replace(
    "{rounds}",
    ",\n".join(
        f"""q{n} AS (SELECT *, target - sum((whole + chosen::bigint) * size) OVER (PARTITION BY source) AS room FROM r{n}),
r{n + 1} AS (SELECT * EXCLUDE (room, lined, chosen), chosen OR (lined AND
    sum(CASE WHEN lined THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY NOT lined, rank, tie ROWS UNBOUNDED PRECEDING) <= room) AS chosen
  FROM (SELECT *, NOT chosen AND size > 0 AND chance > 0 AND size <= room AS lined FROM q{n}))"""
        for n in range(1 + CLOSINGS)
    ),
)
