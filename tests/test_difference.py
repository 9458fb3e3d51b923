"""Differences, refreshes and reconciliation that read only what changed."""

import random
from collections import Counter

import pytest
from conftest import AT, planned, rows, ts
from pyspark.sql import functions as F

from tidemark.layers import with_audit
from tidemark.operators import difference
from tidemark.operators.affected import _may_hold, bloom, refresh_silver
from tidemark.operators.difference import differing_keys
from tidemark.operators.reconcile import missing_keys
from tidemark.operators.silver import build_silver
from tidemark.operators.sketch import PARTS, cells_of, check_of, difference_cells, missing_keys_by_sketch, taken_apart
from tidemark.staging import stage

KV = "k long, t string, v double"
D = [None] + [ts(f"2024-01-{d:02d}") for d in range(1, 29)]


def plain(left, right):
    a, b = Counter(left), Counter(right)
    keys = {(k, t) for k, t, _ in [*a, *b]}
    out = []
    for key in keys:
        mine, theirs = ({r: n for r, n in side.items() if r[:2] == key} for side in (a, b))
        if mine != theirs:
            kind = "changed" if mine and theirs else "only_left" if mine else "only_right"
            out.append((*key, kind, sum(mine.values()), sum(theirs.values())))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,few", [(12, 10**6), (2, 0), (7, 20)])
def test_differing_keys(frame, bits, few):
    rng = random.Random(bits)
    left = [(rng.choice([None, *range(40)]), rng.choice("ab"), rng.choice([None, 1.0, 2.0])) for _ in range(120)]
    right = [r for r in left if rng.random() > 0.1] + [(i, "c", 1.0) for i in range(3)]
    right += [(k, t, 7.0) for k, t, _ in right[:5]] + [right[9]] * 2 + [left[3]] * 2  # repeats: exclusive-or alone cancels
    found = differing_keys(frame(left, KV), frame(right, KV).select("v", "t", "k"), ["K", "t"], bits, few)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(left, right)


def test_no_difference_and_nothing(frame):
    some = frame([(1, "a", 1.0), (None, None, None)], KV)
    assert differing_keys(some, some, ["k"]).isEmpty() and differing_keys(some.limit(0), some.limit(0), ["k"]).isEmpty()
    assert rows(differing_keys(some, some.limit(0), ["k"]), "k", "difference") == [(1, "only_left"), (None, "only_left")]
    for bad in ([], ["x"]):
        with pytest.raises((ValueError, KeyError)):
            differing_keys(some, some, bad)
    with pytest.raises(ValueError, match="right side"):
        differing_keys(some, some.drop("v"), ["k"])


def test_only_differing_prefixes_reach_the_comparison(spark):
    left = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = left.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    found = differing_keys(stage(left), stage(right), ["k"], few_rows=10)
    assert rows(found) == [(77, "changed", 1, 1)]
    plan = planned(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert difference.FEW_ROWS == 1_000_000


# ---- refresh by key

SCHEMA = "k long, wm timestamp_ntz, v string"


def raw_of(df):
    return with_audit(df, AT).withColumn("_IS_DELETED", F.col("v") == "-")


@pytest.mark.parametrize("seed", range(2))
def test_refresh_equals_a_full_build(frame, seed):
    rng = random.Random(seed)
    silver, seen = None, []
    for _ in range(3):
        delta = [(rng.choice([None, *range(200)]), rng.choice(D[1:]), rng.choice("abc-")) for _ in range(40)]
        seen += delta
        raw = raw_of(frame(seen, SCHEMA))
        full = build_silver(None, raw, ["k"], "wm")
        if silver is None:
            silver = full
        else:
            changed = frame(delta, SCHEMA).select("k").distinct()
            silver = refresh_silver(silver, raw, changed, ["k"], "wm")
        silver = stage(silver, "silver")
        assert rows(silver) == rows(full)
    again = refresh_silver(silver, raw, frame([], SCHEMA).select("k"), ["k"], "wm")
    assert rows(again) == rows(silver)
    with pytest.raises(ValueError):
        refresh_silver(silver, raw, silver, [], "wm")


def test_untouched_rows_are_not_shuffled(spark, frame):
    silver = stage(spark.range(5000).select(F.col("id").alias("k"), F.lit(D[1]).alias("wm"), F.lit("a").alias("v")))
    raw = stage(raw_of(silver.unionByName(frame([(5, D[9], "z"), (6000, D[9], "n")], SCHEMA))))
    changed = frame([(5,), (6000,)], "k long")
    fresh = refresh_silver(silver, raw, changed, ["k"], "wm")
    assert fresh.count() == 5001 and rows(fresh.where("v <> 'a'"), "k", "v") == [(5, "z"), (6000, "n")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a delta too large to broadcast
    try:
        parted = _may_hold(silver, ["k"], *bloom(changed, ["k"], 2))
        assert "Exchange hashpartitioning" not in planned(parted.where("NOT _maybe")) and parted.where("_maybe").count() < 50
        plan = planned(refresh_silver(silver, raw, changed, ["k"], "wm"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Kept rows and fresh ones meet the changed keys; nothing else is dealt out.
    assert plan.count("Exchange hashpartitioning") == 4 and plan.count("SortMergeJoin") == 2
    pages, bits = bloom(frame([(i,) for i in range(3000)], "k long"), ["k"], 3000)
    assert bits == 65_536 and pages.count() == 2


# ---- sketch

def test_a_sketch_is_taken_apart():
    cells = {}
    hashes = [random.Random(i).getrandbits(64) - 2**63 for i in range(200)]
    for n, h in enumerate(hashes):
        for c in cells_of(h, 600):
            own = cells.setdefault(c, [0, 0, 0])
            sign = 1 if n % 3 else -1
            cells[c] = [own[0] + sign, own[1] ^ h, own[2] ^ check_of(h)]
    found, complete = taken_apart([(c, *own) for c, own in cells.items()], 600)
    assert complete and found == {h: 1 if n % 3 else -1 for n, h in enumerate(hashes)}
    found, complete = taken_apart([(0, 2, 5, 5)], 600)
    assert not complete and not found


def test_spark_and_driver_agree_on_cells(frame):
    left = frame([(i, f"t{i}", 1.0) for i in range(50)] + [(None, None, 1.0)], KV)
    found = difference_cells(left, left.limit(0), ["k", "t"], 300).collect()
    hashes, complete = taken_apart([tuple(r) for r in found], 300)
    assert complete and len(hashes) == 51 and set(hashes.values()) == {1}
    assert len(found) <= 51 * PARTS


@pytest.mark.parametrize("cells", [300, 6])  # six cells are too few: all keys are compared
def test_missing_keys_by_sketch(frame, cells):
    keys = [(i, f"t{i % 7}", 1.0) for i in range(300)] + [(None, "n", 1.0), (5000, None, 1.0), (None, None, 1.0)]
    raw = with_audit(frame(keys, KV), AT).withColumn("_IS_DELETED", F.col("k") == 17)
    source = frame([k for k in keys[:-2] if k[0] is None or k[0] % 50] + [(9000 + i, "x", 1.0) for i in range(9)], "k int, t string, v double")
    source = source.union(source.limit(0))
    got = missing_keys_by_sketch(raw, source, ["k", "t"], cells)
    assert rows(got) == rows(missing_keys(raw, source, ["k", "t"])) and got.count() == 8
    assert missing_keys_by_sketch(raw.where("NOT _IS_DELETED"), raw.where("NOT _IS_DELETED"), ["k", "t"], 300).isEmpty()
    twice = raw.unionByName(raw)
    assert rows(missing_keys_by_sketch(twice, source, ["k", "t"], 300)) == rows(missing_keys(raw, source, ["k", "t"]))
