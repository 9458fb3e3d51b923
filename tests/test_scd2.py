import pytest
from conftest import AT, planned, rows, ts
from pyspark.sql import functions as F

from tidemark.layers import with_audit
from tidemark.operators.lookup import fact_lookup
from tidemark.operators.scd2 import (
    as_of_versions, assign_surrogate, build_scd2, current_versions, scd2_changes, scd2_source,
    tracked_columns,
)
from tidemark.staging import stage

KV = "k long, wm timestamp_ntz, v string, note string"
D = [None] + [ts(f"2024-01-{d:02d}") for d in range(1, 29)]
HIGH = ts("9999-12-31")
LATER = ts("2024-02-02")


def raw_of(df, deleted=None, deleted_at=None):
    raw = with_audit(df, AT)
    if deleted is not None:
        raw = raw.withColumn("_IS_DELETED", deleted)
    if deleted_at is not None:
        raw = raw.withColumn("_DELETED_AT", F.lit(deleted_at).cast("timestamp_ntz"))
    return raw


def build(dim, df, as_of=AT, track=("v",), snapshot=False, **flags):
    return stage(build_scd2(dim, raw_of(df, **flags), ["k"], "wm", as_of, track, snapshot=snapshot))


def history(dim):
    return [
        (*r[:4], "open" if r[4] == HIGH else r[4], *r[5:])
        for r in rows(dim, "k", "v", "note", "EFF_FROM", "EFF_TO", "IS_CURRENT", "IS_DELETED")
    ]


@pytest.fixture
def first(frame):
    return build(None, frame([(1, D[1], "a", "x"), (2, D[1], "b", "x"), (3, D[1], "c", "x")], KV))


def test_first_build(first):
    assert history(first) == [(k, v, "x", D[1], "open", True, False) for k, v in ((1, "a"), (2, "b"), (3, "c"))]


def test_changed_new_and_untracked(frame, first):
    dim = build(first, frame([(1, D[2], "A", "x"), (2, D[2], "b", "CHANGED"), (4, D[2], "d", "x")], KV), LATER)
    assert history(dim) == [
        (1, "A", "x", D[2], "open", True, False),
        (1, "a", "x", D[1], D[2], False, False),
        (2, "b", "x", D[1], "open", True, False),  # only an untracked column changed: not written
        (3, "c", "x", D[1], "open", True, False),  # absent from RAW: stays current
        (4, "d", "x", D[2], "open", True, False),
    ]
    assert rows(dim.where("k = 4"), "_LOAD_TS") == [(LATER,)]


def test_a_repeated_build_changes_nothing(frame, first):
    delta = frame([(1, D[2], "A", "x"), (4, D[2], "d", "x")], KV)
    once = build(first, delta, LATER)
    assert rows(build(once, delta, ts("2024-03-01"))) == rows(once)


def test_versions_between_builds_collapse(frame, first):
    dim = build(first, frame([(1, D[2], "A", "x"), (1, D[3], "AA", "x")], KV))
    assert [h[:5] for h in history(dim) if h[0] == 1] == [(1, "AA", "x", D[3], "open"), (1, "a", "x", D[1], D[3])]


def test_delete_expires_without_successor(frame, first):
    gone = frame([(1, D[2], "A", "x"), (9, D[2], "never seen", "x")], KV)
    dim = build(first, gone, LATER, deleted=F.lit(True), deleted_at=D[5])
    assert [h for h in history(dim) if h[0] in (1, 9)] == [(1, "a", "x", D[1], D[5], False, True)]
    at_build = build(first, gone, LATER, deleted=F.lit(True))
    assert [h[4] for h in history(at_build) if h[0] == 1] == [LATER]


def test_a_returning_key_opens_a_version(frame, first):
    gone = build(first, frame([(1, D[2], "a", "x")], KV), LATER, deleted=F.lit(True), deleted_at=D[2])
    back = build(gone, frame([(1, D[3], "a", "x")], KV), LATER)
    assert [h for h in history(back) if h[0] == 1] == [
        (1, "a", "x", D[1], D[2], False, True), (1, "a", "x", D[3], "open", True, False),
    ]


def test_an_older_watermark_inverts_the_closed_interval(frame, first):
    dim = build(first, frame([(1, ts("2023-12-31"), "A", "x")], KV))
    assert [h[3:5] for h in history(dim) if h[:2] == (1, "a")] == [(D[1], ts("2023-12-31"))]
    assert rows(as_of_versions(dim.where("k = 1"), "2024-01-01"), "v") == [("A",)]


def test_a_complete_snapshot_deletes_absent_keys(frame, first):
    dim = build(first, frame([(1, D[2], "a", "x")], KV), LATER, snapshot=True)
    assert [(h[0], h[4], h[6]) for h in history(dim)] == [(1, "open", False), (2, LATER, True), (3, LATER, True)]


def test_null_hash_counts_as_equal_and_null_keys_match(frame, first):
    unknown = first.withColumn("ROW_HASH", F.lit(None).cast("long"))
    dim = build(unknown, frame([(1, D[2], "A", "x"), (None, D[2], "n", "x")], KV))
    assert [h[:2] for h in history(dim)] == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]
    again = build(dim, frame([(None, D[2], "n", "x")], KV))
    assert [h[:2] for h in history(again)] == [h[:2] for h in history(dim)]


def test_lookup_refuses_joins_that_keep_versions(frame, first):
    with pytest.raises(ValueError):
        fact_lookup(frame([(1, D[1])], "f long, at timestamp_ntz"), first, [("f", "k")], "at", how="full_outer")


def test_a_value_moving_between_tracked_columns_is_a_change(frame):
    dim = build(None, frame([(1, D[1], "a", None)], KV), track=())
    moved = build(dim, frame([(1, D[2], None, "a")], KV), track=())
    # wm differs as well, so track the two text columns alone
    dim = build(None, frame([(1, D[1], "a", None)], KV), track=("v", "note"))
    moved = build(dim, frame([(1, D[2], None, "a")], KV), track=("v", "note"))
    assert moved.count() == 2 and moved.where("IS_CURRENT").count() == 1


def test_tracked_columns():
    assert tracked_columns(["K", "A", "B"], ["k"]) == ["A", "B"]
    assert tracked_columns(["K", "J"], ["K", "J"]) == ["K", "J"]
    assert tracked_columns(["K", "A", "B"], ["K"], ["b"]) == ["B"]
    with pytest.raises(ValueError):
        tracked_columns(["K"], ["K"], ["X"])


def test_change_time_falls_back_to_load_time(frame):
    raw = raw_of(frame([(1, "2024-01-05 00:00:00", "a"), (2, "not a time", "b"), (3, None, "c")], "k long, wm string, v string"))
    source = scd2_source(raw, ["k"], "wm", AT)
    assert rows(source, "k", "_ct") == [(1, D[5]), (2, AT), (3, AT)]
    assert rows(scd2_source(raw.drop("wm"), ["k"], None, LATER), "_ct") == [(LATER,)] * 3


def test_boundary_instants(frame, first):
    dim = build(first, frame([(1, D[2], "A", "x")], KV)).where("k = 1")
    assert rows(as_of_versions(dim, "2024-01-02"), "v") == [("A",)]
    assert rows(as_of_versions(dim, "2024-01-02", inclusive=True), "v") == [("A",), ("a",)]
    assert rows(as_of_versions(dim, "2023-12-01"), "v") == []
    assert rows(current_versions(dim)) == [(1, D[2], "A", "x", D[2])]


def test_surrogates_are_dense_and_follow_the_key(frame):
    new = frame([(None, k, "v") for k in range(40, 0, -1)], "DIM_KEY long, k long, v string").repartition(6)
    assert rows(assign_surrogate(new, ["k"], base=100).orderBy("k"), "k", "DIM_KEY") == sorted(
        [(k, 100 + k) for k in range(1, 41)], key=lambda t: [(False, str(v)) for v in t]
    )


def test_one_shuffle_per_side(spark, frame, first):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = scd2_source(raw_of(first.select("k", "wm", "v", "note")), ["k"], "wm", AT, ["v"])
        plan = planned(scd2_changes(first.where("IS_CURRENT"), source, ["k"], AT))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FullOuter") == 1
    assert "SinglePartition" not in plan and "NestedLoop" not in plan


# --- fact lookup -------------------------------------------------------------

VERSIONS = "key long, EFF_FROM timestamp_ntz, EFF_TO timestamp_ntz, label string"
FACTS = "id long, fk int, at timestamp_ntz"


def expected(facts, versions, how, inclusive):
    out = []
    for f in facts:
        known = f[1] is not None and f[2] is not None
        hits = [v for v in versions if known and v[0] == f[1] and (v[1] <= f[2] < v[2] or inclusive and v[1] <= f[2] == v[2])]
        if how in ("inner", "left"):
            out += [(f[0], v[3]) for v in hits] or ([(f[0], None)] if how == "left" else [])
        elif bool(hits) == (how == "left_semi"):
            out.append((f[0],))
    return sorted(out, key=str)


def lookup_rows(overlapping):
    import random
    from datetime import timedelta

    rng = random.Random(7)
    versions, facts = [], []
    for key in range(6):
        moment = D[1]
        for n in range(rng.choice([1, 3, 60])):
            length = rng.choice([0, 7, 60, 600, -5])  # zero-length and inverted ones too
            versions.append((key, moment, moment + timedelta(minutes=length), f"{key}/{n}"))
            step = rng.choice([0, 7, 60, 600])  # gaps
            moment += timedelta(minutes=step if overlapping else max(length, 0) + rng.choice([0, step]))
        versions.append((key, moment, HIGH, f"{key}/last"))
        if overlapping and key % 2:
            versions.append((key, D[1] - timedelta(days=3), D[1] + timedelta(hours=9), f"{key}/overlap"))
    versions.append((None, D[1], HIGH, "none"))
    for i in range(300):
        facts.append((i, rng.randrange(7), D[1] + timedelta(minutes=rng.randrange(-600, 9000))))
    for i, v in enumerate(versions):  # exactly on the boundaries
        facts += [(1000 + 2 * i, v[0], v[1]), (1001 + 2 * i, v[0], v[2])]
    facts += [(5000 + i, 2, D[3]) for i in range(500)] + [(6000, 2, None), (6001, None, D[2])]  # a hot instant
    return facts, versions


@pytest.mark.parametrize("overlapping", [False, True])
@pytest.mark.parametrize("range_rows,how,inclusive", [
    (1, "inner", False), (10**6, "left", False), (1, "left", True), (1, "left_semi", False), (1, "left_anti", True), (10**6, "inner", True),
    (10**6, "left_semi", True), (1, "left_anti", False),
])
def test_lookup_equals_brute_force(frame, how, range_rows, inclusive, overlapping):
    facts, versions = lookup_rows(overlapping)
    found = fact_lookup(
        frame(facts, FACTS).repartition(3), frame(versions, VERSIONS), [("fk", "key")], "at", how, inclusive, range_rows=range_rows
    )
    shown = found.select("id", "label") if how in ("inner", "left") else found.select("id")
    assert sorted((tuple(r) for r in shown.collect()), key=str) == expected(facts, versions, how, inclusive)


def test_lookup_of_nothing(frame):
    none, dim = frame([], FACTS), frame([(1, D[1], HIGH, "a")], VERSIONS)
    assert fact_lookup(none, dim, [("fk", "key")], "at", "left").count() == 0
    facts = frame([(1, 1, D[2])], FACTS)
    assert rows(fact_lookup(facts, dim.limit(0), [("fk", "key")], "at", "left"), "id", "label") == [(1, None)]


def test_a_hot_key_is_swept_in_ranges(spark, frame):
    facts = spark.range(3000).select("id", (F.col("id") % 1 + 1).cast("int").alias("fk"), (F.lit(D[1]).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("at"))
    dim = frame([(1, D[n], D[n + 1], str(n)) for n in range(1, 5)], VERSIONS)
    found = fact_lookup(facts, dim, [("fk", "key")], "at", "left", range_rows=500)
    assert rows(found.groupBy("label").count()) == [("1", 1440), ("2", 1440), ("3", 120)]
    plan = planned(found)
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Window" in plan
    # Facts are dealt by key and range in one exchange, beside the versions.
    assert "hashpartitioning(_k0" in plan and "_range" in plan[plan.index("hashpartitioning(_k0"):]
