"""RAW and SILVER operators."""

import pytest
from conftest import AT, exploded, planned, rows, ts
from pyspark.sql import functions as F

from tidemark.functions import fingerprint_columns, row_hash
from tidemark.layers import AUDIT, with_audit
from tidemark.operators import (
    apply_drift, build_silver, detect_drift, latest_per_key, missing_keys, replace_raw, soft_delete, upsert_raw,
)
from tidemark.operators.parity import fingerprint, parity_report
from tidemark.operators.reconcile import count_hits
from tidemark.staging import stage

KV = "k long, wm timestamp_ntz, v string"
D1, D2, D3 = ts("2024-01-01"), ts("2024-01-02"), ts("2024-01-03")


def raw_of(df, deleted=None):
    raw = with_audit(df, AT, "b1")
    return raw if deleted is None else raw.withColumn("_IS_DELETED", deleted)


# --- latest row per key ------------------------------------------------------

def test_newest_wins_and_null_watermarks_lose(frame):
    df = frame([(1, D1, "old"), (1, D2, "new"), (1, None, "none"), (2, None, "only"), (None, D1, "n1"), (None, D2, "n2")], KV)
    assert rows(latest_per_key(df, ["k"], "wm"), "k", "v") == [(1, "new"), (2, "only"), (None, "n2")]


def test_ties_are_settled_by_the_other_columns(frame):
    data = [(1, D1, v) for v in "acb"]
    for order in (data, data[::-1]):
        assert rows(latest_per_key(frame(order, KV).repartition(3), ["k"], "wm"), "v") == [("c",)]


def test_without_watermark_one_row_per_key_remains(frame):
    df = frame([(1, D1, "a"), (1, D1, "a"), (2, D1, "b")], KV)
    assert rows(latest_per_key(df, ["k"])) == [(1, D1, "a"), (2, D1, "b")]
    assert latest_per_key(df.select("k"), ["k"]).count() == 2


def test_rank_is_limited_before_the_shuffle(frame):
    plan = planned(latest_per_key(frame([(1, D1, "a")], KV).repartition(2), ["k"], "wm"))
    assert "row_number(), 1, Partial" in plan and "SinglePartition" not in plan


# --- RAW ---------------------------------------------------------------------

def test_replace_adds_audit_columns(frame):
    row = replace_raw(frame([(1, D1, "a")], KV), AT, "b7", "f.parquet").first()
    assert (row._LOAD_TS, row._SRC_FILE, row._BATCH_ID, row._IS_DELETED, row._DELETED_AT) == (AT, "f.parquet", "b7", False, None)


def test_upsert_updates_inserts_and_keeps(frame):
    raw = raw_of(frame([(1, D2, "one"), (2, D2, "two"), (None, D1, "null")], KV))
    delta = frame([(2, D1, "TWO"), (3, D1, "three"), (None, D2, "NULL")], KV)
    out = upsert_raw(raw, delta, ["k"], ts("2024-02-02"), "b2")
    assert out.columns == raw.columns
    assert rows(out, "k", "wm", "v", "_BATCH_ID") == [
        (1, D2, "one", "b1"),
        (2, D1, "TWO", "b1"),  # replaced although its watermark is older; audit columns stay
        (3, D1, "three", "b2"),
        (None, D1, "null", "b1"),
        (None, D2, "NULL", "b2"),  # a NULL key matches nothing
    ]


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_upsert_updates_every_copy_of_a_repeated_key(spark, frame, broadcast):
    raw = raw_of(frame([(1, D1, "a"), (1, D2, "b"), (2, D1, "c")], KV))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        delta = stage(frame([(1, D3, "x"), (9, D3, "y")], KV))
        assert rows(upsert_raw(raw, delta, ["k"], AT, "b2"), "k", "v") == [(1, "x"), (1, "x"), (2, "c"), (9, "y")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_composite_key_and_all_key_table(frame):
    raw = raw_of(frame([(1, 1, "a"), (1, 2, "b")], "a long, b long, v string"))
    delta = frame([(1, 2, "B"), (2, 1, "c")], "a long, b long, v string")
    assert rows(upsert_raw(raw, delta, ["a", "b"], AT), "a", "b", "v") == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c")]
    pairs = raw_of(frame([(1, 1)], "a long, b long"))
    out = upsert_raw(pairs, frame([(1, 1), (1, 2)], "a long, b long"), ["a", "b"], AT)
    assert rows(out, "a", "b") == [(1, 1), (1, 2)]


def test_upsert_twice_changes_nothing(frame):
    raw = raw_of(frame([(1, D1, "a"), (2, D1, "b")], KV))
    delta = frame([(2, D2, "B"), (3, D2, "c")], KV)
    once = stage(upsert_raw(raw, delta, ["k"], AT, "b2"))
    assert rows(upsert_raw(once, delta, ["k"], ts("2024-03-01"), "b3")) == rows(once)


def test_upsert_keeps_delete_flags_unless_revived(frame):
    raw = raw_of(frame([(1, D1, "a")], KV), F.lit(True)).withColumn("_DELETED_AT", F.lit(D1).cast("timestamp_ntz"))
    delta = frame([(1, D2, "b")], KV)
    assert rows(upsert_raw(raw, delta, ["k"], AT), "v", "_IS_DELETED", "_DELETED_AT") == [("b", True, D1)]
    revived = upsert_raw(raw, delta, ["k"], AT, revive=True)
    assert rows(revived, "v", "_IS_DELETED", "_DELETED_AT") == [("b", False, None)]


def test_upsert_needs_keys_and_takes_an_empty_delta(frame):
    raw = raw_of(frame([(1, D1, "a")], KV))
    with pytest.raises(ValueError):
        upsert_raw(raw, frame([], KV), [], AT)
    assert rows(upsert_raw(raw, frame([], KV), ["k"], AT)) == rows(raw)


def test_a_small_staged_delta_leaves_raw_unshuffled(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_of(spark.range(5000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' AS wm", "'v' AS v")).write.parquet(path)
    raw = spark.read.parquet(path)
    delta = stage(spark.range(5).selectExpr("id AS k", "timestamp_ntz'2024-01-02' AS wm", "'w' AS v"))
    out = upsert_raw(raw, delta, ["k"], AT)
    plan = planned(out)
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.where("v = 'w'").count() == 5 and out.count() == 5000


def test_a_hot_raw_key_is_split_by_adaptive_execution(spark, tmp_path):
    path = str(tmp_path / "raw")
    hot = spark.range(60_000).selectExpr(
        "if(id < 40000, 7, id) AS k", "timestamp_ntz'2024-01-01' AS wm", "uuid() AS v"
    )
    raw_of(hot).write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "300KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        delta = stage(spark.range(1000).selectExpr("id AS k", "timestamp_ntz'2024-01-02' AS wm", "'w' AS v"))
        out = upsert_raw(spark.read.parquet(path), delta, ["k"], AT)
        plan = exploded(out)
        assert "skew=true" in plan
        assert out.where("v = 'w'").count() == 40_000 + 999
    finally:
        for key in settings:
            spark.conf.unset(key)


# --- SILVER ------------------------------------------------------------------

def test_silver_first_build_and_passthrough(frame):
    raw = raw_of(frame([(1, D1, "a"), (1, D2, "b"), (2, D1, "gone")], KV), F.col("v") == "gone")
    assert rows(build_silver(None, raw, ["k"], "wm"), "k", "v") == [(1, "b")]
    assert rows(build_silver(None, raw, []), "k", "v") == [(1, "a"), (1, "b")]


def test_silver_merge_branches(frame):
    silver = frame([(1, D1, "a"), (2, D1, "b"), (3, D1, "c"), (None, D1, "n")], KV)
    raw = raw_of(frame([(1, D2, "A"), (2, D2, "x"), (4, D2, "d"), (5, D2, "x"), (None, D2, "m")], KV), F.col("v") == "x")
    merged = build_silver(silver, raw, ["k"], "wm")
    assert rows(merged, "k", "v") == [(1, "A"), (3, "c"), (4, "d"), (None, "m")]
    assert rows(build_silver(merged, raw, ["k"], "wm"), "k", "v") == rows(merged, "k", "v")
    assert rows(build_silver(merged.where("k IS NOT NULL"), raw, ["k"], "wm"), "k", "v") == [
        (1, "A"), (3, "c"), (4, "d"), (None, "m"),
    ]
    assert rows(build_silver(silver, raw, ["k"], "wm", snapshot=True), "k", "v") == [(1, "A"), (4, "d"), (None, "m")]


def test_silver_drops_a_key_whose_newest_row_is_deleted(frame):
    raw = raw_of(frame([(1, D1, "live"), (1, D2, "x")], KV), F.col("v") == "x")
    assert build_silver(None, raw, ["k"], "wm").count() == 0


def test_silver_source_side_is_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' AS wm", "'v' AS v").write.parquet(path)
    stored = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = planned(build_silver(stored, raw_of(stored), ["k"], "wm"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in plan


# --- reconcile ---------------------------------------------------------------

def test_missing_keys_treat_null_as_a_value(frame):
    raw = raw_of(frame([(1, D1, "a"), (2, D1, "b"), (2, D2, "b"), (3, D1, "x"), (None, D1, "n")], KV), F.col("v") == "x")
    assert rows(missing_keys(raw, frame([(1,), (None,)], "k long"), ["k"])) == [(2,)]
    assert rows(missing_keys(raw, frame([(1,)], "k long"), ["k"])) == [(2,), (None,)]


def test_keys_are_compared_in_raws_type(frame):
    raw = raw_of(frame([("10.5", D1, "a"), ("7.0", D1, "b")], "k string, wm timestamp_ntz, v string"))
    source = frame([("10.5",)], "k string").selectExpr("cast(k AS decimal(10,1)) AS k")
    assert rows(missing_keys(raw, source, ["k"])) == [("7.0",)]


def test_soft_delete_flags_every_live_copy(frame):
    raw = raw_of(frame([(1, D1, "a"), (2, D1, "b"), (2, D2, "c"), (2, D3, "x"), (None, D1, "n")], KV), F.col("v") == "x")
    missing = frame([(2,), (None,)], "k long")
    out = soft_delete(raw, missing, ["k"], AT)
    assert out.columns == raw.columns
    assert rows(out, "k", "v", "_IS_DELETED", "_DELETED_AT") == [
        (1, "a", False, None), (2, "b", True, AT), (2, "c", True, AT), (2, "x", True, None), (None, "n", True, AT),
    ]
    assert count_hits(raw, missing, ["k"]) == 3


def test_key_difference_is_a_hash_or_merge_join(frame):
    plan = planned(missing_keys(raw_of(frame([(1, D1, "a")], KV)), frame([(1,)], "k long"), ["k"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- drift -------------------------------------------------------------------

def test_drift_adds_and_reports(frame):
    raw = raw_of(frame([(1, "a")], "K long, OLD string"))
    source = frame([(1, 5)], "k long, extra int")
    drift = detect_drift(source.schema, raw.schema)
    assert drift.added_names == ["EXTRA"] and drift.dropped == ("OLD",)
    out = apply_drift(raw, drift)
    assert out.columns == ["K", "OLD", "EXTRA", *AUDIT] and out.first().EXTRA is None
    assert detect_drift(source.schema, None).added_names == []
    again = detect_drift(source.schema, out.schema)
    assert again.added_names == [] and apply_drift(out, again).columns == out.columns


def test_a_changed_type_is_not_drift(frame):
    drift = detect_drift(frame([("1",)], "k string").schema, frame([(1,)], "k long").schema)
    assert not drift.added and not drift.dropped


# --- hashes and parity -------------------------------------------------------

def test_row_hash_sees_a_value_changing_columns(frame):
    df = frame([(None, "a"), ("a", None), (None, None)], "x string, y string")
    assert df.select(row_hash(df.schema.fields)).distinct().count() == 3


def test_fingerprint_ignores_order_but_sees_duplicates(frame):
    df = frame([(i, D1, f"v{i}") for i in range(50)], KV)
    assert fingerprint(df).first() == fingerprint(df.repartition(7)).first()
    doubled = df.unionByName(df.where("k = 1")).unionByName(df.where("k = 1"))
    a, b = fingerprint(df).first(), fingerprint(doubled).first()
    assert a.hash_xor == b.hash_xor and a.hash_sum != b.hash_sum
    assert fingerprint(df.where("false")).first()[:2] == (0, 0)


def test_fingerprint_text_of_every_type(frame):
    df = frame([(1,)], "i int").selectExpr(
        "true AS b", "1e10D AS d", "cast('ab' AS binary) AS bin", "date'2024-01-02' AS day",
        "cast(NULL AS string) AS nothing", "timestamp_ntz'2024-01-02 03:04:05.678' AS t", "parse_json('{\"a\":1}') AS j",
        "cast(1.50 AS decimal(10,2)) AS n",
    )
    from tidemark.functions import canonical_row

    text = df.select(canonical_row(df.schema.fields)).first()[0]
    assert text == '1~|~1.0E10~|~6162~|~2024-01-02~|~~N~~|~2024-01-02 03:04:05.678~|~{"a":1}~|~1.50'
    cut = df.select(canonical_row(df.schema.fields, seconds=True)).first()[0]
    assert cut == text.replace(".678", "")
    tiny = frame([(1e-8, 4e-7)], "a double, b double")
    assert fingerprint(tiny.select("a")).first() != fingerprint(tiny.selectExpr("b AS a")).first()
    assert set(fingerprint_columns(df.schema.fields)) == {"rows", "hash_xor", "hash_sum"}


def test_parity_verdicts(frame):
    source = frame([(1, D1, "a"), (2, D2, "b")], KV)
    same = raw_of(source)
    ok = parity_report(source, same, source, "wm", deep=True).first()
    assert ok.ok and ok.delta == 0 and ok.target == 2 and ok.target_layer == "SILVER"
    flagged = raw_of(source, F.col("k") == 2)
    off = parity_report(source, flagged, source, "wm").first()
    assert (off.ok, off.count_ok, off.wm_ok, off.delta, off.raw_wm) == (False, False, False, 1, "2024-01-01 00:00:00")
    changed = raw_of(source.withColumn("v", F.lit("z")))
    deep = parity_report(source, changed, None, "wm", deep=True).first()
    assert deep.count_ok and deep.wm_ok and not deep.hash_ok and not deep.ok
    assert parity_report(source, changed, None, "wm").first().ok


def test_two_empty_sides_are_equal(frame):
    empty = frame([], KV)
    report = parity_report(empty, raw_of(empty), empty, "wm", deep=True).first()
    assert report.ok and report.source_wm is None
