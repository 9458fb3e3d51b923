"""Table store and whole runs."""

from datetime import datetime, timedelta

import pytest
import zstandard
from conftest import rows, ts
from pyspark.sql import functions as F

from tidemark.layers import SourceColumn
from tidemark.operators.parity import count_board, layer_counts, parity_board
from tidemark.plans.store import TableStore, touched_buckets
from tidemark.plans.sync import RAW, Sync
from tidemark.sources import SourceSpec, open_table, opener
from tidemark.spec import INCREMENTAL, SCD2, SILVER, TableSpec

SCHEMA = "id long, name string, updated_at timestamp_ntz"
SPEC = TableSpec(
    "shop", "item", "ITEM", keys=("ID",), load_type=INCREMENTAL, watermark_col="UPDATED_AT", buckets=4, reconcile=True
)
D = [None] + [ts(f"2024-01-{d:02d}") for d in range(1, 29)]


class Bench:
    """A source table and a clock the test moves by hand."""

    def __init__(self, spark, path, **options):
        self.spark, self.now, self.tables = spark, datetime(2024, 2, 1), {}
        self.sync = Sync(spark, TableStore(spark, path), self.source, clock=lambda: self.now, **options)

    def source(self, spec):
        found = self.tables[spec.source_table]
        if isinstance(found, Exception):
            raise found
        return found

    def set(self, data, schema=SCHEMA, table="item"):
        self.tables[table] = self.spark.createDataFrame(data, schema) if isinstance(data, list) else data

    def run(self, *specs, **options):
        self.now += timedelta(days=1)
        return self.sync.run(specs, **options)

    def read(self, spec, layer):
        return self.sync.store.read(spec, layer)


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, str(tmp_path / "store"))


def only(result):
    assert len(result.records) == 1
    return result.records[0]


def test_seed_then_delta_then_nothing(bench):
    bench.set([(i, f"v{i}", D[1]) for i in range(20)])
    seed = only(bench.run(SPEC))
    assert (seed["LOAD_TYPE"], seed["STATUS"], seed["ROWS_RAW"], seed["WATERMARK_TO"]) == (
        "full", "success", 20, "2024-01-01 00:00:00",
    )
    bench.set([(i, f"v{i}", D[1]) for i in range(20)] + [(3, "three", D[2]), (3, "THREE", D[3]), (99, "new", D[3])])
    delta = only(bench.run(SPEC))
    assert (delta["LOAD_TYPE"], delta["ROWS_EXTRACTED"], delta["ROWS_RAW"]) == ("incremental", 3, 2)
    assert (delta["WATERMARK_FROM"], delta["WATERMARK_TO"]) == ("2024-01-01 00:00:00", "2024-01-03 00:00:00")
    silver = bench.read(SPEC, SILVER)
    assert silver.columns == ["ID", "NAME", "UPDATED_AT"] and silver.count() == 21
    assert bench.read(SPEC, RAW).where("ID = 99").first()._SRC_FILE.endswith(".parquet")  # the landing file
    assert rows(silver.where("ID IN (3, 99)"), "ID", "NAME") == [(3, "THREE"), (99, "new")]
    before = bench.sync.store.version(SPEC, SILVER).number
    nothing = only(bench.run(SPEC))
    assert nothing["STATUS"] == "skipped" and bench.sync.store.version(SPEC, SILVER).number == before
    assert only(bench.sync.validate([SPEC]))["STATUS"] == "mismatch"  # the source holds key 3 three times


def test_only_touched_buckets_are_rewritten(bench):
    bench.set([(i, f"v{i}", D[1]) for i in range(40)])
    bench.run(SPEC)
    old = {layer: bench.sync.store.version(SPEC, layer) for layer in (RAW, SILVER)}
    bench.set([(i, f"v{i}", D[1]) for i in range(40)] + [(3, "three", D[2])])
    bench.run(SPEC)
    touched = touched_buckets(bench.spark.createDataFrame([(3,)], "ID long"), SPEC)
    assert len(touched) == 1
    for layer, before in old.items():
        after = bench.sync.store.version(SPEC, layer)
        changed = {p.bucket for p in set(after.pieces) - set(before.pieces)}
        assert changed == set(touched) and len(before.pieces) == 4


def test_rows_inside_the_lag_wait(bench):
    bench.set([(1, "a", D[1])])
    bench.run(SPEC)
    bench.now = datetime(2024, 3, 1)
    bench.set([(1, "a", D[1]), (2, "open", datetime(2024, 3, 1, 23, 57)), (3, "done", datetime(2024, 3, 1, 12))])
    bench.now = datetime(2024, 2, 29, 23, 59)  # run() moves on by a day
    bench.run(SPEC)
    assert rows(bench.read(SPEC, SILVER), "ID") == [(1,), (3,)]


def test_a_failing_table_does_not_stop_the_others(bench):
    bench.set([(1, "a", D[1])])
    bench.tables["broken"] = RuntimeError("no route to source " + "x" * 5000)
    broken = SPEC.with_(source_table="broken", target_table="BROKEN")
    asleep = SPEC.with_(source_table="asleep", target_table="ASLEEP", active=False)
    result = bench.run(broken, SPEC, asleep)
    assert [r["STATUS"] for r in result.records] == ["failed", "success"] and result.failed == 1
    logged = bench.sync.audit.log().where("STATUS = 'failed'").first()
    assert logged.FAILED_STEP == "extract" and len(logged.ERROR_MESSAGE) == 4000
    assert bench.run(broken, SPEC, only_table="item").records[0]["SOURCE_TABLE"] == "item"


def test_an_unwritable_log_is_a_failure(bench, monkeypatch):
    bench.set([(1, "a", D[1])])

    def full(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr(bench.sync.audit, "write", full)
    record = only(bench.run(SPEC))
    assert (record["STATUS"], record["FAILED_STEP"], record["ERROR_MESSAGE"]) == ("failed", "run_log", "disk full")


def test_many_tables_log_side_by_side(bench):
    bench.sync.parallel = 8
    specs = [SPEC.with_(source_table=f"t{i}", target_table=f"T{i}", active=True) for i in range(8)]
    for spec in specs:
        bench.tables[spec.source_table] = RuntimeError("down")
    assert bench.run(*specs).failed == 8
    assert bench.sync.audit.log().count() == 8


class Broken(Exception):
    """What a failing build raises."""


def failing(bench, monkeypatch, work):
    """Run ``work`` with a target build that fails after RAW was committed."""

    def stop(*_, **__):
        raise Broken("stopped")

    monkeypatch.setattr(bench.sync, "_build_target", stop)
    record = only(work())
    monkeypatch.undo()
    assert record["FAILED_STEP"] == "build_target"


@pytest.mark.parametrize("kind", ["silver", SCD2])
def test_a_target_left_behind_is_rebuilt(bench, monkeypatch, kind):
    spec = SPEC.with_(table_type=kind, target_table="T")
    bench.set([(i, "old", D[1]) for i in range(30)])
    bench.run(spec)
    bench.set([(i, "new", D[1]) for i in range(25)])
    failing(bench, monkeypatch, lambda: bench.run(spec, force_full=True))
    assert only(bench.sync.validate([spec]))["STATUS"] == "mismatch"
    assert only(bench.run(spec))["STATUS"] == "success"  # nothing in the window, but the target is behind
    target = bench.sync.target(spec)
    live = target.where("IS_CURRENT") if kind == SCD2 else target
    assert rows(live, "ID", "NAME") == sorted(((i, "new") for i in range(25)), key=str)
    assert only(bench.sync.validate([spec], deep=True))["STATUS"] == "success"
    assert only(bench.run(spec))["STATUS"] == "skipped"


def test_reconcile_rebuilds_a_target_left_behind(bench, monkeypatch):
    bench.set([(i, "a", D[1]) for i in range(20)])
    bench.run(SPEC)
    bench.set([(i, "a", D[1]) for i in range(15)])
    failing(bench, monkeypatch, lambda: bench.sync.reconcile([SPEC]))
    assert only(bench.sync.reconcile([SPEC]))["STATUS"] == "success"
    assert bench.sync.target(SPEC).count() == 15


def test_missing_key_or_watermark_fails_the_load(bench):
    bench.set([(1, "a", D[1])])
    bench.run(SPEC)
    for schema in ("ident long, name string, updated_at timestamp_ntz", "id long, name string, changed timestamp_ntz"):
        bench.set([(1, "b", D[2])], schema)
        assert "lacks" in only(bench.run(SPEC))["ERROR_MESSAGE"]
    assert rows(bench.read(SPEC, RAW), "NAME") == [("a",)]


def test_wider_types_and_dropped_columns(bench):
    bench.set([(1, "a", 5, D[1])], "id int, name string, n int, updated_at timestamp_ntz")
    bench.run(SPEC)
    bench.set([(2**40, 7_000_000_000, D[2])], "id long, n long, updated_at timestamp_ntz")
    record = only(bench.run(SPEC))
    assert record["STATUS"] == "success", record.get("ERROR_MESSAGE")
    assert "NAME" in record["WARNINGS"][0]
    assert rows(bench.read(SPEC, SILVER), "ID", "N") == [(1, 5), (2**40, 7_000_000_000)]
    bench.set([(1, "text", D[3])], "id long, n string, updated_at timestamp_ntz")
    assert only(bench.run(SPEC))["STATUS"] == "failed"
    assert only(bench.run(SPEC, force_full=True))["STATUS"] == "success"
    assert rows(bench.read(SPEC, SILVER), "N") == [("text",)]


def test_a_dimension_changes_its_bucket_count(bench):
    spec = SPEC.with_(table_type=SCD2, target_table="DIM")
    bench.set([(i, "a", D[1]) for i in range(9)])
    bench.run(spec)
    bench.set([(i, "b", D[2]) for i in range(9)])
    bench.run(spec)
    moved = spec.with_(buckets=3)
    assert only(bench.run(moved, force_full=True))["STATUS"] == "success"
    assert bench.sync.target(moved).count() == 18
    assert {p.bucket for p in bench.sync.store.version(moved, SCD2).pieces} <= {0, 1, 2}


def test_old_versions_go(spark, tmp_path):
    bench = Bench(spark, str(tmp_path / "store"), keep_versions=2)
    for day in range(1, 6):
        bench.set([(1, str(day), D[day])])
        bench.run(SPEC)
    for layer in (RAW, SILVER):
        store = bench.sync.store
        newest = store.version(SPEC, layer).number
        assert len(store._names(f"{store.root(SPEC, layer)}/versions")) <= 4  # two manifests and their checksums
        with pytest.raises(Exception):
            store.version(SPEC, layer, newest - 2)
    assert rows(bench.read(SPEC, SILVER), "NAME") == [("5",)]


def test_a_second_writer_leaves_no_draft(bench):
    bench.set([(1, "a", D[1])])
    bench.run(SPEC)
    store = bench.sync.store
    version = store.version(SPEC, RAW)
    with pytest.raises(RuntimeError):
        store._publish(SPEC, RAW, version)
    assert not [n for n in store._names(f"{store.root(SPEC, RAW)}/versions") if n.startswith(".draft")]


def test_a_failure_leaves_layers_and_watermark_alone(bench, monkeypatch):
    bench.set([(1, "a", D[1])])
    bench.run(SPEC)
    bench.set([(1, "b", D[2])])

    def stop(*_, **__):
        raise RuntimeError("stopped")

    monkeypatch.setattr(bench.sync, "_build_target", stop)
    assert only(bench.run(SPEC))["FAILED_STEP"] == "build_target"
    assert rows(bench.read(SPEC, SILVER), "NAME") == [("a",)]
    assert bench.sync.audit.watermark(SPEC) == "2024-01-01 00:00:00"
    monkeypatch.undo()
    retry = only(bench.run(SPEC))  # the same window again; the merge is idempotent
    assert retry["STATUS"] == "success" and rows(bench.read(SPEC, SILVER), "NAME") == [("b",)]


def test_full_loads_propagate_deletes(bench):
    for spec in (SPEC.with_(load_type="full"), SPEC.with_(load_type="full", table_type=SCD2, target_table="DIM")):
        bench.set([(1, "a", D[1]), (2, "b", D[1])])
        bench.run(spec)
        bench.set([(2, "b", D[1])])
        bench.run(spec)
        target = bench.sync.target(spec)
        kept = target.where("IS_CURRENT") if spec.table_type == SCD2 else target
        assert rows(kept, "ID") == [(2,)]
        assert rows(bench.read(spec, RAW), "ID") == [(2,)]


def test_a_table_without_keys_is_replaced(bench):
    spec = SPEC.with_(keys=(), load_type="full")
    bench.set([(1, "a", D[1]), (1, "a", D[1])])
    bench.run(spec)
    assert rows(bench.read(spec, SILVER), "ID", "NAME") == [(1, "a"), (1, "a")]
    assert only(bench.sync.reconcile([spec]))["STATUS"] == "skipped"


def test_dimension_runs(bench):
    spec = SPEC.with_(table_type=SCD2, track_columns=("NAME",))
    bench.set([(1, "a", D[1]), (2, "b", D[1])])
    bench.run(spec)
    bench.set([(1, "A", D[2]), (2, "b", D[2]), (3, "c", D[2])])
    second = only(bench.run(spec))
    assert second["STATUS"] == "success" and second["ROWS_SILVER"] == 3  # one closed, two new
    dim = bench.read(spec, SCD2)
    assert rows(dim, "DIM_KEY", "ID", "NAME", "IS_CURRENT") == [
        (1, 1, "a", False), (2, 2, "b", True), (3, 1, "A", True), (4, 3, "c", True),
    ]
    assert dim.where("IS_CURRENT").select("_BATCH_ID").distinct().count() == 2
    closed = {p for p in bench.sync.store.version(spec, SCD2).pieces if p.part == "closed"}
    bench.set([(1, "AA", D[3])])
    bench.run(spec)
    assert closed < {p for p in bench.sync.store.version(spec, SCD2).pieces if p.part == "closed"}
    names = bench.sync.register_views(spec)
    assert names[-1] == "SHOP_SCD2__ITEM_CURRENT"
    assert rows(bench.spark.table(names[-1]), "ID", "NAME") == [(1, "AA"), (2, "b"), (3, "c")]


def test_reconcile_soft_deletes_and_rebuilds(bench):
    dim_spec = SPEC.with_(table_type=SCD2, target_table="DIM")
    bench.set([(1, "a", D[1]), (2, "b", D[1]), (3, "c", D[1])])
    bench.run(SPEC, dim_spec)
    bench.set([(1, "a", D[1]), (3, "c", D[1])])
    result = bench.sync.reconcile([SPEC, dim_spec, SPEC.with_(reconcile=False)])
    assert [(r["STATUS"], r["ROWS_RAW"]) for r in result.records] == [("success", 1), ("success", 1)]
    assert rows(bench.read(SPEC, SILVER), "ID") == [(1,), (3,)]
    assert rows(bench.read(SPEC, RAW), "ID", "_IS_DELETED", "_DELETED_AT") == [
        (1, False, None), (2, True, bench.now), (3, False, None),
    ]
    dim = bench.read(dim_spec, SCD2).where("ID = 2").first()
    assert (dim.IS_CURRENT, dim.IS_DELETED, dim.EFF_TO) == (False, True, bench.now)
    before = bench.sync.store.version(SPEC, RAW).number
    assert only(bench.sync.reconcile([SPEC]))["ROWS_RAW"] == 0
    assert bench.sync.store.version(SPEC, RAW).number == before
    assert only(bench.sync.validate([SPEC], deep=True))["STATUS"] == "success"


def test_an_empty_source_is_not_taken_as_deletion(bench):
    bench.set([(1, "a", D[1])])
    bench.run(SPEC)
    bench.set([])
    assert only(bench.sync.reconcile([SPEC]))["STATUS"] == "failed"
    assert only(bench.sync.reconcile([SPEC], allow_empty_source=True))["ROWS_RAW"] == 1
    assert bench.read(SPEC, SILVER).count() == 0


def test_returning_key_and_revive(spark, tmp_path):
    for revive, visible in ((False, 0), (True, 1)):
        bench = Bench(spark, str(tmp_path / f"s{revive}"), revive=revive)
        bench.set([(1, "a", D[1]), (2, "b", D[1])])
        bench.run(SPEC)
        bench.set([(2, "b", D[1])])
        bench.sync.reconcile([SPEC])
        bench.set([(1, "back", D[2]), (2, "b", D[1])])
        bench.run(SPEC)
        assert bench.read(SPEC, SILVER).where("ID = 1").count() == visible


def test_drift_is_a_manifest_change(bench):
    bench.set([(1, "a", D[1]), (2, "b", D[1])])
    bench.run(SPEC)
    pieces = bench.sync.store.version(SPEC, RAW).pieces
    wider = "id long, name string, updated_at timestamp_ntz, size int"
    bench.set([(1, "a", D[1], 1), (2, "b", D[2], 2)], wider)
    assert only(bench.run(SPEC))["STATUS"] == "success"
    assert rows(bench.read(SPEC, SILVER), "ID", "SIZE") == [(1, None), (2, 2)]
    assert set(pieces) & set(bench.sync.store.version(SPEC, RAW).pieces)
    bench.set([(2, D[3])], "id long, updated_at timestamp_ntz")  # dropped columns stay, filled with NULL
    bench.run(SPEC)
    assert rows(bench.read(SPEC, SILVER), "ID", "NAME", "SIZE") == [(1, "a", None), (2, None, None)]


def test_validation_reports_the_failed_check(bench):
    bench.set([(1, "a", D[1])])
    assert only(bench.sync.validate([SPEC]))["STATUS"] == "failed"  # never loaded
    bench.run(SPEC)
    assert only(bench.sync.validate([SPEC]))["STATUS"] == "success"
    bench.set([(1, "A", D[1])])
    assert only(bench.sync.validate([SPEC]))["STATUS"] == "success"  # content needs the deep check
    deep = only(bench.sync.validate([SPEC], deep=True))
    assert deep["STATUS"] == "mismatch" and deep["ERROR_MESSAGE"].startswith("fingerprint ")
    bench.set([(1, "A", D[2]), (2, "b", D[2])])
    both = bench.sync.validate([SPEC])
    assert both.mismatches == 1
    assert only(both)["ERROR_MESSAGE"] == "2 rows at the source, 1 live in RAW, off by 1; watermark 2024-01-02 00:00:00 != 2024-01-01 00:00:00"


def test_boards_over_specs(bench):
    bench.set([(1, "a", D[1]), (1, "b", D[2])])
    bench.run(SPEC)
    counts = layer_counts(bench.sync.table_counts([SPEC]))
    assert [tuple(r) for r in counts.collect()] == [("SHOP_RAW", "ITEM", 2, 1, 1, None)]
    never = SPEC.with_(source_table="never", target_table="NEVER")
    bench.set([(1, "a", D[1])], table="never")
    assert rows(count_board(bench.sync.board([SPEC])), "raw_rows", "target_rows", "match") == [(2, 1, "differs")]
    found = parity_board(bench.sync.board([SPEC, never], with_source=True))
    assert rows(found, "table_name", "source_rows", "raw_rows", "parity") == [
        ("shop.item", 2, 2, "ok"), ("shop.never", 1, None, None),
    ]


def test_store_versions_and_expiry(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    spec = SPEC.with_(buckets=2)
    for n in range(4):
        assert store.commit(spec, RAW, spark.range(n + 1).withColumnRenamed("id", "ID")) == n + 1
    assert store.read(spec, RAW).count() == 4 and store.read(spec, RAW, number=2).count() == 2
    assert store.expire(spec, RAW, keep_versions=2) > 0
    assert store.read(spec, RAW).count() == 4 and store.read(spec, RAW, number=3).count() == 3
    assert store.commit(spec, RAW, spark.range(0).withColumnRenamed("id", "ID")) == 0
    assert store.read(spec, RAW).count() == 0 and store.read(spec, "other") is None


def test_an_oversized_bucket_is_split_over_tasks(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    hot = spark.range(0, 60_000, 1, 4).selectExpr("if(id % 3 < 2, 7, id) AS ID", "uuid() AS V")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        store.commit(SPEC, RAW, hot)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    bucket = touched_buckets(spark.createDataFrame([(7,)], "ID long"), SPEC)[0]
    files = {p.bucket: len(list((tmp_path / "SHOP_RAW/ITEM/data" / p.path).glob("*.parquet"))) for p in store.version(SPEC, RAW).pieces}
    # A shuffled partition is split along its map outputs, here four.
    assert files[bucket] == 4 > max(n for b, n in files.items() if b != bucket)


def test_a_second_writer_of_a_version_fails(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.commit(SPEC, RAW, spark.range(3).withColumnRenamed("id", "ID"))
    stale = store.version(SPEC, RAW)
    with pytest.raises(RuntimeError, match="another run"):
        store._publish(SPEC, RAW, stale)


def test_a_late_change_is_spliced_into_the_stored_history(bench):
    spec = SPEC.with_(table_type=SCD2, target_table="DIM", track_columns=("NAME",))
    bench.set([(1, "b", D[5]), (2, "x", D[5])])
    bench.run(spec)
    bench.set([(1, "c", D[10]), (2, "x", D[5])])
    bench.run(spec)
    bench.sync.lookback_minutes = 60 * 24 * 9
    bench.set([(1, "late", D[7]), (2, "y", D[12])])
    assert only(bench.run(spec))["STATUS"] == "success"
    found = rows(bench.read(spec, SCD2), "ID", "NAME", "EFF_FROM", "EFF_TO", "IS_CURRENT")
    high = datetime(9999, 12, 31)
    assert found == [
        (1, "b", D[5], D[7], False), (1, "c", D[10], high, True), (1, "late", D[7], D[10], False),
        (2, "x", D[5], D[12], False), (2, "y", D[12], high, True),
    ]
    assert rows(bench.read(spec, SCD2), "DIM_KEY") == [(1,), (2,), (3,), (4,), (5,)]
    assert only(bench.run(spec))["STATUS"] == "success" and rows(bench.read(spec, SCD2), "ID", "NAME", "EFF_FROM", "EFF_TO", "IS_CURRENT") == found


def test_json_columns_travel_through_all_layers(bench):
    dim_spec = SPEC.with_(table_type=SCD2, target_table="DIM")
    schema = "id long, doc string, updated_at timestamp_ntz"

    def load(data):
        plain = bench.spark.createDataFrame(data, schema)
        bench.set(plain.withColumn("doc", F.parse_json("doc")))
        assert [r["ERROR_MESSAGE"] for r in bench.run(SPEC, dim_spec).records if r["STATUS"] == "failed"] == []

    load([(1, '{"a":1}', D[1]), (2, '{"b":2}', D[1])])
    load([(1, '{"a":9}', D[2]), (2, '{"b":2}', D[1])])
    assert rows(bench.read(SPEC, SILVER), "ID", F.to_json("DOC")) == [(1, '{"a":9}'), (2, '{"b":2}')]
    assert bench.read(dim_spec, SCD2).count() == 3
    assert bench.sync.validate([SPEC, dim_spec], deep=True).mismatches == 0


def test_sources_feed_a_run(spark, tmp_path):
    columns = (SourceColumn("id", "int"), SourceColumn("name", "varchar"), SourceColumn("updated_at", "datetime"))
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "item@0.tsv.zst").write_bytes(
        zstandard.compress(b"1\ta\t2024-01-01 00:00:00\n2\t\\N\t2024-01-02 00:00:00\n")
    )
    spark.createDataFrame([(7, "x", D[1])], SCHEMA).write.parquet(str(tmp_path / "part"))
    sources = {
        ("shop", "item"): SourceSpec("dump", str(tmp_path / "dump"), columns),
        ("shop", "part"): SourceSpec("parquet", str(tmp_path / "part")),
    }
    sync = Sync(spark, TableStore(spark, str(tmp_path / "store")), opener(spark, sources))
    part = SPEC.with_(source_table="part", target_table="PART", buckets=1)
    assert sync.run([SPEC, part]).failed == 0
    assert rows(sync.target(SPEC), "ID", "NAME") == [(1, "a"), (2, None)]
    assert rows(sync.target(part)) == [(7, "x", D[1])]
    assert sync.store.read(part, RAW).first()._SRC_FILE.endswith(".parquet")
    spark.createDataFrame([(8, "y", D[2])], SCHEMA).write.mode("append").parquet(str(tmp_path / "part"))
    assert only(sync.run([part]))["ROWS_RAW"] == 1
    added = sync.store.read(part, RAW).where("ID = 8").first()
    assert "/part/" in added._SRC_FILE and added._BATCH_ID is not None
    assert sync.validate([SPEC, part], deep=True).mismatches == 0
    with pytest.raises(ValueError):
        open_table(spark, SourceSpec("smoke", "signal"), SPEC)


def test_spec_from_config():
    spec = TableSpec.from_config(
        {
            "source_db": "company", "source_table": "worker", "target_table": "WORKER", "primary_key": "worker_id",
            "load_type": "incremental", "watermark_col": "updated_at", "table_type": "scd2",
            "scd2": {"track_columns": ["worker_name", "salary"]}, "partition_num": None,
        }
    )
    assert spec.keys == ("WORKER_ID",) and spec.watermark_col == "UPDATED_AT" and spec.track_columns == ("WORKER_NAME", "SALARY")
    assert spec.namespace("raw") == "COMPANY_RAW" and spec.target_layer == SCD2 and spec.active
    both = TableSpec.from_config({"source_db": "d", "source_table": "t", "primary_key": "a", "merge_keys": ["a", "b"]})
    assert both.keys == ("A", "B") and both.target_table == "T" and both.target_layer == SILVER


# --- random batch sequences ---------------------------------------------------

def test_random_batches_keep_the_layer_promises(spark, tmp_path):
    """SILVER is the newest row per key, versions of a key never overlap, one is current."""
    import random

    rng = random.Random(11)
    bench = Bench(spark, str(tmp_path / "random"), parallel=2)
    dim_spec = SPEC.with_(table_type=SCD2, target_table="DIM", track_columns=("NAME",))
    state, tick = {}, 0
    for _ in range(4):
        for _ in range(12):
            tick += 1
            state[rng.randrange(10)] = (rng.choice("xyz"), D[1] + timedelta(minutes=tick))
        bench.set([(k, v, at) for k, (v, at) in state.items()])
        assert bench.run(SPEC, dim_spec).failed == 0
        assert rows(bench.read(SPEC, SILVER)) == rows(bench.tables["item"])
        dim = bench.read(dim_spec, SCD2)
        assert rows(dim.where("IS_CURRENT"), "ID", "NAME") == rows(bench.tables["item"], "id", "name")
        overlap = dim.alias("a").join(dim.alias("b"), "ID").where(
            (F.col("a.DIM_KEY") < F.col("b.DIM_KEY")) & (F.col("a.EFF_TO") > F.col("b.EFF_FROM"))
            & (F.col("b.EFF_TO") > F.col("a.EFF_FROM"))
        )
        assert overlap.count() == 0
        keys = [r[0] for r in dim.select("DIM_KEY").collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1))
