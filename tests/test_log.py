from datetime import datetime, timedelta

import pytest
from conftest import rows

from tidemark.layers import RUN_LOG_SCHEMA
from tidemark.operators import monitor
from tidemark.operators.parity import BoardEntry, board_totals, count_board, layer_counts, parity_board
from tidemark.operators.keys import minimal_keys
from tidemark.operators.registry import keep_existing, profile_table, replace_entries

NOW = datetime(2024, 1, 10)


@pytest.fixture
def log(spark):
    def row(run, table, status, hours_ago, error=None, step=None, wm=None):
        at = NOW - timedelta(hours=hours_ago)
        values = {
            "RUN_ID": run, "SOURCE_DB": "shop", "SOURCE_TABLE": table.lower(), "TARGET_TABLE": table, "STATUS": status,
            "ERROR_MESSAGE": error, "FAILED_STEP": step, "WATERMARK_TO": wm, "INSERTED_AT": at, "LOAD_TYPE": "full",
        }
        return tuple(values.get(f.name) for f in RUN_LOG_SCHEMA.fields)

    return spark.createDataFrame(
        [
            row("1", "A", "success", 30, wm="w1"),
            row("2", "A", "failed", 24, "boom " * 40, "merge"),
            row("3", "A", "failed", 2, "boom " * 40 + "tail"),
            row("4", "B", "success", 24, wm="w2"),
            row("5", "B", "skipped", 1),
            row("6", "C", "failed", 1, None),
            row("7", "B", "mismatch", 1),
        ],
        RUN_LOG_SCHEMA,
    )


def test_failed_runs_in_the_last_day(log):
    assert [r.TARGET_TABLE for r in monitor.failed_runs(log, NOW).collect()] == ["C", "A"]  # 24 h ago is too old


def test_latest_run_per_table_settles_ties(log):
    assert rows(monitor.latest_runs(log), "TARGET_TABLE", "STATUS") == [("A", "failed"), ("B", "mismatch"), ("C", "failed")]


def test_stale_tables(log):
    found = monitor.stale_tables(log, NOW).collect()
    assert [(r.TARGET_TABLE, r.last_success) for r in found] == [("C", None), ("A", NOW - timedelta(hours=30))]


def test_error_frequency_groups_by_prefix(log):
    found = monitor.error_frequency(log).collect()
    assert [(len(r.error_prefix), r.occurrences, r.last_seen) for r in found] == [(120, 2, NOW - timedelta(hours=2))]


def test_history_and_details(log):
    assert [r.TARGET_TABLE for r in monitor.history(log, 2).collect()] == ["B", "C"]
    assert rows(monitor.failure_details(log.where("TARGET_TABLE = 'C'")), "FAILED_STEP", "ERROR_MESSAGE") == [
        ("?", "No error message")
    ]


def test_watermark_drift(frame, log):
    raw = frame([(datetime(2024, 1, 5),), (None,)], "wm timestamp_ntz")
    assert tuple(monitor.watermark_drift(log.where("RUN_ID < '5'"), raw, "shop", "B", "wm").first()) == (
        "SHOP.B", "w2", "2024-01-05 00:00:00",
    )
    assert monitor.watermark_drift(log, raw, "shop", "Z", "wm").first().logged_wm is None


def test_status_tally(frame, log):
    registry = frame(
        [
            ("shop", "a", "A", "full", "scd2", "x", True),
            ("shop", "b", "B", "incremental", "silver", None, True),
            ("shop", "z", "Z", "full", "silver", None, False),
        ],
        "source_db string, source_table string, target_table string, load_type string, table_type string, "
        "last_loaded_at string, active boolean",
    )
    tally = monitor.status_tally(registry, log).first().asDict()
    assert tally == {
        "success": 0, "failed": 1, "skipped": 0, "pending": 1, "active": 2, "full_load": 1, "incremental_load": 1,
        "scd2": 1, "never_loaded": 1, "active_failed": 1,
    }


def test_boards(spark):
    def n(count):
        return spark.range(count).selectExpr("id", "id = 0 AS _IS_DELETED", "true AS IS_CURRENT")

    entries = [
        BoardEntry("a", n(5), n(5), n(4)),
        BoardEntry("b", n(5), n(3), n(5)),
        BoardEntry("c", None, n(2), n(2)),
    ]
    assert rows(count_board(entries), "table_name", "raw_rows", "target_rows", "match") == [
        ("a", 5, 5, "ok"), ("b", 5, 3, "differs"), ("c", None, 2, None),
    ]
    board = parity_board(entries)
    assert rows(board, "table_name", "raw_rows", "delta", "parity") == [("a", 4, 0, "ok"), ("b", 4, 1, "differs"), ("c", None, None, None)]
    assert tuple(board_totals(board, "parity").first()) == (11, 8, 10, 1, 1)


def test_layer_counts_strip_the_layer_suffix(frame):
    tables = frame(
        [("X_RAW", "T", 5), ("X_SILVER", "T", 0), ("Y_RAW", "T", 5), ("Y_SILVER", "T", 4), ("Z_RAW", "T", 1), ("XRAW", "T", 1),
         ("Y_RAW", "T_STAGE_TMP", 1), ("Y_SILVER", "T_STAGE_TMP", 1)],
        "table_schema string, table_name string, row_count long",
    )
    found = [tuple(r) for r in layer_counts(tables).collect()]
    assert found == [("X_RAW", "T", 5, 0, 5, "CHECK: SILVER empty"), ("Y_RAW", "T", 5, 4, 1, None)]


ENTRY = "source_db string, source_table string, load_type string"


def test_entry_merging(frame):
    old = frame([("s", "a", "tuned"), ("other", "a", "tuned")], ENTRY)
    new = frame([("s", "a", "found"), ("s", "b", "found")], ENTRY)
    assert rows(keep_existing(old, new)) == [("other", "a", "tuned"), ("s", "a", "tuned"), ("s", "b", "found")]
    assert rows(replace_entries(old, new)) == [("other", "a", "tuned"), ("s", "a", "found"), ("s", "b", "found")]


def test_profile(frame):
    df = frame(
        [(1, 1, datetime(2024, 1, 1)), (2, 1, None), (3, None, datetime(2024, 1, 3))],
        "id int, grp long, Updated_At timestamp_ntz",
    )
    found = {r.candidate_key: r for r in profile_table(df, [["id"], ["grp"], ["id", "grp"]]).collect()}
    assert found["id"].is_key and found["id"].load_type == "incremental" and found["id"].partition_col == "id"
    assert found["id"].partition_num == 8 and found["id"].watermark_col == "Updated_At"
    assert not found["grp"].is_key and found["grp"].null_keys == 1 and found["grp"].load_type == "full"
    assert found["id,grp"].null_keys == 1 and found["id,grp"].partition_num == 1
    assert found["id"].watermark_min == "2024-01-01 00:00:00"


def test_minimal_keys_against_all_subsets(spark, frame):
    """Random small tables: every set of columns counted by hand."""
    from itertools import combinations
    from random import Random

    for seed in range(4):
        random = Random(seed)
        names = ["a", "b", "c", "d"]
        data = [tuple(random.randrange(k) for k in (3, 9, 30, 200)) for _ in range(random.choice([2, 25, 60]))]
        data = [(*r[:2], f"x{r[2]}", r[3]) for r in data]
        df = frame(data, "a int, b long, c string, d long")
        expected = []
        for width in (1, 2, 3):
            for places in combinations(range(4), width):
                key = ",".join(names[i] for i in places)
                smaller = any(set(k.split(",")) <= set(key.split(",")) for k in expected)
                if not smaller and len({tuple(r[i] for i in places) for r in data}) == len(data):
                    expected.append(key)
        assert sorted(r.key_columns for r in minimal_keys(df, 3).collect()) == sorted(expected), (seed, data)


def test_minimal_keys_of_odd_tables(frame):
    rows_of = lambda df, **kw: sorted(tuple(r) for r in minimal_keys(df, **kw).collect())
    schema = "id int, `odd.name` string, x double, tags array<int>"
    assert rows_of(frame([], schema)) == []
    assert rows_of(frame([(1, "p", 1.0, [1])], schema)) == [("id", 1, 1), ("odd.name", 1, 1)]
    # A NULL rules a column out even if its other values differ, and floating-point columns never take part.
    mixed = [(None, "p", 1.0, [1]), (2, "q", 2.0, [2]), (3, "", 3.0, [3])]
    assert rows_of(frame(mixed, schema)) == [("odd.name", 1, 3)]
    assert rows_of(frame(mixed, schema), columns=["x", "id"]) == []
    # Repeated rows leave no key.
    assert rows_of(frame([(1, "p", 1.0, [1])] * 2, schema)) == []
    with pytest.raises(ValueError, match="no such columns: nope"):
        minimal_keys(frame([], schema), columns=["nope"])


def test_minimal_keys_read_values_once_and_sketch_columns_alone(spark, frame, monkeypatch):
    """The source is read for counts and codes only; sets of several columns are refuted by repeats, not by sketches."""
    from pyspark.sql import functions as F

    from tidemark.operators import keys

    tried, looked = [], []
    estimates, unrepeated = keys._estimates, keys._unrepeated
    monkeypatch.setattr(keys, "SAMPLES", (200, 1000))
    monkeypatch.setattr(keys, "_estimates", lambda df, sets: tried.extend(sets) or estimates(df, sets))
    monkeypatch.setattr(keys, "_unrepeated", lambda df, sets, *a: looked.append((len(sets), unrepeated(df, sets, *a))) or looked[-1][1])
    df = spark.range(6000).coalesce(1).select(
        *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(90 + k)).alias(f"c{k}") for k in range(5)], (F.col("id") % 3000).alias("half"),
        (F.col("id") >= 3000).alias("side"),
    )
    got = [r.key_columns for r in minimal_keys(df, 2).collect()]
    assert got == ["half,side"] and {len(s) for s in tried} == {1}
    before, left = next((n, out) for n, out in looked if n)
    assert before >= 2 * len(left)  # a sample refutes most of the sets
    # Values whose codes would meet if they were rounded or shortened.
    rows = [(f"0.{'1' * 16}{i:02d}", i, f"2024-01-01 00:00:00.{i:06d}", bytes([i]), f"9999999999999999.{i:02d}") for i in range(60)]
    odd = frame(rows, "d string, n int, t string, b binary, m string").selectExpr(
        "cast(d as decimal(18,18)) as `d, 1`", "cast(n as smallint) as n", "cast(t as timestamp) as t", "b", "cast(m as decimal(18,2)) as m"
    )
    assert [r.key_columns for r in minimal_keys(odd, 2).collect()] == ["d, 1", "n", "t", "b", "m"]


def test_minimal_keys_scan_few_sets(spark, monkeypatch):
    """What the counts of the parts rule out is never looked at; a late repeat is found on all rows."""
    from pyspark.sql import functions as F

    from tidemark.operators import keys

    tried = []
    inner = keys._estimates
    monkeypatch.setattr(keys, "_estimates", lambda df, sets: tried.extend(sets) or inner(df, sets))
    n = 20_000
    df = spark.range(n).select(
        F.col("id").alias("hi"), (F.col("id") % 7).alias("lo"), (F.col("id") % 11).alias("mid"),
        F.when(F.col("id") == n - 1, 0).otherwise(F.col("id")).alias("nearly"),
    )
    # One repeat in 20,000 rows, of the first and last, which agree in "lo" too: no sketch sees it.
    assert [r.key_columns for r in minimal_keys(df, 2).collect()] == ["hi", "mid,nearly"]
    assert ("lo", "mid") not in tried and not any("hi" in s for s in tried if len(s) > 1)


def test_minimal_keys_deal_rows_once_a_column(spark, monkeypatch):
    """What samples leave open is settled by dealing rows by a column, for all sets with it at once, and by no grouping of a set."""
    from itertools import combinations

    from pyspark.sql import functions as F

    from tidemark.operators import keys

    dealt, tried, grouped = [], [], []
    unrepeated = keys._unrepeated
    hashes = keys._unrepeated_hashes
    monkeypatch.setattr(keys, "SAMPLES", (50, 400))
    monkeypatch.setattr(keys, "TASK_BYTES", 1 << 14)
    monkeypatch.setattr(keys, "_unrepeated_hashes", lambda df, sets, *a: grouped.append(sets) or hashes(df, sets, *a))

    def watched(df, sets, *pivot):
        dealt.extend(pivot[:1])
        tried.extend(sets)
        return unrepeated(df, sets, *pivot)

    monkeypatch.setattr(keys, "_unrepeated", watched)
    n = 6000
    df = spark.range(n).select(
        (F.col("id") % (n // 4)).alias("order"), (F.col("id") * 4 / n).cast("int").alias("line"), F.pmod(F.xxhash64("id"), F.lit(900)).alias("part"),
        F.when(F.col("id") == n - 1, 0).otherwise(F.col("id")).cast("decimal(18,2)").alias("price"), F.lit("x").alias("flag"),
        (F.col("id") % 1000).cast("string").alias("text"),
    )
    data = [tuple(r) for r in df.collect()]
    expected = []
    for width in (1, 2, 3):
        for places in combinations(range(6), width):
            if not any(set(k) <= set(places) for k in expected) and len({tuple(r[i] for i in places) for r in data}) == n:
                expected.append(places)
    assert len(expected) >= 3
    got = [r.key_columns for r in minimal_keys(df, 3).collect()]
    assert got == [",".join(df.columns[i] for i in k) for k in expected]
    assert dealt and len(dealt) <= 4 and not grouped
    # Every column of the key is too frequent for one task: the whole set is grouped.
    monkeypatch.setattr(keys, "SAMPLES", (50, 2000))
    grid = spark.range(4900).select((F.col("id") % 70).alias("a"), (F.col("id") / 70).cast("int").alias("b"), F.lit(1).alias("c"))
    dealt.clear()
    assert [r.key_columns for r in minimal_keys(grid, 3).collect()] == ["a,b"]
    assert grouped and not dealt


def test_repeats_of_a_task_are_repeats_of_values():
    """Equal in one number of two is not equal; a witness refutes every set it agrees in."""
    import pyarrow as pa

    from tidemark.operators.keys import _repeats

    def bad(columns, sets, spans):
        batch = pa.RecordBatch.from_pydict({f"n{i}": pa.array(c, pa.int64()) for i, c in enumerate(columns)})
        halves = [batch.slice(0, 2), batch.slice(2)]
        return [i for out in _repeats(sets, spans, 1)(iter(halves)) for i in out.column(0).to_pylist()]

    one, two, low = [1, 1, 2, 3, -(2**63), 2**63 - 1], [5, 6, 6, 6, 6, 6], [0, 0, 0, 0, 0, 0]
    assert bad([one, two, low], [[0], [1], [0, 1]], [2, 1]) == [1]
    assert bad([one, two, low], [[0], [1], [2], [0, 1], [0, 2], [1, 2], [0, 1, 2]], [1, 1, 1]) == [0, 1, 2, 4, 5]
    assert bad([one[:1], two[:1]], [[0], [1]], [1, 1]) == []
    assert list(_repeats([[0]], [1], 1)(iter([]))) == []


def test_codes_of_minimal_keys_keep_values_apart(frame):
    """Times without a zone, dates and decimals are one number each, and no two of them meet."""
    rows = [(f"2024-01-01 00:00:00.{i:06d}", f"2024-01-{i + 1:02d}", f"{i - 9}.{i:09d}") for i in range(20)]
    df = frame(rows, "t string, d string, m string").selectExpr(
        "cast(t as timestamp_ntz) as t", "cast(d as date) as d", "cast(m as decimal(18,9)) as m", "cast(m as decimal(30,9)) as w"
    )
    assert [r.key_columns for r in minimal_keys(df, 1).collect()] == ["t", "d", "m", "w"]
    assert minimal_keys(df.unionAll(df), 3).count() == 0
