from datetime import datetime

import pytest
import zstandard
from conftest import planned, rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.layers import SourceColumn, conform, raw_schema, scd2_schema, spark_type, target_schema
from tidemark.sources import (
    SourceSpec,
    bounds_query,
    clocks,
    incremental_window,
    jdbc_options,
    read_by_name,
    read_dump,
    window_bounds,
    write_delta,
    write_dump,
)
from tidemark.spec import TableSpec

TEXTS = T.StructType([T.StructField("A", T.StringType()), T.StructField("B", T.StringType())])


def test_window_is_open_below_and_closed_above(frame):
    df = frame([(1, ts("2024-01-01")), (2, ts("2024-01-02")), (3, ts("2024-01-03")), (4, None)], "id long, wm timestamp_ntz")
    low, high = window_bounds(datetime(2024, 1, 2, 0, 5), "2024-01-01 00:00:00")
    assert (low, high) == ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert rows(incremental_window(df, "wm", low, high), "id") == [(2,)]
    assert rows(incremental_window(df, "wm", None, high), "id") == [(1,), (2,)]
    assert incremental_window(df, None, low, high).count() == 4


def test_lookback_widens_the_window():
    low, _ = window_bounds(datetime(2024, 1, 2), "2024-01-01 12:00:00", lookback_minutes=60)
    assert low == "2024-01-01 11:00:00"


def test_window_on_dates_compares_dates(frame):
    df = frame([(1, ts("2024-01-01").date()), (2, ts("2024-01-02").date())], "id long, wm date")
    assert rows(incremental_window(df, "wm", "2024-01-01 10:00:00", "2024-01-02 09:00:00"), "id") == [(2,)]


def test_window_bounds_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = planned(incremental_window(events, "ts", "2024-01-15 00:00:00", "2024-01-20 00:00:00"))
    assert "GreaterThan(ts,2024-01-15T00:00)" in plan and "LessThanOrEqual(ts,2024-01-20T00:00)" in plan


def dump(tmp_path, name, text):
    (tmp_path / name).write_bytes(zstandard.compress(text.encode("utf-8")))


def test_dump_dialect(spark, tmp_path):
    lines = [
        ("\\N", None),
        ("", ""),
        ("a\\tb", "a\tb"),
        ("a\\nb", "a\nb"),
        ("a\\\\tb", "a\\tb"),
        ("a\\\\\\tb", "a\\\tb"),
        ("\\0x\\\\0", "\0x\\0"),
        ("it\\'s \\\"q\\\"", "it's \"q\""),
        ('"quoted"', '"quoted"'),
        ("\\Z\\b\\r", "\x1a\b\r"),
        ("\\\\N", "\\N"),
        ("é漢", "é漢"),
    ]
    dump(tmp_path, "t@0.tsv.zst", "".join(f"{i}\t{raw}\n" for i, (raw, _) in enumerate(lines)))
    (tmp_path / "t@0.json").write_text("{}")
    got = {int(r.A): r.B for r in read_dump(spark, str(tmp_path), TEXTS).collect()}
    assert got == {i: value for i, (_, value) in enumerate(lines)}


def test_dump_converts_by_position(spark, tmp_path):
    schema = target_schema(
        [
            SourceColumn("id", "int"),
            SourceColumn("flag", "tinyint", "tinyint(1)"),
            SourceColumn("amount", "decimal", precision=10, scale=2),
            SourceColumn("big", "decimal", precision=65, scale=6),
            SourceColumn("at", "datetime"),
        ]
    )
    wide = "9" * 50 + ".123456"
    dump(tmp_path, "t@0.tsv.zst", f"1\t1\t12.50\t{wide}\t2024-01-01 10:00:00.250000\n2\t0\t\\N\t\\N\t\\N\n")
    found = rows(read_dump(spark, str(tmp_path), schema))
    assert found[0][:2] == (1, True) and str(found[0][2]) == "12.50" and found[0][3] == wide
    assert found[0][4] == datetime(2024, 1, 1, 10, 0, 0, 250000)
    assert found[1] == (2, False, None, None, None)


@pytest.mark.parametrize("line", ["only one field\n", "a\tb\tc\n"])
def test_dump_with_a_wrong_field_count_fails(spark, tmp_path, line):
    dump(tmp_path, "t@0.tsv.zst", line)
    with pytest.raises(Exception, match="expected 2 fields"):
        read_dump(spark, str(tmp_path), TEXTS).collect()


def test_dump_without_data_files_fails(spark, tmp_path):
    (tmp_path / "t.json").write_text("{}")
    with pytest.raises(FileNotFoundError):
        read_dump(spark, str(tmp_path), TEXTS)


def test_a_bad_value_fails_the_load(spark, tmp_path):
    dump(tmp_path, "t@0.tsv.zst", "x\ty\n")
    schema = T.StructType([T.StructField("A", T.LongType()), T.StructField("B", T.StringType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_dump(spark, str(tmp_path), schema).collect()


def test_dump_round_trip(spark, frame, tmp_path):
    nasty = [("a\\tb", "\t\n\\"), ("", None), ("\0\\0", "\\N"), ("\\\\0", "x\\"), (None, "\b\x1a\r")]
    df = frame(nasty, "A string, B string")
    write_dump(df, str(tmp_path / "out"))
    assert rows(read_dump(spark, str(tmp_path / "out"), TEXTS, pattern="*.txt")) == rows(df)


def test_parquet_is_matched_by_name(spark, frame, tmp_path):
    path = str(tmp_path / "delta")
    write_delta(frame([(1, "x", 9)], "Id int, name string, extra int"), path)
    schema = T.StructType(
        [T.StructField("NAME", T.StringType()), T.StructField("ID", T.LongType()), T.StructField("NEW", T.DateType())]
    )
    got = read_by_name(spark, path, schema, with_file=True).collect()[0]
    assert (got.NAME, got.ID, got.NEW) == ("x", 1, None) and got._SRC_FILE.endswith(".parquet")


def test_rows_per_file(spark, tmp_path):
    def files(limit):
        path = tmp_path / f"n{limit}"
        write_delta(spark.range(0, 10, 1, 1), str(path), limit)
        return len(list(path.glob("*.parquet")))

    assert files(3) == 4 and files(0) == 1


COLUMNS = [SourceColumn("id", "int"), SourceColumn("big", "decimal", precision=65, scale=6), SourceColumn("at", "datetime")]


def test_jdbc_query_holds_window_and_casts():
    options = jdbc_options("jdbc:x", "shop", "orders", COLUMNS, "at", "2024-01-01", "2024-01-02")
    assert options["dbtable"] == (
        "(SELECT `id`, CAST(`big` AS CHAR) AS `big`, `at` FROM `shop`.`orders` "
        "WHERE `at` > '2024-01-01' AND `at` <= '2024-01-02') AS src"
    )
    assert options["preferTimestampNTZ"] == "true" and "numPartitions" not in options


def test_jdbc_splits_only_on_range_types():
    def split(column, bounds=(1, 9)):
        return "numPartitions" in jdbc_options(
            "jdbc:x", "shop", "orders", COLUMNS, partition_col=column, partition_num=8, bounds=bounds
        )

    assert split("ID") and split("at", ("2024-01-01", "2024-02-01"))
    assert not split("big") and not split("nope") and not split("id", None) and not split("id", (None, None))


def test_type_map():
    kind = lambda *a, **k: spark_type(SourceColumn("c", *a, **k))
    assert kind("tinyint", "tinyint(1)") == T.BooleanType()
    assert kind("tinyint", "tinyint(4)") == T.LongType() and kind("year") == T.LongType()
    assert kind("bigint", "bigint unsigned") == T.DecimalType(20, 0)
    assert kind("decimal", precision=10, scale=2) == T.DecimalType(10, 2)
    assert kind("numeric") == T.DecimalType(38, 0)
    assert kind("decimal", precision=65, scale=6) == T.StringType()
    assert kind("double") == T.DoubleType() and kind("timestamp") == T.TimestampNTZType()
    assert kind("date") == T.DateType() and kind("time") == T.StringType()
    assert kind("json") == T.VariantType() and kind("longblob") == T.BinaryType()
    assert kind("geometry") == T.StringType() and kind("enum") == T.StringType()


def test_conform_orders_names_and_casts(frame):
    df = frame([(2, "1", '{"a":1}')], "b int, A string, j string")
    schema = target_schema([SourceColumn("a", "bigint"), SourceColumn("b", "bigint"), SourceColumn("j", "json")])
    out = conform(df, schema)
    assert out.columns == ["A", "B", "J"] and out.schema["J"].dataType == T.VariantType()
    assert out.select("A", "B", F.to_json("J")).first() == (1, 2, '{"a":1}')


def test_layer_schemas():
    business = T.StructType([T.StructField("ID", T.LongType())])
    assert raw_schema(business).names == ["ID", "_LOAD_TS", "_SRC_FILE", "_BATCH_ID", "_IS_DELETED", "_DELETED_AT"]
    assert scd2_schema(business).names == [
        "DIM_KEY", "ID", "EFF_FROM", "EFF_TO", "IS_CURRENT", "IS_DELETED", "ROW_HASH", "_LOAD_TS", "_BATCH_ID",
    ]
    with pytest.raises(ValueError):
        target_schema([])


def test_bounds_and_default_ranges_of_a_window():
    from tidemark.sources.relational import partitioning

    query = bounds_query("shop", "orders", "id", "at", "2024-01-01", "2024-01-02")
    assert query.endswith("FROM `shop`.`orders` WHERE `at` > '2024-01-01' AND `at` <= '2024-01-02'")
    assert "WHERE" not in bounds_query("shop", "orders", "id")
    columns = [SourceColumn("id", "bigint"), SourceColumn("name", "varchar")]
    assert partitioning(columns, ["ID"], None, 1) == ("ID", 8)
    assert partitioning(columns, ["NAME"], None, 1) == (None, 1) == partitioning(columns, ["ID", "NAME"], None, 4)
    assert partitioning(columns, ["NAME"], "ID", 3) == ("ID", 3)


def test_json_and_bytes_survive_a_dump(spark, tmp_path):
    every = "".join(f"{b:02x}" for b in range(256))
    df = spark.range(1).selectExpr("parse_json('\"1\\\\tabc\"') AS j", f"unhex('{every}') AS b", "cast(NULL AS binary) AS n")
    write_dump(df, str(tmp_path / "out"))
    back = read_dump(spark, str(tmp_path / "out"), df.schema, pattern="*.txt", base64=["b", "n"])
    assert back.selectExpr("to_json(j)", "lower(hex(b))", "n").first()[:] == (df.selectExpr("to_json(j)").first()[0], every, None)


def test_clocks_follow_the_zone(spark):
    from datetime import datetime, timezone

    sources = {("shop", "orders"): SourceSpec("parquet", "/nowhere", zone="America/Los_Angeles")}
    at = clocks(spark, sources, lambda: datetime(2024, 1, 1, 20, tzinfo=timezone.utc))
    assert at(TableSpec("shop", "orders", "ORDERS")) == datetime(2024, 1, 1, 12)


def test_balanced_ranges(spark, frame):
    from pyspark.sql import functions as F

    from tidemark.sources.ranges import balanced_bounds, range_predicates, reader_of

    skewed = spark.range(10_000).select((F.col("id") * F.col("id") * F.col("id")).alias("k"))
    bounds = balanced_bounds(skewed, "k", 8)
    counts = [r["count"] for r in skewed.groupBy(reader_of("k", bounds)).count().collect()]
    assert len(counts) == 8 and max(counts) < 1.05 * 10_000 / 8
    # Conditions split all rows, NULLs and values beyond the ends too.
    other = frame([(None,), (-5,), (10**13,), (bounds[0],), (bounds[-1],)], "k long")
    hits = [other.where(p).count() for p in range_predicates("k", bounds)]
    assert sum(hits) == 5 and hits[0] == 2 and hits[-1] == 2 and hits[1] == 1
    # One value with most rows keeps them together and leaves fewer ranges.
    hot = frame([(7,)] * 90 + [(i,) for i in range(10)], "k int")
    assert 1 <= len(balanced_bounds(hot, "k", 8)) <= 3
    empty = frame([], "k int")
    assert balanced_bounds(empty, "k", 4) == [] and range_predicates("k", []) == ["1 = 1"]
    days = frame([(ts("2024-01-01"),), (ts("2024-01-02"),), (ts("2024-01-03"),)], "k timestamp_ntz")
    assert sum(days.where(p).count() for p in range_predicates("k", balanced_bounds(days, "k", 3))) == 3
    with pytest.raises(ValueError, match="at least one reader"):
        balanced_bounds(empty, "k", 0)
