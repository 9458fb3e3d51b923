"""Time the headline queries; prints one JSON line.

Each query runs once unmeasured on the smallest data set (class loading, code
generation), then measured over the whole tables into a no-op sink: once if it is
long, else the better of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import read_dump, write_dump  # noqa: E402
from tidemark.staging import scratch_path, stage  # noqa: E402

HEADLINE = (
    "incremental_window",
    "full_snapshot_conform",
    "dump_read",
    "parquet_by_name",
    "delta_dedupe",
    "raw_upsert",
    "raw_upsert_composite",
    "silver_latest",
    "silver_with_deletes",
    "silver_snapshot_sync",
    "scd2_initial",
    "scd2_two_batches",
    "scd2_with_delete",
    "scd2_fact_lookup",
    "scd2_fact_lookup_long",
    "scd2_fact_lookup_hot_key",
    "scd2_surrogate",
    "reconcile_missing_keys",
    "reconcile_soft_delete",
    "parity_fingerprint",
    "parity_report_deep",
    "layer_counts",
    "latest_runs",
    "stale_tables",
    "profile_lineitem",
    "sync_full_then_incremental",
    "sync_dimension",
    "sync_reconcile",
)


LONG = 5.0


def timed(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def dump_rate(spark, folder: str) -> dict[str, float]:
    """Megabytes of dump text written, and read back, per second for the largest table.

    The test file is a single row group, so it is first laid out in eight files.
    """
    items = stage(spark.read.parquet(f"{folder}/lineitem.parquet").repartition(8))
    for _ in range(2):  # the first round warms up
        path = scratch_path(spark, "rate")
        started = time.perf_counter()
        write_dump(items, path)
        wrote = time.perf_counter() - started
        started = time.perf_counter()
        read_dump(spark, path, items.schema, pattern="*.txt").write.format("noop").mode("overwrite").save()
        read = time.perf_counter() - started
    size = sum(f.stat().st_size for f in Path(path).glob("*.txt")) / 1e6
    return {"megabytes": round(size, 1), "write_mb_per_sec": round(size / wrote, 1), "read_mb_per_sec": round(size / read, 1)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "tidemark-bench")
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    warm = small if os.path.isdir(small) else folder
    seconds = {}
    for name in wanted:
        timed(spark, name, warm)
        took = timed(spark, name, folder)
        if took < LONG:
            took = min(took, timed(spark, name, folder))
        seconds[name] = round(took, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "full_dump": dump_rate(spark, folder),
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
