"""Changes spliced into a history, against a step function kept in Python."""

import random
from datetime import timedelta

import pytest
from conftest import AT, planned, rows, ts
from pyspark.sql import functions as F

from tidemark.layers import with_audit
from tidemark.operators.splice import scd2_change_rows, splice_scd2
from tidemark.staging import stage

KV = "k long, wm timestamp_ntz, v string"
D = [None] + [ts(f"2024-01-{d:02d}") for d in range(1, 29)]
HIGH = ts("9999-12-31")


def changes(df, deleted=None):
    raw = with_audit(df, AT)
    if deleted is not None:
        raw = raw.withColumn("_IS_DELETED", deleted).withColumn("_DELETED_AT", F.when(deleted, F.col("wm")))
    return scd2_change_rows(raw, ["k"], "wm", AT, ["v"])


def spliced(dim, df, deleted=None):
    return stage(splice_scd2(dim, changes(df, deleted), ["k"], AT, "b"), "dim")


def history(dim):
    return rows(dim, "k", "v", "EFF_FROM", "EFF_TO", "IS_CURRENT", "IS_DELETED")


def test_a_late_change_takes_its_place(frame):
    dim = spliced(None, frame([(1, D[10], "b")], KV))
    dim = spliced(dim, frame([(1, D[5], "a")], KV))
    assert history(dim) == [(1, "a", D[5], D[10], False, False), (1, "b", D[10], HIGH, True, False)]
    dim = spliced(dim, frame([(1, D[7], "x"), (1, D[8], "x"), (1, D[6], "a"), (1, D[12], "b")], KV))  # two of them change nothing
    assert history(dim) == [
        (1, "a", D[5], D[7], False, False), (1, "b", D[10], HIGH, True, False), (1, "x", D[7], D[10], False, False),
    ]


def test_deletes_and_gaps(frame):
    gone = F.col("v") == "-"
    dim = spliced(None, frame([(1, D[2], "a"), (1, D[4], "-"), (1, D[8], "b")], KV), gone)
    assert history(dim) == [(1, "a", D[2], D[4], False, True), (1, "b", D[8], HIGH, True, False)]
    dim = spliced(dim, frame([(1, D[6], "c"), (1, D[3], "d"), (1, D[5], "-")], KV), gone)
    assert history(dim) == [
        (1, "a", D[2], D[3], False, False), (1, "b", D[8], HIGH, True, False), (1, "c", D[6], D[8], False, False),
        (1, "d", D[3], D[4], False, True),
    ]
    dim = spliced(dim, frame([(1, D[9], "-"), (2, D[1], "-")], KV), gone)
    assert history(dim)[1] == (1, "b", D[8], D[9], False, True) and dim.where("IS_CURRENT").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_any_order_keeps_one_step_function(frame, seed):
    rng = random.Random(seed)
    moments = [D[1] + timedelta(hours=h) for h in range(40)]
    dim, kept = None, {}
    for _ in range(4):
        batch = {(rng.choice([None, 1, 2, 3]), rng.choice(moments)): rng.choice("abc-") for _ in range(15)}
        dim = spliced(dim, frame([(k, t, v) for (k, t), v in batch.items()], KV), F.col("v") == "-")
        for (k, t), v in sorted(batch.items(), key=lambda item: item[0][1]):
            steps = kept.setdefault(k, {})
            before = [steps[m] for m in sorted(steps) if m <= t]
            if (before[-1] if before else "-") != v:
                steps[t] = v
        for steps in kept.values():  # an end that no version reaches any more leaves no trace
            order = sorted(steps)
            for at, earlier in zip(order, [None, *order]):
                if steps[at] == "-" and (earlier is None or steps.get(earlier, "-") == "-"):
                    del steps[at]
        want = []
        for k, steps in kept.items():
            order = sorted(steps)
            for at, until in zip(order, [*order[1:], HIGH]):
                if steps[at] != "-":
                    want.append((k, steps[at], at, until))
        lasting = dim.where("EFF_FROM < EFF_TO")
        assert rows(lasting, "k", "v", "EFF_FROM", "EFF_TO") == sorted(want, key=lambda t: [(v is None, str(v)) for v in t])
        assert dim.where("EFF_TO < EFF_FROM").isEmpty()
        assert dim.where("IS_CURRENT").groupBy("k").count().where("count > 1").isEmpty()


def test_untouched_histories_are_not_shuffled(frame):
    dim = spliced(None, frame([(i, D[2], "a") for i in range(50)], KV))
    plan = planned(splice_scd2(dim, changes(frame([(7, D[1], "z")], KV)), ["k"], AT))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    with pytest.raises(ValueError):
        splice_scd2(dim, changes(frame([], KV)), [], AT)
    assert history(spliced(dim, frame([], KV))) == history(dim)
