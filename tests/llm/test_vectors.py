"""Vector searches against plain sorting."""

import math
from fractions import Fraction

import numpy as np
import pytest
from fixtures import workers_import_the_package  # noqa: F401

from tidemark.llm import neighbours, topk
from tidemark.llm.neighbours import every_twentieth

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def vectors(seed, n=400, size=12):
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, size)).astype(np.float32)
    matrix[50:150] = matrix[40]  # ties
    rows = [(i, v.tolist(), 1, "s", 2) for i, v in enumerate(matrix)]
    rows[3] = (3, None, 1, "s", 2)
    rows[5] = (5, [0.0] * size, 1, "s", 2)
    rows[7] = (7, [None, *[1.0] * (size - 1)], 1, "s", 2)
    rows[9] = (9, [math.nan, *[1.0] * (size - 1)], 1, "s", 2)
    rows[20] = (20, [math.inf, *[1.0] * (size - 1)], 1, "s", 2)
    rows[40] = (40, [0.0] * size, 1, "s", 2)
    rows[60] = (60, [3.0, 4.0], 1, "s", 2)  # another length
    rows[61] = (61, [1.0, -1.0], 1, "s", 2)
    rows[62] = (62, [], 1, "s", 2)
    return rows


def good(vector, zero):
    return vector and all(x is not None and math.isfinite(x) for x in vector) and (zero or any(vector))


def plain(rows, zero, change, k=20):
    kept = [(i, change(np.array(v, np.float64))) for i, v, *_ in rows if good(v, zero)]
    out = []
    for q, x in kept:
        if q % 20 == 0:
            near = sorted((-float((x * y).sum()), i) for i, y in kept if i != q and y.size == x.size)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_nearest(spark, seed):
    rows = vectors(seed)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in neighbours.search(table, every_twentieth(table)).collect())
    want = plain(rows, False, lambda v: v)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)


@pytest.mark.parametrize("seed", range(2))
def test_topk(spark, seed):
    rows = vectors(seed)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in topk.search(table, every_twentieth(table)).collect())
    assert got == plain(rows, True, lambda v: np.floor(64 * v))


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 1, "s", 2), (1, [2.0, 1.0], 1, "s", 2)], SCHEMA)
    none = few.where("false")
    for search in (neighbours.search, topk.search):
        assert [tuple(r)[:3] for r in search(few, every_twentieth(few)).collect()] == [(0, 1, 1)]
        assert search(none, none).count() == 0


def test_repeated_rows_count_each(spark):
    rows = [(0, [1.0, 0.0], 1, "s", 2), (0, [1.0, 0.0], 1, "s", 2), (1, [2.0, 0.0], 1, "s", 2), (1, [2.0, 0.0], 1, "s", 2)]
    table = spark.createDataFrame(rows, SCHEMA)
    for search in (neighbours.search, topk.search):
        assert [r.vec_id for r in search(table, every_twentieth(table)).collect()] == [1, 1]


def test_products_beyond_doubles_stay_exact():
    q, v = np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0], [2.0**25, 3.0], [5.0, 7.0]])
    assert topk.split(q, v).sum(axis=0).tolist() == [[2**60 + 1, 2**55 + 3, 5 * 2**30 + 7]]


WIDE = SCHEMA.replace("float", "double")


def stretched(seed, sizes, n=120, size=6):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=size) * rng.choice(sizes)).tolist(), 1, "s", 2) for i in range(n)]


@pytest.mark.parametrize("sizes", [[1e160, 1.0, 1e150], [1e-200, 1e-160, 1.0], [1e-310, 1e307]])
def test_nearest_of_components_of_any_size(spark, sizes):
    rows = stretched(4, sizes)
    table = spark.createDataFrame(rows, WIDE).repartition(3)
    got = sorted(tuple(r) for r in neighbours.search(table, every_twentieth(table)).collect())
    want = []
    for q, x, *_ in rows[::20]:
        scores = []
        for i, y, *_ in rows:
            if i != q:
                try:
                    score = float(sum(Fraction(a) * Fraction(b) for a, b in zip(x, y)))
                except OverflowError:
                    score = math.inf if sum(Fraction(a) * Fraction(b) for a, b in zip(x, y)) > 0 else -math.inf
                scores.append((score, i))
        want.append((q, scores))
    for q, scores in want:
        own = [(i, s) for query, _, i, s in got if query == q]
        assert len(own) == 20
        exact = {i: s for s, i in scores}
        least = 1e-12 * max((abs(s) for s in exact.values() if math.isfinite(s)), default=0.0)
        for (i, s), best in zip(own, sorted(exact.values(), reverse=True)):
            assert s == exact[i] or math.isclose(s, exact[i], rel_tol=1e-9, abs_tol=least)
            assert s == best or math.isclose(s, best, rel_tol=1e-9, abs_tol=least)


@pytest.mark.parametrize("sizes", [[1e7, 1.0, 3e6], [1e20, 1.0, 1e3], [1e305, 1.0]])
def test_topk_of_components_of_any_size(spark, sizes):
    rows = stretched(5, sizes)
    table = spark.createDataFrame(rows, WIDE).repartition(3)
    got = sorted(tuple(r) for r in topk.search(table, every_twentieth(table)).collect())

    def whole(x):
        return [math.floor(64 * Fraction(c)) for c in x]

    want = []
    for q, x, *_ in rows[::20]:
        a = whole(x)
        scores = [(i, sum(m * n for m, n in zip(a, whole(y)))) for i, y, *_ in rows if i != q]
        top = sorted((-max(-topk.LIMIT, min(topk.LIMIT, s)), i) for i, s in scores)[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(top)]
    assert got == sorted(want)
