"""Periodic runs, whitening and mixing against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from fixtures import documents, empty, frame_of, workers_import_the_package  # noqa: F401

from tidemark.llm import mixing, periods, whitening

# ---- runs


def plain_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            if j > i and length >= max(6, 4 * q):
                own = words[start : start + length]
                smallest = next(p for p in range(1, q + 1) if all(own[k] == own[k + p] for k in range(length - p)))
                if smallest == q:
                    out.add((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, size):
    words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, size))]
    for _ in range(rng.randint(0, 3)):
        at, p = rng.randrange(len(words) + 1), rng.randint(1, 7)
        words[at:at] = words[at : at + p] * rng.randint(1, 12)
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs(seed):
    rng = random.Random(seed)
    texts = [periodic(rng, 60) for _ in range(12)]
    assert periods.runs_of(texts) == [plain_runs(words) for words in texts]


def test_runs_of_long_texts(monkeypatch):
    rng = random.Random(5)
    noise = [b"%d" % rng.randrange(5000) for _ in range(15_000)]
    block = [b"%d" % rng.randrange(3) for _ in range(700)]
    words = noise[:5000] + block * 5 + [b"x"] * 4000 + noise[5000:]
    found = periods.runs_of([words])
    assert (5000, 3500, 700) in found[0] and (8500, 4000, 1) in found[0]
    assert all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in found[0])
    monkeypatch.setattr(periods, "CELLS", 50)
    assert periods.runs_of([words]) == found
    monkeypatch.setattr(periods, "STEADY", 1)  # splitting decides nothing
    assert periods.runs_of([words]) == found


def test_rare_words_split_until_nothing_changes():
    # Only after z has split the text are there too few a to the left of it.
    words = [b"a", b"b", b"a", b"b", b"a", b"b", b"z", b"a", b"b", b"a", b"b", b"a", b"b", b"a", b"b", b"q"]
    codes = np.array([{b"a": 0, b"b": 1, b"z": 2, b"q": 3}[w] for w in words])
    assert periods.split(codes, np.array([0]), np.array([len(words)])) == [(7, 15)]


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    longest = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_digest(spark):
    rng = random.Random(8)
    rows = [r for r in documents() if len(r[1] or "") < 3000]
    rows += [(i, b" \n".join(periodic(rng, 90)).decode(), "s", 1, "k", 2, 3) for i in range(6000, 6200)]
    rows += [(None, "é é é é é é \x1c x\x85y", None, None, None, None, None), (7000, "a b " * 9, "s", 1, "k", 2, 3)]
    got = [tuple(r) for r in periods.digest(frame_of(spark, rows), periods.repeated_tail).collect()]
    assert Counter(got) == Counter(plain_digest(r[0], r[1]) for r in rows)
    assert sum(1 for r in got if r[1]) > 100
    assert periods.digest(empty(spark)).count() == 0


def test_collapsed_texts(spark):
    rows = [(1, "so it is it is it is it is it is then", "s", 1, "k", 2, 3), (2, None, "s", 1, "k", 2, 3)]
    docs = frame_of(spark, rows)
    assert sorted(tuple(r) for r in periods.collapsed_texts(docs).collect()) == [(1, "so it is then"), (2, "")]
    assert [[tuple(x) for x in r.runs] for r in periods.runs(docs).orderBy("doc_id").collect()] == [[(1, 10, 2)], []]


# ---- whitening

VECTORS = "vec_id long, embedding array<double>, label int, n string, component int"


def whitening_rows(seed, n=300, size=9):
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) + 3 * rng.normal(size=size)
    rows = [(i, v.tolist(), 1, "s", 2) for i, v in enumerate(matrix)]
    rows[3] = (3, None, 1, "s", 2)
    rows[5] = (5, [None, *[1.0] * (size - 1)], 1, "s", 2)
    rows[6] = (6, [math.nan, *[1.0] * (size - 1)], 1, "s", 2)
    rows[7] = (7, [-math.inf, *[1.0] * (size - 1)], 1, "s", 2)
    rows[8] = (8, [0.0] * size, 1, "s", 2)
    return [*rows, rows[10], (None, rows[11][1], 1, "s", 2)]


def kept_vectors(rows, size):
    good = [(i, v) for i, v, *_ in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    return [i for i, _ in good], np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], object).reshape(len(good), size)


@pytest.mark.parametrize("seed,size", [(0, 9), (1, 40), (2, 1)])
def test_whitening(spark, seed, size):
    rows = whitening_rows(seed, size=size)
    found = whitening.report(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    ids, x = kept_vectors(rows, size)
    n, sums = len(ids), x.sum(axis=0)
    exact = n * x - sums
    centred = exact.astype(float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(size, 32)
    assert len(found) == n * count and {r.n for r in found} == {n}
    assert Counter(r.vec_id for r in found) == Counter({i: count * c for i, c in Counter(ids).items()})
    want = {(i, int(d)) for i, d in zip(ids, (exact**2).sum(axis=1))}
    assert {(r.vec_id, r.deviation) for r in found} == want
    assert {r.identity_error for r in found} == {max(r.identity_error for r in found)} and found[0].identity_error < 1e-9
    table = defaultdict(dict)
    for r in found:
        table[r.component][r.vec_id] = r.whitened
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-10)
    for component, own in table.items():
        plain = centred @ vectors[:, component - 1] / math.sqrt(values[component - 1])
        got = np.array([own[i] for i in ids])
        assert min(np.abs(got - plain).max(), np.abs(got + plain).max()) < 1e-7


def test_whitening_without_spread_and_of_several_lengths(spark):
    rows = [(i, [1.0, 2.0], 1, "s", 2) for i in range(5)] + [(9, [], 1, "s", 2)]
    assert whitening.report(spark.createDataFrame(rows, VECTORS)).count() == 0
    assert whitening.report(spark.createDataFrame([], VECTORS)).count() == 0
    rows += [(i, [float(i), 0.0, -float(i)], 1, "s", 2) for i in range(20, 30)]  # rank one
    found = whitening.report(spark.createDataFrame(rows, VECTORS)).collect()
    assert {(r.vec_id, r.component, r.n) for r in found} == {(i, 1, 10) for i in range(20, 30)}
    assert found[0].explained == pytest.approx(1.0) and found[0].identity_error < 1e-9


def test_huge_components(spark):
    rows = [(0, [1e15, 1.0], 1, "s", 2), (1, [-1e15, 2.0], 1, "s", 2), (2, [1e16, 7.0], 1, "s", 2), (3, [1e30, 1.0], 1, "s", 2)]
    found = whitening.report(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.vec_id for r in found} == {0, 1, 2} and {r.deviation for r in found} == {None}  # beyond longs
    x = [64 * 10**15, -64 * 10**15]
    assert whitening._squares(whitening._deviations(np.array([[5], [7]]), 2, [12])) == [4, 4]
    assert whitening._deviations(np.array([[x[0]], [x[1]]]), 10**6, [0]).ravel().tolist() == [x[0] * 10**6, x[1] * 10**6]


@pytest.mark.parametrize("seed", range(4))
def test_eigenproblem(seed):
    rng = np.random.default_rng(seed)
    spread = 10.0 ** -np.arange(0, 12, 12 / 25)[:25]
    basis, _ = np.linalg.qr(rng.normal(size=(25, 25)))
    matrix = (basis * spread) @ basis.T if seed else np.diag(spread)
    matrix = (matrix + matrix.T) / 2
    order, factor = whitening.pivoted_cholesky(matrix)
    assert np.allclose((factor @ factor.T), matrix[np.ix_(order, order)], atol=1e-13)
    values, vectors = whitening.eigen(matrix)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][: values.size], rtol=1e-6, atol=1e-15)
    assert np.allclose(vectors.T @ vectors, np.eye(values.size), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13


# ---- mixing

DOCS = "doc_id long, text string, source string, size int, merit double, nth string, target int"


def mixing_rows(seed):
    rng = random.Random(seed)
    rows = [(i, t, rng.choice(["a", "b", "é", "z", None]), 1, rng.choice([None, -1.0, 0.5, 1.0, 4.0]), "x", 2) for i, t, *_ in documents(seed)]
    rows += [(1000 + i, "w " * rng.randint(0, 30), "a", 1, 1.0, "x", 2) for i in range(400)]  # a hot source
    rows += [(3000 + i, "w " * 40, "Z", 1, 1.0, "x", 2) for i in range(2)]  # far below its share
    rows += [(None, "one two three four", "b", 1, 2.0, "x", 2)] * 9 + [(4000, "same", "b", 1, 2.0, "x", 2)] * 30
    return rows + [(5000, None, "none", 1, 1.0, "x", 2)]


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = sum(w for s, w in weight.items() if s not in capped)
        level = (total - sum(3 * sizes[s] for s in capped)) / rest if rest else 0.0
        above = {s for s in sizes if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in capped else min(3.0 * sizes[s], level * weight[s]) for s in sizes}
        capped |= above


@pytest.mark.parametrize("seed,merit", [(0, None), (3, "merit")])
def test_mixing(spark, seed, merit):
    rows = mixing_rows(seed)
    docs = spark.createDataFrame(rows, DOCS)
    found = [tuple(r) for r in mixing.mix(docs.repartition(5), merit=merit).collect()]
    again = [tuple(r) for r in mixing.mix(docs.repartition(2, "size"), merit=merit).collect()]
    assert Counter(found) == Counter(again)
    sizes, longest = Counter(), defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").encode().split())
    want = plain_targets(sizes)
    assert Counter((r[0], r[1], r[3]) for r in found) == Counter((d, s, len((t or "").encode().split())) for d, t, s, *_ in rows)
    taken = Counter()
    for _, source, _, size, source_size, target, copies, words in found:
        assert source_size == sizes[source] and target == pytest.approx(want[source], rel=1e-12)
        assert words == copies * size and copies <= 3
        taken[source] += words
        longest[source] = max(longest[source], size)
    for source, target in want.items():
        assert taken[source] <= target + 1e-6
        if merit is None:
            assert taken[source] >= target - longest[source]
    assert taken["a"] > 0.99 * want["a"]
    if merit is not None:
        liked = {(d, s, hashlib.md5(t.encode()).hexdigest() if t is not None else "-") for d, t, s, _, m, *_ in rows if m and m > 0}
        assert all((r[0], r[1], r[2]) in liked for r in found if r[6])


def test_mixing_equals_its_sql(spark, tmp_path):
    rows = mixing_rows(2)
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(path)
    found = mixing.mix(spark.read.parquet(path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        want = db.execute(mixing.REFERENCE).fetchall()
        names = [c[0] for c in db.description]
    assert Counter(tuple(r[c] for c in names) for r in found.collect()) == Counter(want)


def test_mixing_of_little(spark, monkeypatch):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    none = spark.createDataFrame([(1, "", "a", 1, 1.0, "x", 2), (2, None, None, 1, 1.0, "x", 2)], DOCS)
    assert [r.taken for r in mixing.mix(none).collect()] == [0, 0]
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 4)  # many equal rows are dealt over tasks
    same = spark.createDataFrame([(1, "a b", "a", 1, 1.0, "x", 2)] * 11 + [(2, "c d", "b", 1, 1.0, "x", 2)] * 30, DOCS)
    found = mixing.mix(same).collect()
    taken = Counter()
    for r in found:
        taken[r.source] += r.taken
    assert len(found) == 41 and abs(taken["a"] - 82 * 5 / 7) <= 2 and abs(taken["b"] - 82 * 2 / 7) <= 2


def test_merit_raises_inclusion(spark):
    rows = [(i, "w w", "ab"[i % 2], 1, 1.0 + 2 * (i % 4 > 1), "x", 2) for i in range(4000)]
    found = mixing.mix(spark.createDataFrame(rows, DOCS), merit="merit").where("source = 'b'").collect()  # 2 of 7 of all words
    often = Counter()
    for r in found:
        often[rows[r.doc_id][4]] += r.copies
    assert 2.5 < often[3.0] / often[1.0] < 3.5


def test_the_mix_itself(spark):
    docs = spark.createDataFrame(mixing_rows(4), DOCS)
    mixed = mixing.mix(docs).cache()
    words = mixing.texts(docs, mixed).select(mixing.word_count(mixing.F.col("text")).alias("n")).agg(mixing.F.sum("n")).first()[0]
    assert words == mixed.agg(mixing.F.sum("taken")).first()[0]
