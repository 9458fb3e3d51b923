"""Operators that compare texts with one another, and the pipeline."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import documents, empty, frame_of, workers_import_the_package  # noqa: F401

from tidemark.llm import anchors, components, jaccard, repeats, shingles, toxicity


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) >= 5:
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def plain_classes(rows):
    sets = [(doc, plain_set(text)) for doc, text, *_ in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted((doc, len(s), least[top(i)]) for i, (doc, s) in enumerate(sets))


def test_shingle_sets():
    texts = [t for _, t, *_ in documents()]
    assert [s.size for s in shingles.shingle_sets(texts)] == [len(plain_set(t)) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_signature(seed):
    """The lemma behind the join: for all sizes and any choice of common tokens."""
    rng = np.random.default_rng(seed)
    for _ in range(400):
        n = int(rng.integers(1, 200))
        pool = rng.integers(0, 2**63, 2 * n + 10).astype(np.uint64)
        one = np.unique(pool[:n])
        drop = int(rng.integers(0, n // 5 + 1))
        other = np.unique(np.concatenate([one[rng.permutation(one.size)[drop:]], pool[n : n + int(rng.integers(0, n // 5 + 1))]]))
        shared = np.intersect1d(one, other).size
        common = np.sort(one[rng.random(one.size) < rng.random()])
        if not np.array_equal(one, other) and jaccard.linked(shared, one.size, other.size):
            assert np.intersect1d(jaccard.signatures(one, common), jaccard.signatures(other, common)).size


def test_words_made_to_meet_have_hashes_of_their_own(spark):
    signs = [0]
    while len(signs) < 1024:
        signs += [1 - s for s in signs]
    one, other = ("".join(pair[s] for s in signs) for pair in ("ab", "ba"))
    a, b = shingles.shingle_sets([one, other])
    assert a.size == b.size == 1 and a[0] != b[0]
    docs = frame_of(spark, [(1, one, "s", 1, "k", 2, 3), (2, other, "s", 1, "k", 2, 3)])
    assert sorted((r.doc_id, r.component_id) for r in jaccard.classes(docs).collect()) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_tokens_are_counted_in_parts(seed):
    rng = np.random.default_rng(seed)
    tokens, counts = jaccard._no_counts()
    seen: Counter = Counter()
    for _ in range(5):
        sets = [np.unique(rng.integers(0, 60, rng.integers(0, 30), np.uint64)) for _ in range(rng.integers(0, 6))]
        seen.update(t for s in sets for t in s.tolist())
        tokens, counts = jaccard.counted(tokens, counts, sets)
        assert dict(zip(tokens.tolist(), counts.tolist())) == seen
        assert (np.diff(tokens.astype(np.int64)) > 0).all()


def test_frequent_tokens_are_counted_in_little_memory(spark, monkeypatch):
    held = {}

    def keep(frame, function, schema):
        held.setdefault("run", function)
        return taken(frame, function, schema)

    frame = frame_of(spark)
    taken = type(frame).mapInArrow
    monkeypatch.setattr(type(frame), "mapInArrow", keep)
    jaccard.common_tokens(frame, 1)
    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": [*texts, " ".join([*(f"w0x{j}" for j in range(500)), "end"])]})
    tracemalloc.start()
    out = pa.Table.from_batches(list(held["run"](iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(out["texts"].to_pylist()) == [2] * 496
    distinct = 2000 * 496 + 1
    assert peak < 70 * distinct  # bytes: 89 a token where all were sorted at once, 59 now
    monkeypatch.setattr(jaccard, "COUNTED", 10_000)
    monkeypatch.setattr(jaccard, "TOGETHER", 5_000)
    again = pa.Table.from_batches(list(held["run"](iter([batch.slice(0, 100), batch.slice(2000, 1)]))))
    assert all(n == 2 for n in again["texts"].to_pylist())


def test_thresholds_of_large_sets_are_exact():
    own = np.arange(400_000, dtype=np.uint64)
    at = np.concatenate([own, np.arange(500_000, 600_000, dtype=np.uint64)])  # 400,000 of 500,000
    below = np.append(at, np.uint64(700_000))
    assert jaccard.links_within([(1, 1, own)], [(2, 2, at)]) == [(1, 2)] and jaccard.links_within([(1, 1, own)], [(2, 2, below)]) == []


def test_slices_are_cut_by_bytes():
    import pyarrow as pa

    from tidemark.llm.common import slices

    texts = ["x" * 10] * 7 + [None, "y" * 100, "", "z" * 30, "é" * 20]
    batch = pa.RecordBatch.from_pydict({"n": list(range(12)), "text": texts})
    parts = [p["text"] for p in slices([batch, batch.slice(12)], rows=4, size=45)]
    assert parts == [["x" * 10] * 4, ["x" * 10] * 3 + [None], ["y" * 100], ["", "z" * 30], ["é" * 20]]


def test_classes(spark):
    for seed in range(2):
        rows = documents(seed)
        rows = [r for r in rows if r != (12, "another text of the same id", "s", 1, "k", 2, 3)]
        got = sorted(tuple(r) for r in jaccard.classes(frame_of(spark, rows)).collect())
        assert got == plain_classes(rows)
    assert jaccard.classes(empty(spark)).count() == 0


def test_a_chain_of_near_copies_is_one_class(spark):
    """Ends that are unlike are linked through the middle; a large star leaves members to compare in full."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words), "s", 1, "k", 2, 3))
        words[(i * 7) % 120] = f"n{i}{rng.randint(0, 9)}"
    got = sorted(tuple(r) for r in jaccard.classes(frame_of(spark, rows)).collect())
    assert got == plain_classes(rows)


@pytest.mark.parametrize("seed", range(3))
def test_sketches_leave_every_linked_pair_open(seed):
    rng = np.random.default_rng(seed)
    ruled_out = 0
    for _ in range(400):
        n = int(rng.integers(1, 400))
        pool = rng.integers(0, 2**63, 3 * n + 10).astype(np.uint64)
        one = np.unique(pool[:n])
        drop = int(rng.integers(0, n // 3 + 1))
        other = np.unique(np.concatenate([one[rng.permutation(one.size)[drop:]], pool[n : n + int(rng.integers(0, n // 3 + 1))]]))
        x, y = (np.frombuffer(jaccard.parities(s), np.uint64) for s in (one, other))
        words = min(x.size, y.size)
        may = jaccard.may_link(jaccard.folded(x, words), jaccard.folded(y, words), np.int64(one.size), np.int64(other.size))
        ruled_out += not may
        assert may or not jaccard.linked(np.intersect1d(one, other).size, one.size, other.size)
    assert ruled_out > 50


def test_whole_sets_are_read_for_probable_pairs_alone(spark, monkeypatch):
    """Texts that share a passage are candidates; that most of them do not link is seen without their sets."""
    rng = random.Random(3)
    rows = []
    for group in range(40):
        passage = " ".join(f"p{group}x{i}" for i in range(60))
        for part in range(3):
            own = " ".join(f"w{rng.randrange(10**9)}" for _ in range(120))
            rows.append((3 * group + part, f"{own} {passage}", "s", 1, "k", 2, 3))
    rows.append((1000, rows[5][1] + " more", "s", 1, "k", 2, 3))
    read, candidates = [], []
    sets, groups = jaccard.needed_sets, jaccard.candidate_groups
    monkeypatch.setattr(jaccard, "needed_sets", lambda *a: read.append(sets(*a)) or read[-1])
    monkeypatch.setattr(jaccard, "candidate_groups", lambda *a: candidates.append(groups(*a)) or candidates[-1])
    assert sorted(tuple(r) for r in jaccard.classes(frame_of(spark, rows)).collect()) == plain_classes(rows)
    assert candidates[0].count() > 40 and sum(r.count() for r in read) <= 10


def test_texts_are_cut_into_shingles_once(spark, monkeypatch):
    """One pass over all texts gives sets, sketches and signatures; later ones read what sketches leave open."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "s", 1, "k", 2, 3) for i in range(50)]
    rows.append((50, rows[3][1] + " more", "s", 1, "k", 2, 3))
    whole = []
    inner = jaccard.map_rows
    monkeypatch.setattr(jaccard, "map_rows", lambda df, *a, **kw: whole.append("text" in df.columns and df.count() == 51) or inner(df, *a, **kw))
    assert sorted(tuple(r) for r in jaccard.classes(frame_of(spark, rows)).collect()) == plain_classes(rows)
    assert sum(whole) == 1


def test_signatures_of_many_sets_are_those_of_each():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in [0, 1, 2, 3, 5000, *rng.integers(0, 300, 600).tolist()]]
    common = np.sort(np.concatenate([s[rng.random(s.size) < rng.random()] for s in sets]))
    values, owners = jaccard.signatures_of(sets, common)
    for i, s in enumerate(sets):
        assert np.array_equal(np.sort(values[owners == i]), np.sort(jaccard.signatures(s, common)))
    empty = np.zeros(0, np.uint64)
    assert jaccard.signatures_of([], common)[0].size == jaccard.signatures_of([empty], common)[0].size == 0
    assert jaccard.set_ids([]) == [] and jaccard.set_ids([empty, sets[3], empty])[::2] == [None, None]


def test_chains_of_stars_are_compared_star_by_star(spark, monkeypatch):
    """Stars that share a set with the next one: pairs grow with the stars and not with the square of the chain."""
    monkeypatch.setattr(jaccard, "WHOLE", 8)
    rows = [(10 * i, 10 * i + k, 10 * i, 10 * i + k) for i in range(60) for k in (1, 2, 3, 10)]
    rows += [(-5, k, -5, k) for k in (-4, -3, -2)]  # a unit of few sets stays whole
    # Stars that have nearly all sets in common stay together too.
    rows += [(-100 + i, k, -100 + i, k) for i in range(20) for k in range(-99 + i, -78)]
    units = jaccard.comparison_units(spark.createDataFrame(rows, "hub bigint, set_id bigint, hub_root bigint, root bigint")).collect()
    stars: dict[int, set[int]] = {}
    for unit, set_id, root in units:
        assert root == set_id
        stars.setdefault(unit, set()).add(set_id)
    assert len(units) == len(set(units)) and sum(len(s) ** 2 for s in stars.values()) == 60 * 5**2 + 4**2 + 22**2
    for hub, set_id, *_ in rows:
        assert any({hub, set_id} <= s for s in stars.values())

    # Chained passages: in each group two of three texts link, so that its star is left open.
    rng = random.Random(7)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passages = [words(60) for _ in range(25)]
    docs = []
    for i in range(24):
        body = f"{passages[i]} {words(100)} {passages[i + 1]}"
        docs += [(2 * i, body, "s", 1, "k", 2, 3), (2 * i + 1, f"{body} more", "s", 1, "k", 2, 3)]
    monkeypatch.setattr(jaccard, "WHOLE", 1)
    assert sorted(tuple(r) for r in jaccard.classes(frame_of(spark, docs)).collect()) == plain_classes(docs)


def test_components(spark, monkeypatch):
    rng = random.Random(1)
    for chunk in (500_000, 25):
        monkeypatch.setattr(components, "CHUNK", chunk)
        links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 350)]
        root = {}

        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
        nodes = {x for a, b in links if a != b for x in (a, b)}
        got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert sorted((r.node, r.root) for r in got) == sorted((x, top(x)) for x in nodes)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_one_centre_are_dealt_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 100)
    links = spark.createDataFrame([(i, 0) for i in range(1, 2001)] + [(i, i - 1) for i in range(5001, 5101)], "u long, v long")
    sizes = [r["count"] for r in components.dealt(links, 21).groupBy("chunk").count().collect()]
    assert sum(sizes) == 2100 and max(sizes) <= 300
    got = components.components(links.select(links["u"].alias("a"), links["v"].alias("b"))).collect()
    assert sorted((r.node, r.root) for r in got) == [(i, 0) for i in range(2001)] + [(i, 5000) for i in range(5000, 5101)]


# ---- repeats

def plain_repeats(rows, width=200):
    encoded = [(text or "").encode() for _, text, *_ in rows]
    seen = Counter(data[s : s + width] for data in encoded for s in range(len(data) - width + 1))
    out = []
    for (doc, *_), data in zip(rows, encoded):
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - width + 1):
            if seen[data[s : s + width]] > 1:
                gone[s : s + width] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_repeats(spark, seed):
    rows = documents(seed)
    assert sorted(tuple(r) for r in repeats.digest(frame_of(spark, rows)).collect()) == plain_repeats(rows)


def test_repeats_of_nothing(spark):
    assert repeats.digest(empty(spark)).count() == 0
    rows = [(1, None, "s", 1, "k", 2, 3), (2, "short", "s", 1, "k", 2, 3)]
    assert [r.n_removed for r in repeats.digest(frame_of(spark, rows)).collect()] == [0, 0]


def test_steps_cut_no_anchor(monkeypatch):
    rng = np.random.default_rng(4)
    raw = rng.integers(0, 3, 3000).astype(np.uint8)
    ends = np.array([700, 700, 900, 3000])
    whole = [a.tolist() for a in anchors.anchors(raw, ends)]
    monkeypatch.setattr(anchors, "STEP", 64)
    assert [a.tolist() for a in anchors.anchors(raw, ends)] == whole
    covered = sum(b - a + 1 for a, b in zip(whole[1], whole[2]))
    assert covered == sum(max(0, n - 199) for n in (700, 0, 200, 2100))


def test_wide_keys_are_dealt_over_their_buckets():
    word = np.array([5, 5, 5, 9], np.uint64)
    bucket, wide = repeats.bucket_of(np.array([3, 5, 5, 5, 7], np.uint64), word, np.array([1, 2, 3, 4], np.uint64))
    assert wide.tolist() == [True, True, True, False] and bucket[3] == 5 and all(1 <= b <= 4 for b in bucket[:3])


def test_multikey_order():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 5, 300).astype(np.uint64), rng.integers(0, 9, 300).astype(np.uint64)
    order = repeats.multikey_order(a, b)
    assert list(zip(a[order], b[order])) == sorted(zip(a, b))


# ---- toxicity

def plain_marginals(strength, model):
    import itertools

    odds = toxicity.odds(strength, model)
    total, toxic = 0.0, np.zeros(strength.size)
    for path in itertools.product((0, 1), repeat=strength.size):
        weight = math.exp(sum(o * y for o, y in zip(odds, path)) + sum(model.step[a][b] for a, b in zip(path, path[1:])))
        total += weight
        toxic += weight * np.array(path)
    return toxic / total


def test_marginals_equal_enumeration():
    model = toxicity.Model({}, (-1.0, 0.2, 0.3, 1.5, 0, 0, 0, 0), (-0.1, 0.4, 0, 0.3, 0, 0, 0, 0), (0.2, 0, 0, -0.4, 0, 0, 0, 0), ((0, -1.0), (0.5, 0.8)))
    rows = [np.array(r) for r in ([1, 0, 3, 0, 2], [0], [3, 3], [0, 0, 1])]
    found = toxicity.forward_backward([toxicity.odds(r, model) for r in rows], np.array(model.step))
    for r, m in zip(rows, found):
        assert np.allclose(m, plain_marginals(r, model))
    for n in (0, 1, 2, 3, 9, 500):
        whole = toxicity.forward_backward([toxicity.odds(np.zeros(n, int), model)], np.array(model.step))[0].sum() if n else 0
        assert abs(toxicity.expected_without_hits(model, n) - whole) < 1e-5 * max(1, n)


def labelled(spark, n=1200):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text, toxic = [rng.choice(words) for _ in range(rng.randint(3, 60))], i % 5 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Vile!", "rotten", "nasty,"]))
        rows.append((i, " ".join(text), "s", 1, "k", 2, 3))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string, rank int, key string, removed int, n_chars long"), spark.createDataFrame(
        [*labels, (None, 1), (3, None), (10**6, 1)], "doc_id long, toxic int"
    )


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    assert {"vile", "rotten", "nasty"} <= set(model.lexicon)
    scored = docs.select("doc_id", toxicity.score_column(model).alias("s"), toxicity.held_out().alias("h")).where("h").collect()
    wrong = [r for r in scored if (r.s >= toxicity.THRESHOLD) != (r.doc_id % 5 == 0)]
    assert len(scored) > 300 and len(wrong) <= 3
    texts = [(1, "vile nasty rotten word"), (2, None), (3, ""), (4, "İ vile")]
    spans = {r.doc_id: r for r in toxicity.spans(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert spans[1].spans[0].start == 0 and spans[2].spans == spans[3].spans == [] and spans[2].score == spans[3].score


def test_toxicity_of_long_texts(spark):
    """Long clean texts stay clean, a toxic passage far into a long text is found at its place; texts of one length are alike."""
    rng = random.Random(7)
    docs, labels = labelled(spark)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    fill = [[rng.choice(words) for _ in range(20_000)] for _ in range(4)]
    rows = [(10_000 + i, " ".join(f)) for i, f in enumerate(fill)]
    labels = labels.unionByName(spark.createDataFrame([(r[0], 0) for r in rows], "doc_id long, toxic int"))
    more = spark.createDataFrame([(r[0], r[1], "s", 1, "k", 2, 3) for r in rows], docs.schema)
    model = toxicity.fit(docs.unionByName(more), labels)
    said = "vile nasty rotten vile"
    clean = " ".join(fill[0][::-1])
    late = " ".join(["stray", *fill[1][:19_000], said, *fill[1][19_000:]])
    huge = " ".join([*fill[2] * 30, said])
    texts = [(1, clean), (2, late), (3, clean), (4, None), (5, ""), (6, huge), (2, late)]
    found = toxicity.spans(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(texts) and got[1].score == got[3].score < toxicity.THRESHOLD and got[1].spans == []
    for doc, text in ((2, late), (6, huge)):
        assert got[doc].score >= toxicity.THRESHOLD
        assert [text[s.start : s.end] for s in got[doc].spans] == [said]
    assert got[4].score == got[5].score < toxicity.THRESHOLD


def test_rare_toxic_rows_all_count(spark):
    """A sample holds every toxic row while it has room, and scores stay true to the rate of all labelled rows."""
    assert toxicity.draw(100, 9900, 400) == (1.0, 300 / 9900) and toxicity.draw(9900, 100, 400) == (300 / 9900, 1.0)
    assert toxicity.draw(5, 7, 400) == (1.0, 1.0) and toxicity.SAMPLE >= 40_000
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rare = ["vile", "rotten", "nasty", "foul", "putrid"]
    rows, labels = [], []
    for i in range(3000):
        text = [rng.choice(words) for _ in range(rng.randint(10, 40))]
        if i % 30 == 0:
            text.insert(rng.randrange(len(text)), rare[i // 30 % 5])
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 30 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), sample=500)
    assert set(rare) <= set(model.lexicon)
    scores = [r.s for r in docs.where(toxicity.held_out()).select(toxicity.score_column(model).alias("s")).collect()]
    assert 0.5 / 30 < sum(scores) / len(scores) < 2 / 30


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, 20)
    for none in (labels.where("false"), labels.where("toxic = 0")):
        model = toxicity.fit(docs, none)
        assert all(0 <= r[0] < toxicity.THRESHOLD for r in docs.select(toxicity.score_column(model)).collect())
    assert toxicity.fit(empty(spark), labels).lexicon == {}


# ---- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = frame_of(spark)
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert out.columns == columns, name
        rows = {r.doc_id for r in out.collect()}
        assert {0, 1, 2} <= rows, name  # null, empty and blank texts stay
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert step(spark, empty(spark), folder).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_near_copies_leave_one_each(spark):
    import corpus_pipeline

    rows = [r for r in documents() if r[0] != 12]
    kept = corpus_pipeline.drop_near_copies(spark, frame_of(spark, rows), "/root/testdata/sf0.001").collect()
    least = {doc: component for doc, _, component in plain_classes(rows)}
    assert sorted(r.doc_id for r in kept) == sorted(doc for doc, *_ in rows if least[doc] == doc)


def test_rows_that_repeat_and_null_ids_leave_one_each(spark):
    """Each group keeps one row, whatever ids its rows have, and that row keeps its bytes."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    rng = random.Random(31)
    texts = [" ".join(f"z{n}{rng.randrange(10**6)}" for _ in range(40)) for n in range(5)]
    near = texts[2].split(" ")
    near[0] = "changed"
    more = [(7000, texts[0]), (7000, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (None, " ".join(near))]
    # Two texts under one id, of which one has a copy with a smaller id and the other has none.
    more += [(7001, texts[3]), (7002, texts[3]), (7002, texts[4]), (None, texts[4]), (None, None), (None, None), (None, "")]
    rows = documents() + [(i, t, "s", 1, "k", 2, len(t or "")) for i, t in more]
    far = 10**9
    numbered = [(n if r[0] is None else r[0], r[1]) for n, r in enumerate(rows, far)]
    sets = [plain_set(t) for _, t in numbered]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    groups = defaultdict(list)
    for i, a in enumerate(sets):
        groups[top(i) if a else (i,)].append(i)
    out = corpus_pipeline.drop_near_copies(spark, frame_of(spark, rows), folder)
    assert out.columns == frame_of(spark, rows).columns
    single = [tuple(r) for r in out.collect()]
    count = Counter((r[0], r[1]) for r in single)
    assert len(single) == len(groups)
    for members in groups.values():
        least = min(numbered[i][0] for i in members)
        wanted = {rows[i][:2] for i in members if numbered[i][0] == least or least >= far}
        if sets[members[0]]:
            assert sum(count[w] for w in wanted) == 1
    assert count[None, None] == 2
    cut = corpus_pipeline.drop_repeats(spark, spark.createDataFrame(single, out.schema), folder).collect()
    assert Counter((r.doc_id, r.text) for r in cut) == Counter(plain_kept(single))
    whole = Counter(r.text for r in cut)
    assert all(whole[t] == 1 for t in (texts[0], texts[1], texts[3], texts[4])) and whole[texts[2]] + whole[" ".join(near)] == 1


def plain_kept(rows, width=200):
    """Id and remaining text of every row, by counting all strings of ``width`` bytes."""
    encoded = [(text or "").encode() for _, text, *_ in rows]
    seen = Counter(data[s : s + width] for data in encoded for s in range(len(data) - width + 1))
    for (doc, text, *_), data in zip(rows, encoded):
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - width + 1):
            if seen[data[s : s + width]] > 1:
                gone[s : s + width] = True
        yield doc, None if text is None else bytes(b for b, g in zip(data, gone) if not g).decode(errors="ignore")


def test_the_run_equals_its_stages_by_brute_force(spark):
    """Near copies and repeats of the run's own input, each by its plain form; personal data gone; pieces whole."""
    import corpus_pipeline
    from tidemark.llm.common import table

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    clean = spark.createDataFrame(corpus_pipeline.drop_toxic(spark, docs, folder).collect(), docs.schema)
    rows = [tuple(r) for r in clean.collect()]
    kept = {doc for doc, _, component in plain_classes(rows) if doc == component}
    single = spark.createDataFrame(corpus_pipeline.drop_near_copies(spark, clean, folder).collect(), docs.schema)
    assert {r.doc_id for r in single.collect()} == kept
    cut = {r.doc_id: r.text for r in corpus_pipeline.drop_repeats(spark, single, folder).collect()}
    want = {d: (n, gone) for d, n, gone, *_ in plain_repeats([tuple(r) for r in single.collect()])}
    for doc, text in cut.items():
        n, gone = want[doc]
        assert n - gone - 6 * (gone > 0) * n <= len(text.encode()) <= n - gone
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == kept
    used = defaultdict(int)
    for r in out:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_no_email_is_left(spark):
    import corpus_pipeline

    rows = [(1, "to a@b.cc now", "s", 1, "k", 2, 13), (2, None, "s", 1, "k", 2, 0)]
    out = {r.doc_id: r for r in corpus_pipeline.mask_personal_data(spark, frame_of(spark, rows), "").collect()}
    assert out[1].text == "to [EMAIL] now" and out[1].n_chars == len(out[1].text) and out[2].text is None
