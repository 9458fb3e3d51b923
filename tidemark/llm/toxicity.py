"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Learning: a lexicon of words that labelled toxic documents use in many different contexts (so that copies of one document
lend it no weight) turns document labels into token labels.  The field's two states are clean and toxic; a token's features
are the lexicon strength of the word and of its neighbours.  It is trained by gradient ascent on the likelihood of the
labelled tokens.  Scoring: forward-backward gives each token's toxic probability; their sum, the expected number of toxic
tokens, less that of a text as long without a word of the lexicon, goes through a logistic curve fitted to document labels.

What reaches the driver is bounded: LEXICON words, TRAIN windows of WINDOW tokens and as many sums of whole texts.  Learning reads about SAMPLE labelled
rows, half of them toxic if there are as many, chosen by a hash of the id; scoring reads every whole text.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Cache
from tidemark.llm.common import kept, map_rows, trim

SAMPLE = 40_000  # labelled rows read for learning, about; so few are broadcast by id
LEXICON = 2_000  # words at most
TRAIN = 600  # labelled documents for the field, of each a window, and for the curve, whole
WINDOW = 256  # tokens of a window
LEVELS = 8  # strengths of a word; 0 is not in the lexicon
MIN_DOCUMENTS = 4
MIN_CONTEXTS = 4  # of 63 hash cells
MIN_ODDS = 1.5
MIN_EVIDENCE = 16.0  # nats by which a word's share of toxic documents must differ from the sample's
THRESHOLD = 0.7
TOGETHER = 1 << 19  # tokens worked side by side, the longest text's for each; a longer text is worked alone
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """``own``, ``left``, ``right``: log-odds of toxic by strength of the word and its neighbours; ``step`` of transitions."""

    lexicon: dict[str, int] = field(default_factory=dict)
    own: tuple = (0.0,) * LEVELS
    left: tuple = (0.0,) * LEVELS
    right: tuple = (0.0,) * LEVELS
    step: tuple = ((0.0, 0.0), (0.0, 0.0))
    curve: tuple[float, float] = (0.0, 0.0)


# ---- the field


def odds(strength: np.ndarray, model) -> np.ndarray:
    """Log-odds of the toxic state at each token of one sequence of strengths."""
    own, left, right = (np.asarray(v) for v in (model.own, model.left, model.right))
    out = own[strength]
    if strength.size > 1:
        out[1:] += left[strength[:-1]]
        out[:-1] += right[strength[1:]]
    return out


def forward_backward(sequences: list[np.ndarray], step: np.ndarray, pairs: bool = False):
    """Toxic marginals of every token of every sequence of log-odds, worked side by side; expected transitions if asked."""
    order = sorted(range(len(sequences)), key=lambda i: -sequences[i].size)
    sizes = np.array([sequences[i].size for i in order])
    longest = int(sizes[0]) if len(sizes) else 0
    ratio = np.ones((longest, len(order)))
    for column, i in enumerate(order):
        ratio[: sequences[i].size, column] = np.exp(np.clip(sequences[i], -50, 50))
    (a00, a01), (a10, a11) = np.exp(step)
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
    forward = np.zeros((longest, len(order)))  # share of the toxic state
    for t in range(longest):
        n, r = active[t], ratio[t, : active[t]]
        if t == 0:
            forward[0, :n] = r / (1 + r)
        else:
            f1 = forward[t - 1, :n]
            f0 = 1 - f1
            toxic = (f0 * a01 + f1 * a11) * r
            forward[t, :n] = toxic / (toxic + f0 * a00 + f1 * a10)
    backward = np.full((longest, len(order)), 0.5)
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        b1 = backward[t + 1, :n] * ratio[t + 1, :n]
        b0 = 1 - backward[t + 1, :n]
        toxic = a10 * b0 + a11 * b1
        backward[t, :n] = toxic / (toxic + a00 * b0 + a01 * b1)
    toxic = forward * backward
    toxic = toxic / np.maximum(toxic + (1 - forward) * (1 - backward), 1e-300)
    marginals: list[np.ndarray] = [np.zeros(0)] * len(order)
    for column, i in enumerate(order):
        marginals[i] = toxic[: sequences[i].size, column]
    if not pairs:
        return marginals
    inside = np.arange(1, longest)[:, None] < sizes
    f1, b1 = forward[:-1], backward[1:] * ratio[1:]
    f0, b0 = 1 - f1, 1 - backward[1:]
    cells = np.array([[f0 * a00 * b0, f0 * a01 * b1], [f1 * a10 * b0, f1 * a11 * b1]])
    cells = np.where(inside, cells / np.maximum(cells.sum(axis=(0, 1)), 1e-300), 0)
    return marginals, cells.sum(axis=(2, 3))


def train_field(windows: list[np.ndarray], tags: list[np.ndarray], rounds: int = 60):
    """Weights ``own, left, right, step`` that maximise the penalised likelihood of the tags."""
    weights = np.zeros(3 * LEVELS + 3)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    total = max(1, sum(t.size for t in tags))

    def counts(values: list[np.ndarray], moves: np.ndarray) -> np.ndarray:
        out = np.zeros_like(weights)
        for w, v in zip(windows, values):
            out[:LEVELS] += np.bincount(w, v, LEVELS)
            out[LEVELS : 2 * LEVELS] += np.bincount(w[:-1], v[1:], LEVELS)
            out[2 * LEVELS : 3 * LEVELS] += np.bincount(w[1:], v[:-1], LEVELS)
        out[3 * LEVELS :] = moves[0, 1], moves[1, 0], moves[1, 1]
        return out

    moved = np.zeros((2, 2))
    for t in tags:
        np.add.at(moved, (t[:-1], t[1:]), 1)
    seen = counts([t.astype(float) for t in tags], moved)
    for k in range(1, rounds + 1):
        step = np.array([[0.0, weights[-3]], [weights[-2], weights[-1]]])
        model = Model({}, weights[:LEVELS], weights[LEVELS : 2 * LEVELS], weights[2 * LEVELS : 3 * LEVELS])
        marginals, moves = forward_backward([odds(w, model) for w in windows], step, pairs=True)
        gradient = (seen - counts(marginals, moves)) / total - 1e-5 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights = weights + 0.3 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    step = ((0.0, float(weights[-3])), (float(weights[-2]), float(weights[-1])))
    return tuple(tuple(weights[i * LEVELS : (i + 1) * LEVELS].tolist()) for i in range(3)), step


def train_curve(expected: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve of the label over the logarithm of the expected number of toxic tokens, by Newton's method."""
    x = np.column_stack([np.ones(expected.size), np.log1p(expected)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (labels - p) - np.array([1e-3, 1e-1]) * w
        hessian = (x.T * np.maximum(p * (1 - p), 1e-9)) @ x + np.diag([1e-3, 1e-1])
        w = w + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(w[0]), float(w[1])


def expected_without_hits(model: Model, length: int) -> float:
    """Expected toxic tokens of a chain of ``length`` words none of which is in the lexicon.

    The derivative of the chain's log partition by the log-odds, from powers of its 2 x 2 transfer matrix.
    """
    if length == 0:
        return 0.0
    if length < 3:
        return float(forward_backward([odds(np.zeros(length, int), model)], np.array(model.step))[0].sum())

    def log_partition(shift: float) -> float:
        edge = np.array([model.own[0] + model.right[0], model.own[0] + model.left[0]]) + shift
        inner = model.own[0] + model.left[0] + model.right[0] + shift
        moves = np.exp(np.array(model.step))
        matrix, matrix_scale = moves * np.exp([0.0, inner]), 0.0
        vector, scale, power = np.array([1.0, np.exp(edge[0])]), 0.0, length - 2
        while power:
            if power & 1:
                vector = vector @ matrix
                size = vector.sum()
                vector, scale = vector / size, scale + matrix_scale + np.log(size)
            matrix = matrix @ matrix
            size = matrix.max()
            matrix, matrix_scale = matrix / size, 2 * matrix_scale + np.log(size)
            power >>= 1
        return scale + np.log(vector @ moves @ np.array([1.0, np.exp(edge[1])]))

    return float((log_partition(1e-5) - log_partition(-1e-5)) / 2e-5)


# ---- documents


def _strengths(lexicon: dict[str, int]) -> Cache:
    get = lexicon.get
    return Cache(lambda chunks: [bytes([get(w, 0) for w in WORD.findall(c.lower())]) for c in chunks])


class Scorer:
    """Scores texts with a model; lives as long as its Python worker's task."""

    def __init__(self, model: Model):
        self.model = model
        self.cache = _strengths(model.lexicon)
        self.step = np.array(model.step)
        self.quiet = functools.lru_cache(100_000)(lambda n: expected_without_hits(model, n))

    def strengths(self, texts: list[str | None]) -> list[bytes]:
        cut = [t.split() if t else [] for t in texts]
        kept = self.cache.prepare(cut)
        return [b"".join(map(kept.__getitem__, chunks)) for chunks in cut]

    def __call__(self, texts: list[str | None]) -> tuple[list[float], list[np.ndarray | None]]:
        """Expected toxic tokens of each text beyond those of a text as long without a word of the lexicon, so that length alone says
        nothing; and the marginals of texts that have one.
        """
        words = self.strengths(texts)
        hit = [i for i, w in enumerate(words) if w.strip(b"\0")]
        marginals: list[np.ndarray | None] = [None] * len(texts)
        hit.sort(key=lambda i: len(words[i]))
        start = 0
        while start < len(hit):
            own = hit[start : start + 16]
            while len(own) > 1 and len(own) * len(words[own[-1]]) > TOGETHER:
                own = own[: len(own) // 2]
            start += len(own)
            found = forward_backward([odds(np.frombuffer(words[i], np.uint8).astype(int), self.model) for i in own], self.step)
            for i, m in zip(own, found):
                marginals[i] = m
        expected = [0.0 if m is None else max(0.0, float(m.sum()) - self.quiet(len(w))) for w, m in zip(words, marginals)]
        return expected, marginals

    def probability(self, expected: list[float]) -> np.ndarray:
        a, b = self.model.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(np.array(expected, float)), -30, 30)))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 3 == 1


def draw(toxic: int, clean: int, sample: int) -> tuple[float, float]:
    """Shares of the toxic and of the clean rows that make a sample: half toxic, or all rows of a class that has fewer."""
    most = max(sample / 2, sample - clean)
    share = min(1.0, most / max(toxic, 1))
    return share, min(1.0, (sample - share * toxic) / max(clean, 1))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows that are not held out.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null or other label, or without a document, teach nothing; of equal texts
    one counts.  Without toxic or without clean rows the model knows no word and scores each text alike.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn = draw(sizes.get(1, 0), sizes.get(0, 0), sample)
    if min(drawn) < 1:
        limit = F.when(F.col("toxic") == 1, int(1_000_003 * drawn[0])).otherwise(int(1_000_003 * drawn[1]))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < limit)
    # At most about SAMPLE ids: no text without a chosen label is shuffled.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").where(F.col("text").isNotNull())
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.min(F.struct("doc_id", "toxic", "text")).alias("d")).select("d.*")
    rows = rows.persist()
    tally = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = tally.get(1, 0), tally.get(0, 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1)
        rows.unpersist()
        return Model(curve=(float(np.log(share / (1 - share))), 0.0))

    def uses(part: dict[str, list]) -> dict[str, list]:
        seen: dict[str, list[int]] = {}
        for text, label in zip(part["text"], part["toxic"]):
            words = WORD.findall(text.lower())
            if label:
                cells: dict[str, int] = {}
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    cells[word] = cells.get(word, 0) | 1 << hash_cell(before, after)
            else:
                cells = dict.fromkeys(words, 0)
            for word, cell in cells.items():
                entry = seen.setdefault(word, [0, 0, 0])
                entry[label] += 1
                entry[2] |= cell
        counts = list(seen.values())
        return {"word": list(seen), "clean": [c[0] for c in counts], "toxic": [c[1] for c in counts], "cells": [c[2] for c in counts]}

    words = map_rows(rows.select("text", "toxic"), uses, "word string, clean bigint, toxic bigint, cells bigint")
    words = words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_count(F.bit_or("cells")).alias("contexts"))
    strength = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    uses_of = F.col("toxic") + F.col("clean")
    evidence = F.col("toxic") * F.log(F.col("toxic") / uses_of * ((toxic + clean) / toxic)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / uses_of * ((toxic + clean) / clean))
    ).otherwise(0.0)
    best = (
        words.where((F.col("toxic") >= MIN_DOCUMENTS) & (F.col("contexts") >= MIN_CONTEXTS))
        .withColumn("strength", strength)
        .where((F.col("strength") >= MIN_ODDS) & (evidence >= MIN_EVIDENCE))
        # Used in nearly as many contexts as documents: a word of copies is not.
        .where(F.col("contexts") >= 0.5 * 63 * (1 - F.exp(-F.col("toxic") / 63.0)))
        .orderBy(F.desc("strength"), "word")
        .limit(LEXICON)
        .collect()
    )
    lexicon = {r["word"]: int(np.clip(1 + np.floor(r["strength"] - MIN_ODDS), 1, LEVELS - 1)) for r in best}

    def window(part: dict[str, list]) -> dict[str, list]:
        out = []
        for text in part["text"]:
            words = bytes([lexicon.get(w, 0) for w in WORD.findall(text.lower())])
            first = len(words) - len(words.lstrip(b"\0"))
            start = max(0, min(first, len(words)) - WINDOW // 2) if first < len(words) else 0
            out.append(words[start : start + WINDOW])
        return {"toxic": part["toxic"], "words": out}

    share = min(1.0, TRAIN / 2 / toxic), min(1.0, TRAIN / 2 / clean)
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_003)) < F.when(F.col("toxic") == 1, share[0] * 1_000_003).otherwise(share[1] * 1_000_003)
    picked = rows.where(chosen & F.col("text").rlike(r"\p{L}")).select("text", "toxic")
    taken = map_rows(picked, window, "toxic int, words binary").collect()
    taken = sorted((bytes(r["words"]), r["toxic"]) for r in taken if r["words"])
    windows = [np.frombuffer(w, np.uint8).astype(int) for w, _ in taken]
    tags = [(w > 0).astype(int) * label for w, (_, label) in zip(windows, taken)]
    (own, left, right), step = train_field(windows, tags)
    model = Model(lexicon, own, left, right, step)

    def expected(part: dict[str, list]) -> dict[str, list]:
        return {"toxic": part["toxic"], "expected": Scorer(model)(part["text"])[0]}

    # The curve is fitted to what it is applied to: the sums of whole texts.
    sums = sorted(map(tuple, map_rows(picked, expected, "toxic int, expected double").collect()))
    rows.unpersist()
    label = np.array([t for t, _ in sums], float)
    curve = train_curve(np.array([e for _, e in sums]), label)
    # The rows picked hold toxic rows at a higher rate than the labelled rows: set the curve's constant back.
    shift = np.log(toxic / drawn[0] / (clean / drawn[1])) - np.log(max(label.sum(), 0.5) / max(label.size - label.sum(), 0.5))
    return Model(lexicon, own, left, right, step, (curve[0] + float(shift), curve[1]))


def hash_cell(before: str, after: str) -> int:
    """One of 63 cells for a context, alike in every process."""
    value = 1469598103934665603
    for c in f"{before} {after}":
        value = (value ^ ord(c)) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return (value >> 20) % 63


def score_column(model: Model, text: str | Column = "text") -> Column:
    """Probability that a text is toxic; null and empty texts get the curve's value for no token, an empty table no rows."""
    shared = model

    # Arrow, not pandas: of a batch only the texts at hand become strings.
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scorer = _scorer(shared)
        out = []
        for start in range(0, len(texts), 256):
            out.append(scorer.probability(scorer(texts.slice(start, 256).to_pylist())[0]))
        trim()
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def spans(docs: DataFrame, model: Model, floor: float = 0.5) -> DataFrame:
    """``doc_id, score, spans``: maximal runs of tokens whose toxic marginal is at least ``floor``.

    A span has ``start`` and ``end`` in code points (end exclusive) and the highest marginal in it.  Null and empty texts have the
    curve's score for no token and no span; rows that repeat repeat, an empty table gives no rows.
    """

    def run(part: dict[str, list]) -> dict[str, list]:
        scorer = _scorer(model)
        texts = [t or "" for t in part["text"]]
        expected, marginals = scorer(texts)
        found = []
        for text, m in zip(texts, marginals):
            own: list[dict] = []
            if m is not None and (m >= floor).any():
                last = -2
                # Words of a chunk as for scoring, so that token numbers agree.
                for n, word in enumerate(w for c in re.finditer(r"\S+", text) for w in _words_in(c)):
                    if m[n] >= floor:
                        if last == n - 1:
                            own[-1]["end"] = word[1]
                            own[-1]["p"] = max(own[-1]["p"], float(m[n]))
                        else:
                            own.append({"start": word[0], "end": word[1], "p": float(m[n])})
                        last = n
            found.append(own)
        return {"doc_id": part["doc_id"], "score": scorer.probability(expected).tolist(), "spans": found}

    return map_rows(docs.select("doc_id", "text"), run, "doc_id bigint, score double, spans array<struct<start:int,end:int,p:double>>")


def _words_in(chunk: re.Match):
    """Start and end of each word of a chunk."""
    text, at = chunk.group(), chunk.start()
    if len(text.lower()) == len(text):
        for w in WORD.finditer(text.lower()):
            yield at + w.start(), at + w.end()
    else:  # a letter whose lower case has two code points: the whole chunk stands for each of its words
        for _ in WORD.finditer(text.lower()):
            yield at, chunk.end()


def _scorer(model: Model) -> Scorer:
    """The worker's scorer of the model at hand."""
    return kept(("scorer", model.own, model.curve, len(model.lexicon)), lambda: Scorer(model))
