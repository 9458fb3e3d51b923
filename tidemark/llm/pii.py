"""Personal data by weak supervision.

Candidate spans come from exact patterns (the base kinds) and from wider ones (a domain spelled out, a number without its
plus sign, a salutation before a name).  Three kinds of labelers vote on each candidate, for, against or not at all: patterns
(shape, checksum), gazetteers (top-level domains, dialling prefixes, reserved address blocks) and contexts (words and marks
around).  Expectation-maximisation over the votes of all documents estimates how reliable each labeler is; a logistic
classifier of the votes and of the span's shape is then trained on the resulting probabilities and decides each wider span.
Spans of the base kinds are always reported.

Documents are read once.  The model sees only counts of vote patterns, at most kinds x 3^labelers x shapes of them, however
many documents there are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, release, stage

BASE = ("email", "ip", "card", "phone")
WIDER = ("email_spelled", "phone_bare", "name")
KINDS = BASE + WIDER
PATTERNS = 20_000  # vote patterns kept apart in the model, at most
THRESHOLD = 0.5

# The patterns of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A failing start fails for the rest of its run of digits too, so a match begins where a run begins.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{1,63})+", re.I)
BARE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
SALUTED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Madame|Monsieur|Señor|Señora)\.? [A-ZÀ-Þ][^\W\d_]{1,30}(?: [A-ZÀ-Þ][^\W\d_]{1,30})?")

# Gazetteers and cue words; fixed values.
DOMAIN_ENDS = frozenset("com org net edu gov io co de fr es uk it nl eu info biz example test".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
CUES = {
    "email": ("mail", "contact", "write", "e-mail", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "anruf", "móvil"),
    "name": ("name", "dear", "contact", "regards", "liebe", "cher"),
}
# A cue begins a word; one of two letters is the word.
CUE = {family: re.compile("|".join(rf"(?<!\w){c}" + (r"(?!\w)" if len(c) < 3 else "") for c in cues)) for family, cues in CUES.items()}
LABELERS = ("shape", "gazetteer", "context", "surroundings")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, by their at signs: linear in the text."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)  # no start before this sign can match any more
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base kinds in code points, by start, then kind as listed."""
    found = [(a, b, 0) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    found.append((m.start(), m.end(), 1))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdecimal() for c in m.group()) <= 15:
                    found.append((m.start(), m.end(), 3))
    found.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, BASE[k]) for a, b, k in found]


def wider_spans(text: str) -> list[tuple[int, int, str]]:
    lowered = text.lower()
    found: list[tuple[int, int, str]] = []
    if "at]" in lowered or "at)" in lowered or "at ]" in lowered or "at )" in lowered:
        found += [(m.start(), m.end(), "email_spelled") for m in SPELLED.finditer(text)]
    if DIGIT.search(text):
        found += [(m.start(), m.end(), "phone_bare") for m in BARE.finditer(text)]
    return found + [(m.start(), m.end(), "name") for m in SALUTED.finditer(text)]


def all_spans(text: str) -> list[tuple[int, int, str]]:
    """Base spans, and the wider ones that overlap none of them."""
    base = base_spans(text)
    starts, ends = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
    wider = []
    for a, b, kind in wider_spans(text):
        before = bisect_left(starts, b)  # base spans that start before its end
        if not before or ends[before - 1] <= a:
            wider.append((a, b, kind))
    return base + wider


def votes(text: str, start: int, end: int, kind: str) -> tuple[int, int]:
    """Votes of the labelers in base 3 (0 none, 1 against, 2 for), and a number for the span's shape."""
    own = text[start:end]
    family = kind.split("_")[0]
    digits = "".join(c for c in own if c.isdecimal())
    if family == "email":
        end_word = re.split(r"[^A-Za-z0-9]+", own)[-1].lower()
        shape, gazetteer = 2 if end_word.isalpha() and len(end_word) >= 2 else 1, 2 if end_word in DOMAIN_ENDS else 0
    elif family == "ip":
        parts = own.split(".")
        first = int(parts[0].lstrip("0")[:4] or "0")  # zeros in front may be many
        shape, gazetteer = 1 if any(len(p) > 1 and p[0] == "0" for p in parts) else 2, 1 if first in (0, 127) or first >= 224 else 2
    elif family == "card":
        shape, gazetteer = 2 if len(digits) in (15, 16) and len(set(digits)) > 2 else 1, 2 if digits.startswith(CARD_STARTS) else 0
    elif family == "phone":
        shape = 2 if own.count("(") == own.count(")") and len(set(digits)) > 2 else 1
        gazetteer = 2 if kind == "phone_bare" or digits.startswith(CALLING) else 0
    else:
        shape, gazetteer = 2 if own.count(" ") <= 2 else 1, 0
    near = text[max(0, start - 40) : start].lower()
    context = 2 if CUE[family].search(near) else 0
    before, after = text[start - 1 : start], text[end : end + 1]
    surroundings = 1 if before in "/=#_-" and before or after and (after.isalnum() or after in "/=_") else 2
    code = 0
    for vote in (shape, gazetteer, context, surroundings):
        code = 3 * code + vote
    return code, min(7, len(own) // 6)


@dataclass(frozen=True)
class Model:
    """Labelers' reliabilities by kind, and the classifier's weights."""

    prior: dict[str, float]
    reliability: dict[str, tuple]  # kind -> per labeler (P(for | personal), P(against | personal), same if not)
    weights: tuple[float, ...]


def unpack(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        code, vote = divmod(code, 3)
        out.append(vote)
    return out[::-1]


def features(kind: str, code: int, shape: int) -> np.ndarray:
    out = np.zeros(len(KINDS) + 2 * len(LABELERS) + 8)
    out[KINDS.index(kind)] = 1
    for n, vote in enumerate(unpack(code)):
        if vote:
            out[len(KINDS) + 2 * n + vote - 1] = 1
    out[len(KINDS) + 2 * len(LABELERS) + shape] = 1
    return out


def train(counts: list[tuple[str, int, int, int]], rounds: int = 30) -> Model:
    """Reliabilities by expectation-maximisation from ``(kind, votes, shape, count)``, then the classifier.

    The base kinds anchor the truth: their patterns are exact, so they start, as the prior, from likely personal.
    """
    prior, reliability, targets = {}, {}, []
    for kind in KINDS:
        own = [(unpack(c), s, n, c) for k, c, s, n in counts if k == kind]
        share = 0.9 if kind in BASE else 0.5
        given = np.tile(np.array([[[0.3, 0.1, 0.6], [0.3, 0.6, 0.1]]]), (len(LABELERS), 1, 1))  # labeler, not/personal, vote
        if own:
            cast = np.array([v for v, _, _, _ in own])
            number = np.array([n for _, _, n, _ in own], float)
            given = np.stack([np.array([[0.4, 0.4, 0.2], [0.3, 0.1, 0.6]])] * len(LABELERS))
            for _ in range(rounds):
                score = np.log([1 - share, share]) + sum(np.log(given[n, :, cast[:, n]]) for n in range(len(LABELERS)))
                truth = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
                share = float(np.clip((truth @ number + 4 * (0.9 if kind in BASE else 0.5)) / (number.sum() + 4), 0.01, 0.99))
                for n in range(len(LABELERS)):
                    for vote in range(3):
                        hit = number * (cast[:, n] == vote)
                        given[n, 0, vote] = (hit @ (1 - truth) + (0.4, 0.4, 0.2)[vote] * 5) / (number @ (1 - truth) + 5)
                        given[n, 1, vote] = (hit @ truth + (0.3, 0.1, 0.6)[vote] * 5) / (number @ truth + 5)
            targets += [(features(kind, c, s), t, n) for (_, s, n, c), t in zip(own, truth)]
        prior[kind] = share
        reliability[kind] = tuple(map(tuple, given.reshape(len(LABELERS), -1).tolist()))
    size = len(KINDS) + 2 * len(LABELERS) + 8
    weights = np.zeros(size)
    if targets:
        x, y, n = np.array([t[0] for t in targets]), np.array([t[1] for t in targets]), np.array([t[2] for t in targets], float)
        n = n / n.sum() * min(n.sum(), 10_000)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            gradient = x.T @ (n * (y - p)) - 0.1 * weights
            hessian = (x.T * (n * np.maximum(p * (1 - p), 1e-6))) @ x + 0.1 * np.eye(size)
            weights = weights + np.clip(np.linalg.solve(hessian, gradient), -3, 3)
    return Model(prior, reliability, tuple(weights.tolist()))


def probability(model: Model, kind: str, code: int, shape: int) -> float:
    return float(1 / (1 + np.exp(-np.clip(features(kind, code, shape) @ np.array(model.weights), -30, 30))))


CANDIDATES = "array<struct<start:int,end:int,kind:string,votes:int,shape:int>>"


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, candidates``: base and wider spans with their votes; a null text has none."""

    def run(part: dict[str, list]) -> dict[str, list]:
        release()
        out = []
        for text in part["text"]:
            own: list[dict] = []
            if text:
                for start, end, kind in all_spans(text):
                    code, shape = votes(text, start, end, kind)
                    own.append({"start": start, "end": end, "kind": kind, "votes": code, "shape": shape})
            out.append(own)
        return {"doc_id": part["doc_id"], "candidates": out}

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), "text"), run, f"doc_id bigint, candidates {CANDIDATES}", rows=512)


def fit(found: DataFrame) -> Model:
    """Learn from all candidates of all documents; patterns beyond ``PATTERNS`` cannot occur."""
    counts = (
        found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.shape").groupBy("kind", "votes", "shape").count()
    )
    rows = counts.orderBy("kind", "votes", "shape").limit(PATTERNS).collect()
    return train([(r["kind"], r["votes"], r["shape"], r["count"]) for r in rows])


def decide(kind: str, code: int, shape: int, model: Model) -> bool:
    return kind in BASE or probability(model, kind, code, shape) >= THRESHOLD


def accepted(model: Model) -> dict[tuple[str, int, int], bool]:
    """The decision of every pattern of a wider kind."""
    every = [(k, c, s) for k in WIDER for c in range(3 ** len(LABELERS)) for s in range(8)]
    return {e: decide(*e, model) for e in every}


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: all reported spans of each row, by start, then kind as listed; code points, end exclusive.

    One row per input row; repeated rows repeat, a null or empty text has no spans.
    """
    found = stage(candidates(docs), "pii")
    yes = accepted(fit(found))

    def run(part: dict[str, list]) -> dict[str, list]:
        return {"doc_id": part["doc_id"], "spans": [chosen(c, yes) for c in part["candidates"]]}

    return map_rows(found, run, "doc_id bigint, spans array<struct<start:int,end:int,kind:string>>", rows=2048)


def chosen(own: list[dict], yes: dict) -> list[dict]:
    kept = [c for c in own if c["kind"] in BASE or yes[c["kind"], c["votes"], c["shape"]]]
    kept.sort(key=lambda c: (c["start"], KINDS.index(c["kind"])))
    return [{"start": c["start"], "end": c["end"], "kind": c["kind"]} for c in kept]


def shown(own: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in own)


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans as text."""

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": part["doc_id"], **{f"n_{k}": [] for k in BASE}, "base_sha256": [], "spans": []}
        for own in part["spans"]:
            base = [s for s in own if s["kind"] in BASE]
            for k in BASE:
                out[f"n_{k}"].append(sum(s["kind"] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(shown(base).encode()).hexdigest())
            out["spans"].append(shown(own))
        return out

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return map_rows(spans(docs), run, schema, rows=2048)


def masked(model_yes: dict, texts: list[str | None]) -> list[str | None]:
    """Texts with every reported span replaced by its kind in brackets; overlapping spans become one."""
    out: list[str | None] = []
    for text in texts:
        if not text:
            out.append(text)
            continue
        own = []
        for start, end, kind in all_spans(text):
            if kind in BASE or model_yes[(kind, *votes(text, start, end, kind))]:
                own.append((start, end, kind))
        own.sort(key=lambda s: (s[0], KINDS.index(s[2])))
        pieces, at = [], 0
        for start, end, kind in own:
            if start >= at:
                pieces += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        out.append("".join([*pieces, text[at:]]))
    return out


def masked_text(docs: DataFrame) -> Column:
    """The text of each row with every reported span masked; the model learns from all of ``docs`` first."""
    yes = accepted(fit(stage(candidates(docs), "pii")))

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series(masked(yes, texts.tolist()), dtype=object)

    return mask(F.col("text"))
