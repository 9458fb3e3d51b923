"""Periodic runs of words: stretches in which a passage repeats back to back.

A run is a stretch with smallest period ``q`` (words ``q`` apart are identical) of at least ``max(LEAST, REPEATS * q)`` words
that neither neighbour extends.  It is found by recursive frequency splitting.  Every word of a run occurs at least REPEATS
times in it, so a word that is rarer in its segment is in no run there and splits the segment; what is left is split again
until nothing changes, for all texts of a slice at once.  The surviving segments are scanned lag by lag.

The lag scan looks at multiples of the lag only: a run of period ``q`` holds 3q neighbouring places whose word returns ``q``
words later, and three multiples of ``q`` in a row are among them.  So a segment of n words costs about n log n comparisons
instead of n squared.  Places that pass are compared in full and extended to both sides.  A run of period ``q`` shows again at
the lags 2q, 3q, ...; there it has the same ends and is skipped.

Words are what lies between space and the characters 9 to 13.  A null text has no words; a text without runs keeps all its
words; each of several equal rows is looked at for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, sha256

LEAST, REPEATS = 6, 4
# What still splits after so many rounds is scanned as it stands: splitting saves work, it decides nothing.
STEADY = 64
CELLS = 1 << 20  # places looked at in one go, so that a long text needs little memory

Run = tuple[int, int, int]  # start, length, period
Change = Callable[[object, list[bytes]], list[bytes]]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def split(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Segments of the given ones that can hold a run: each of their words occurs REPEATS times in them."""
    kinds = int(codes.max()) + 1 if codes.size else 1
    settled = []
    for _ in range(STEADY):
        long = ends - starts >= LEAST
        starts, ends = starts[long], ends[long]
        if not starts.size:
            break
        sizes = ends - starts
        own = np.repeat(np.arange(starts.size), sizes)
        place = np.arange(own.size) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        _, which, number = np.unique(own * kinds + codes[place], return_inverse=True, return_counts=True)
        stays = number[which] >= REPEATS
        changed = np.bincount(own, ~stays) > 0
        settled += zip(starts[~changed].tolist(), ends[~changed].tolist())
        stays &= changed[own]
        own, place = own[stays], place[stays]
        # A piece begins where the word before it, in the same segment, did not stay.
        first = np.ones(own.size, bool)
        first[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1)
        last = np.ones(own.size, bool)
        last[:-1] = first[1:]
        starts, ends = place[first], place[last] + 1
    settled += [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a >= LEAST]
    return sorted(set(settled))


def _candidates(codes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Lags from ``low`` to ``high - 1`` and multiples of them where a run may be, by lag and place."""
    n = codes.size
    lags = np.arange(low, high)
    at = np.arange((n - 1) // low + 1)[:, None] * lags[None, :]
    inside = at < n
    words = np.where(inside, codes[np.minimum(at, n - 1)], -1)
    same = (words[:-1] == words[1:]) & inside[1:]
    hits = same[:-2] & same[1:-1] & same[2:]
    which, times = np.nonzero(hits.T)
    lag = lags[which]
    place = times * lag
    for part in (4, 9, 2, 13, 6, 11, 1, 15, 3, 5, 7, 10, 12, 14):  # more places of the two periods that follow
        look = place + part * lag // 8
        fits = codes[look] == codes[look + lag]
        lag, place = lag[fits], place[fits]
    return lag, place


def _extended(codes: np.ndarray, lag: int, place: int) -> tuple[int, int] | None:
    """The longest stretch around two periods at ``place`` that keeps the period, or None if they do not."""
    n = codes.size
    begin, end = place, place + 2 * lag + 1  # places whose word returns a lag later
    if not np.array_equal(codes[begin:end], codes[begin + lag : end + lag]):
        return None
    step = max(64, lag)
    while end < n - lag:
        to = min(n - lag, end + step)
        other = np.flatnonzero(codes[end:to] != codes[end + lag : to + lag])
        if other.size:
            end += int(other[0])
            break
        end, step = to, 2 * step
    step = max(64, lag)
    while begin > 0:
        to = max(0, begin - step)
        other = np.flatnonzero(codes[to:begin] != codes[to + lag : begin + lag])
        if other.size:
            begin = to + int(other[-1]) + 1
            break
        begin, step = to, 2 * step
    return begin, end + lag


def scan(codes: np.ndarray) -> list[Run]:
    """All runs of one segment."""
    n = codes.size
    found: dict[tuple[int, int], int] = {}
    low = 1
    while REPEATS * low <= n:
        # No lag of a round is a multiple of another.
        high = min(2 * low, n // REPEATS + 1, low + max(1, CELLS // (n // low + 1)))
        lag, place = _candidates(codes, low, high)
        for (begin, end), period in found.items():
            if lag.size and end - begin >= REPEATS * low:
                seen = (lag % period == 0) & (place >= begin) & (place + 3 * lag < end)
                lag, place = lag[~seen], place[~seen]
        last, reach = 0, 0
        for q, at in zip(lag.tolist(), place.tolist()):
            if q == last and at + 3 * q < reach:
                continue
            stretch = _extended(codes, q, at)
            if stretch is None:
                continue
            last, reach = q, stretch[1]
            if stretch not in found and stretch[1] - stretch[0] >= max(LEAST, REPEATS * q):
                found[stretch] = q
        low = high
    return [(begin, end - begin, q) for (begin, end), q in found.items()]


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each word list, by start, then period."""
    kinds: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in texts], np.int64)
    codes = np.fromiter((kinds.setdefault(w, len(kinds)) for words in texts for w in words), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out: list[list[Run]] = [[] for _ in texts]
    for begin, end in split(codes, starts, ends):
        text = int(np.searchsorted(ends, begin, side="right"))
        shift = begin - int(starts[text])
        out[text] += [(start + shift, length, q) for start, length, q in scan(codes[begin:end])]
    return [sorted(own, key=lambda run: (run[0], run[2])) for own in out]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words with a tail that repeats, in a tenth of the documents by hash of the id; no change where the id is null."""
    number = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or number % 10 or not n:
        return words
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _rows(docs: DataFrame, schema: str, make: Callable, change: Change | None) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(part: dict[str, list]) -> dict[str, list]:
        texts = [words_of(text) for text in part["text"]]
        if change is not None:
            texts = [change(doc_id, words) for doc_id, words in zip(part["doc_id"], texts)]
        return make(part["doc_id"], texts, runs_of(texts))

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {kind}, {schema}")


def runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """``doc_id, runs`` (start, length, period; counted in words) of each row, by start, then period."""

    def make(ids, texts, found):
        named = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in found]
        return {"doc_id": ids, "runs": named}

    return _rows(docs, "runs array<struct<start: long, length: long, period: long>>", make, change)


def collapsed_texts(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """``doc_id, text`` with the repeats of every run dropped and one space between words; null texts give empty ones."""

    def make(ids, texts, found):
        kept = [b" ".join(collapsed(words, own)).decode("utf-8", "surrogatepass") for words, own in zip(texts, found)]
        return {"doc_id": ids, "text": kept}

    return _rows(docs, "text string", make, change)


def digest(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """Per row the number of runs, the longest one (ties: smallest start, then period; nulls without a run), and digests of all
    runs and of the collapsed text.
    """

    def make(ids, texts, found):
        longest = [min(own, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None)) for own in found]
        lists = ["".join(f"{s},{n},{q}\n" for s, n, q in own).encode() for own in found]
        return {
            "doc_id": ids,
            "n_runs": [len(own) for own in found],
            "start": [r[0] for r in longest],
            "length": [r[1] for r in longest],
            "period": [r[2] for r in longest],
            "exponent_milli": [None if r[0] is None else 1000 * r[1] // r[2] for r in longest],
            "runs_sha256": [sha256(x) for x in lists],
            "collapsed_sha256": [sha256(b" ".join(collapsed(words, own))) for words, own in zip(texts, found)],
        }

    schema = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _rows(docs, schema, make, change)
