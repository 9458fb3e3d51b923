"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols are the leaves' left ends: leaf ``i`` holds the rank of the pair that starts at symbol ``i`` with the
position as tie-breaker, inner nodes hold minima.  The root is therefore the leftmost lowest-rank merge; a merge changes
three leaves and their paths, and the word is done when the root holds no rank.  Short words are worked in batches, all
words of one tree size by the same numpy steps; a long word has a tree of its own, so its cost stays n log n.

Texts are cut at white space, which no token crosses, and each distinct chunk is encoded once per worker while it stays in
a bounded cache.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import kept, map_rows, sha256

NONE = np.int64(1) << np.int64(40)
SHORT = 64  # symbols; longer words have a tree of their own
CELLS = 1 << 18  # symbols of words worked side by side
CACHED = 60_000_000  # bytes of chunks a worker keeps
# Python takes four control characters for white space that the pattern below does not.
CONTROLS = re.compile("[\x1c-\x1f]")
SPACES = re.compile(r"[^\S\x1c-\x1f]+")
# Fixed values of the tokenizer: its word pattern.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
WORDS_OR_BREAK = regex.compile(r"\n|" + WORDS.pattern)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class PairTable:
    """Rank of a pair of token ids, by open addressing over numpy arrays."""

    BITS = 20

    def __init__(self, left: np.ndarray, right: np.ndarray):
        keys = left.astype(np.uint64) << np.uint64(20) | right.astype(np.uint64)
        self.mask = (1 << self.BITS) - 1
        self.keys = np.full(1 << self.BITS, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.BITS, NONE)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            while self.keys[slot] != np.uint64(2**64 - 1) and self.keys[slot] != np.uint64(key):
                slot = slot + 1 & self.mask
            if self.ranks[slot] == NONE:  # a merge listed twice keeps its first rank
                self.keys[slot], self.ranks[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(20) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        again = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while again.size:
            slot[again] = slot[again] + 1 & self.mask
            found = self.keys[slot[again]]
            hit = found == keys[again]
            out[again[hit]] = self.ranks[slot[again[hit]]]
            again = again[~hit & (found != np.uint64(2**64 - 1))]
        return out


class WordBpe:
    """Byte-level BPE with a word-end suffix, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.ranks = PairTable(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    # ---- one batch of words

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[flat]
        filled = sizes > 0
        symbols[ends[filled] - 1] = self.final[flat[ends[filled] - 1]]
        starts = ends - sizes
        alive = np.ones(flat.size, bool)
        size = 2
        while size <= SHORT:
            low = 1 if size == 2 else size // 2
            chosen = np.flatnonzero((sizes > low) & (sizes <= size))
            step = CELLS // size
            for a in range(0, chosen.size, step):
                some = chosen[a : a + step]
                self._merge_batch(symbols, alive, starts[some], sizes[some], size)
            size *= 2
        for w in np.flatnonzero(sizes > SHORT).tolist():
            self._merge_long(symbols, alive, int(starts[w]), int(sizes[w]))
        counts = np.add.reduceat(np.append(alive, False).astype(np.int64), np.minimum(starts, flat.size)) if len(words) else np.zeros(0, np.int64)
        counts[~filled] = 0
        return symbols[alive], counts

    def _merge_batch(self, symbols: np.ndarray, alive: np.ndarray, starts: np.ndarray, sizes: np.ndarray, size: int) -> None:
        """Merge words of at most ``size`` symbols, one merge of every unfinished word per round."""
        n = starts.size
        column = np.arange(size)
        inside = column < sizes[:, None]
        token = np.zeros((n, size), np.int64)
        token[inside] = symbols[(starts[:, None] + column)[inside]]
        after = np.where(column + 1 < sizes[:, None], column + 1, -1)
        before = np.broadcast_to(column - 1, (n, size)).copy()
        kept = inside.copy()
        tree = np.full((n, 2 * size), NONE)
        paired = np.flatnonzero(after >= 0)
        flat = token.ravel()
        tree[paired // size, size + paired % size] = self._leaf(flat[paired], flat[paired + 1], paired % size, size)
        for node in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while rows.size:
            root = tree[rows, 1]
            at, rank = root % size, root // size
            right = after[rows, at]
            token[rows, at] = self.merged[rank]
            kept[rows, right] = False
            follow = after[rows, right]
            after[rows, at] = follow
            tied = follow >= 0
            before[rows[tied], follow[tied]] = at[tied]
            tree[rows, size + right] = NONE
            tree[rows, size + at] = NONE
            r, a = rows[tied], at[tied]
            tree[r, size + a] = self._leaf(token[r, a], token[r, follow[tied]], a, size)
            left = before[rows, at]
            has = left >= 0
            r, p = rows[has], left[has]
            tree[r, size + p] = self._leaf(token[r, p], token[r, at[has]], p, size)
            every = np.concatenate((rows, rows, r))
            node = np.concatenate((right, at, p)) + size
            while size > 1 and node.size and node[0] > 1:
                node = node >> 1
                tree[every, node] = np.minimum(tree[every, 2 * node], tree[every, 2 * node + 1])
            rows = rows[tree[rows, 1] < NONE]
        target = (starts[:, None] + column)[inside]
        symbols[target] = token[inside]
        alive[target] = kept[inside]

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        rank = self.ranks(left, right)
        return np.where(rank < NONE, rank * size + at, NONE)

    def _merge_long(self, symbols: np.ndarray, alive: np.ndarray, start: int, count: int) -> None:
        """One tree for one word of any length."""
        size = 1 << (count - 1).bit_length()
        none = int(NONE) << 20
        token = symbols[start : start + count].tolist()
        leaves = self.ranks(symbols[start : start + count - 1], symbols[start + 1 : start + count])
        tree = [none] * (2 * size)
        for i, rank in enumerate(leaves.tolist()):
            if rank < NONE:
                tree[size + i] = rank * size + i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = [*range(1, count), -1], [*range(-1, count - 1)]
        rank_of = functools.cache(lambda a, b: int(self.ranks(np.array([a]), np.array([b]))[0]))

        def put(leaf: int, value: int) -> None:
            node = size + leaf
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def pair(leaf: int) -> int:
            rank = rank_of(token[leaf], token[after[leaf]])
            return rank * size + leaf if rank < NONE else none

        while tree[1] < none:
            rank, at = divmod(tree[1], size)
            right = after[at]
            token[at] = int(self.merged[rank])
            alive[start + right] = False
            after[at] = after[right]
            put(right, none)
            if after[at] >= 0:
                before[after[at]] = at
            put(at, pair(at) if after[at] >= 0 else none)
            if before[at] >= 0:
                put(before[at], pair(before[at]))
        symbols[start : start + count] = token

    # ---- chunks and texts

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian unsigned 32-bit integers; a chunk holds no white space."""
        if not chunks:
            return []
        if self.special_pattern is not None and any("<|" in c for c in chunks):
            return [self._with_special(c) for c in chunks]
        return self._plain_chunks(chunks)

    def _plain_chunks(self, chunks: list[str]) -> list[bytes]:
        found = WORDS_OR_BREAK.findall(normal("\n".join([*chunks, ""])))
        order = dict(zip(dict.fromkeys(found), range(len(found))))
        words = np.fromiter(map(order.__getitem__, found), np.int64, len(found))
        breaks = order.pop("\n")
        ids, counts = self.encode_words(list(order))
        counts = np.insert(counts, breaks, 0)
        starts = np.cumsum(counts) - counts
        taken = counts[words]
        begins = np.repeat(starts[words] - (np.cumsum(taken) - taken), taken)
        data = ids[begins + np.arange(begins.size)].astype("<u4").tobytes()
        upto = (np.cumsum(taken)[words == breaks] * 4).tolist()
        return [data[a:b] for a, b in zip([0, *upto], upto)]

    def _with_special(self, chunk: str) -> bytes:
        parts = [p for p in self.special_pattern.split(chunk) if p]
        return b"".join(
            self.special[p].to_bytes(4, "little") if p in self.special else self._plain_chunks([p])[0] for p in parts
        )

    def encode_text(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join(self.encode_chunks(chunks_of(text))), "<u4").tolist()

    def decode_tokens(self, ids: Iterable[int]) -> str:
        """Tokens side by side with blanks between, as a tokenizer without a decoder gives them."""
        return " ".join([self.token[i] for i in ids])


def normal(text: str) -> str:
    """Canonical composition and lower case letter by letter (a final sigma has no form of its own here)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def chunks_of(text: str | None) -> list[str]:
    if not text:
        return []
    if CONTROLS.search(text):
        return [c for c in SPACES.split(text) if c]
    return text.split()


class Cache:
    """Values of chunks in two generations: those used since the last change, and those used between the two before.

    Generations change when the younger one takes half of ``limit`` bytes; what the next does not use again goes with it.
    """

    ENTRY = 170  # bytes of an entry beside its letters and its value

    def __init__(self, make: Callable[[list[str]], list], limit: int = CACHED, weight: Callable[[list], int] | None = None):
        self.make, self.limit, self.young, self.old, self.bytes = make, limit, {}, {}, 0
        self.weight = weight or (lambda values: sum(map(len, values)))

    def prepare(self, texts: list[list[str]]) -> dict:
        if self.bytes > self.limit // 2:
            self.old, self.young, self.bytes = self.young, {}, 0
        young, old = self.young, self.old
        fresh = set().union(*texts).difference(young)
        missing = list(fresh.difference(old))
        again = list(fresh.difference(missing))
        values = list(map(old.__getitem__, again)) + (self.make(missing) if missing else [])
        chunks = again + missing
        young.update(zip(chunks, values))
        self.bytes += self.ENTRY * len(chunks) + sum(map(len, chunks)) + self.weight(values)
        return young


def word_bpe(path: str) -> WordBpe:
    return kept(("bpe", path), lambda: WordBpe(path))


def _digests(path: str) -> Cache:
    return kept(("digests", path), lambda: _digest_cache(WordBpe(path)))


def _digest_cache(model: WordBpe) -> Cache:
    shown = {i: t.encode() for i, t in model.token.items()}
    decimal = {i: str(i).encode() for i in model.token}

    def make(chunks: list[str]) -> list:
        out = []
        for data in model.encode_chunks(chunks):
            ids = memoryview(data).cast("I").tolist()
            out.append((len(ids), b" ".join([decimal[i] for i in ids]), b" ".join([shown[i] for i in ids])))
        return out

    return Cache(make, weight=lambda values: sum(150 + len(v[1]) + len(v[2]) for v in values))


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids and decoded text of every document.

    Returns ``doc_id, ids array<int>, decoded string``, one row per input row in any order.  A null text is an empty one
    and has no ids and an empty decoding; repeated rows are encoded each; other columns of ``docs`` are ignored.
    """

    def run(part: dict[str, list]) -> dict[str, list]:
        model = word_bpe(path)
        ids, decoded = [], []
        for value in part[text]:
            own = model.encode_text(value)
            ids.append(own)
            decoded.append(model.decode_tokens(own))
        return {"doc_id": part[doc_id], "ids": ids, "decoded": decoded}

    return map_rows(docs.select(doc_id, text), run, "doc_id bigint, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens, and SHA-256 of the decimal ids joined by blanks and of the decoded text.

    The same encoding and decoding as ``encode``, joined per document from the digests' inputs of its chunks, so that ids
    of repeated chunks are not built again.
    """

    def run(part: dict[str, list]) -> dict[str, list]:
        cut = [chunks_of(t) for t in part["text"]]
        found = _digests(path).prepare(cut)
        n, ids, decoded = [], [], []
        for chunks in cut:
            values = [v for v in map(found.__getitem__, chunks) if v[0]]
            n.append(sum(v[0] for v in values))
            ids.append(sha256(b" ".join([v[1] for v in values])))
            decoded.append(sha256(b" ".join([v[2] for v in values])))
        return {"doc_id": part["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs.select("doc_id", "text"), run, schema, rows=1024)
