"""Removal of long repeated byte strings by sorting sampled suffixes.

Texts are compared as suffixes: a string of WIDTH bytes repeats if two suffixes agree in their first WIDTH bytes.  Suffixes
are sampled at anchors (see ``anchors``), so that equal strings meet at equal places.  A suffix's key is its leading bytes,
then digests of what follows.  Splitters from a sample of suffixes deal the keys into ranges, one bucket each; a bucket
sorts its keys by multikey quicksort and compares neighbours.  A key that spans several splitters is so frequent that its
bucket would be too large: it is dealt over the buckets between those splitters by its last word, so equal suffixes still
meet and no comparison is left to make across a boundary.

Most of a repeated passage is settled at the anchors, where the whole stretch that an anchor stands for repeats.  Only at
the edges of passages are all suffixes compared, in the same way.  Of suffixes that agree within the rows of one map call
one travels; the others are settled there, so a passage of a third of all texts does not fill a bucket.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import KEY, WIDTH, Digests, anchors
from tidemark.llm.common import map_rows, mix64, release, stage

SAMPLE = 1_000  # texts, about, whose suffixes give the splitters
BUCKET = 24_000_000  # bytes of text behind one bucket, about
ROWS = 256
CELLS = 1 << 18  # cells of row keys
SETTLED, OPEN = 1, 2
KEY_COLUMN, CELL_COLUMN, REMOVED = "__row_key", "__row_cell", "__removed"


def key_of_row(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Rows equal in id and text share a key, and what is removed from one is removed from the other."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts side by side, where each begins, and where it ends."""
    release()
    encoded = [(t or "").encode() for t in texts]
    ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
    return np.frombuffer(b"".join(encoded), np.uint8), ends - np.fromiter(map(len, encoded), np.int64, len(encoded)), ends


def first_word(raw: np.ndarray, at: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Three leading bytes of the suffixes at ``at`` in the high bits, 40 bits of digest below: sorts by leading bytes."""
    lead = raw[at].astype(np.uint64) << np.uint64(16) | raw[at + 1].astype(np.uint64) << np.uint64(8) | raw[at + 2].astype(np.uint64)
    return lead << np.uint64(40) | digest >> np.uint64(24)


def multikey_order(*words: np.ndarray) -> np.ndarray:
    """Order by several words: sort by the first, then only the runs that it leaves equal by the next."""
    order = np.argsort(words[0])
    run = np.cumsum(np.diff(words[0][order], prepend=words[0][:1]) != 0) if order.size else order
    for word in words[1:]:
        size = np.bincount(run)
        tied = np.flatnonzero(size[run] > 1)
        inner = tied[np.lexsort((word[order[tied]], run[tied]))]
        order[tied] = order[inner]
        value = word[order]
        run = np.cumsum(np.concatenate([[0], (run[1:] != run[:-1]) | (value[1:] != value[:-1])])) if order.size else run
    return order


def runs(*words: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted words."""
    new = np.zeros(words[0].size, bool)
    new[:1] = True
    for w in words:
        new[1:] |= w[1:] != w[:-1]
    return new


def bucket_of(splitters: np.ndarray, word: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key, and whether its first word spans several buckets."""
    low, high = np.searchsorted(splitters, word, "left"), np.searchsorted(splitters, word, "right")
    wide = high - low > 1
    return low + np.where(wide, (mix64(last.astype(np.uint64)) % (high - low + 1).astype(np.uint64)).astype(np.int64), 0), wide


def blobs(bucket: np.ndarray, owner: np.ndarray, keys: np.ndarray, columns: dict[str, np.ndarray]) -> dict[str, list]:
    """One row per bucket: each column's values as bytes, and the row keys that the owner numbers point to."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    columns = {n: c[order] for n, c in columns.items()}
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    out: dict[str, list] = {"bucket": bucket[starts].tolist(), "keys": [], "owner": [], **{n: [] for n in columns}}
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), bucket.size]):
        used, local = np.unique(owner[a:b], return_inverse=True)
        out["keys"].append(keys[used].tobytes())
        out["owner"].append(local.astype(np.uint16).tobytes())
        for n, c in columns.items():
            out[n].append(c[a:b].tobytes())
    return out


def unblob(table: pa.Table, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    out = {n: np.concatenate([np.frombuffer(v, k) for v in table.column(n).to_pylist()]) for n, k in kinds.items()}
    parts = zip(table.column("keys").to_pylist(), table.column("owner").to_pylist())
    out["key"] = np.concatenate([np.frombuffer(k, np.int64)[np.frombuffer(o, np.uint16)] for k, o in parts])
    return out


def suffixes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """Anchors with their owner, window starts and key words: leading bytes and KEY bytes, then all an anchor can stand for."""
    at, first, last = anchors(raw, ends)
    owner = np.searchsorted(ends, at, side="right")
    digest = Digests(raw)
    low, high = np.maximum(begins[owner], at - (WIDTH - KEY)), np.minimum(ends[owner], at + WIDTH)
    around = mix64(digest(low, high) ^ (at - low).astype(np.uint64)) if at.size else np.zeros(0, np.uint64)
    word = first_word(raw, at, digest(at, at + KEY)) if at.size else np.zeros(0, np.uint64)
    return at, first, last, owner, word, around


def splitters(docs: DataFrame, rows: int, buckets: int) -> np.ndarray:
    """Quantiles of the first words of about SAMPLE texts' sampled suffixes; fewer than ``buckets`` of them."""
    chosen = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < math.ceil(min(1.0, SAMPLE / max(rows, 1)) * (1 << 20)))

    def run(part: dict[str, list]) -> dict[str, list]:
        word = suffixes(*joined(part["text"]))[4]
        return {"word": [np.sort(word)[:: max(1, word.size // 2000)].tobytes()]}

    # One evenly spaced excerpt of 2,000 words or so for every ROWS texts of the sample.
    words = [np.frombuffer(r["word"], np.uint64) for r in map_rows(chosen.select("text"), run, "word binary", rows=ROWS).toLocalIterator()]
    every = np.sort(np.concatenate([*words, np.zeros(0, np.uint64)]))
    return every[(np.arange(1, buckets) * every.size) // buckets] if every.size else every


def anchor_states(docs: DataFrame, cuts: np.ndarray, buckets: int) -> DataFrame:
    """``key, first, last, state`` of every sampled suffix whose KEY bytes repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(cuts)

    def emit(part: dict[str, list]) -> dict[str, list] | None:
        at, first, last, owner, word, around = suffixes(*(j := joined(part["text"])))
        if not at.size:
            return None
        begin = j[1][owner]
        order = multikey_order(word, around)
        new = runs(word[order], around[order])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        flag = np.zeros(at.size, np.uint8)
        flag[order] = np.where(several, np.where(new, 1, 2), 0)  # 1: repeats here already; 2: settled here
        bucket, wide = bucket_of(shared.value, word, around)
        flag += (wide * 4).astype(np.uint8)
        keys = np.array(part["key"], np.int64)
        bucket = np.where(flag & 2, (mix64(at.astype(np.uint64) + keys[owner].view(np.uint64)) % np.uint64(buckets)).astype(np.int64), bucket)
        columns = {
            "word": word,
            "around": around,
            "at": (at - begin).astype(np.uint32),
            "back": (at - first).astype(np.uint8),
            "near": (at - last).astype(np.uint8),
            "flag": flag,
        }
        return blobs(bucket, owner, keys, columns)

    kinds = {"word": np.uint64, "around": np.uint64, "at": np.uint32, "back": np.uint8, "near": np.uint8, "flag": np.uint8}

    def meet(table: pa.Table) -> pa.Table:
        c = unblob(table, kinds)
        state = np.zeros(c["word"].size, np.int8)
        state[(c["flag"] & 2) > 0] = SETTLED
        left = np.flatnonzero((c["flag"] & 2) == 0)
        left = left[multikey_order(c["word"][left], c["around"][left])]
        word, around, flag = c["word"][left], c["around"][left], c["flag"][left]
        new_word, new = runs(word), runs(word, around)
        g, n = np.cumsum(new_word) - 1, np.cumsum(new) - 1
        weight = np.bincount(g, 1 + (flag & 1))[g] if g.size else g
        full = np.bincount(n, 1 + (flag & 1))[n] > 1 if n.size else np.zeros(0, bool)
        # A wide word's other surroundings may be in other buckets.
        kinds_of = np.bincount(g, new)[g] + (flag >> 2 & 1) if g.size else g
        some = (weight > 1) | (flag & 4 > 0)
        state[left] = np.where(some, np.where(full, SETTLED, 0) | np.where(~full | (new & (kinds_of > 1)), OPEN, 0), 0)
        rows = np.flatnonzero(state)
        at = c["at"][rows].astype(np.int64)
        return pa.table({"key": c["key"][rows], "first": at - c["back"][rows], "last": at - c["near"][rows], "state": state[rows].astype(np.int32)})

    names = ", ".join(f"{n} binary" for n in ("keys", "owner", *kinds))
    sent = map_rows(docs.select("key", "text"), emit, f"bucket bigint, {names}", rows=ROWS)
    return sent.groupBy("bucket").applyInArrow(meet, "key bigint, first bigint, last bigint, state int")


def open_windows(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``key, starts``: starts of repeated windows among those of open anchors, as bytes; ``rows`` has ``key, text, open``."""
    homes = cuts.size + 1
    shared = rows.sparkSession.sparkContext.broadcast(cuts)
    kinds = {"word": np.uint64, "more": np.uint32, "at": np.uint32, "flag": np.uint8}

    def emit(part: dict[str, list]) -> dict[str, list] | None:
        raw, begins, _ = joined(part["text"])
        size = [[s["last"] - s["first"] + 1 for s in own] for own in part["open"]]
        first = np.array([b + s["first"] for b, own in zip(begins.tolist(), part["open"]) for s in own], np.int64)
        sizes = np.array([n for own in size for n in own], np.int64)
        owner = np.repeat(np.repeat(np.arange(len(size)), [len(s) for s in size]), sizes)
        if not owner.size:
            return None
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(owner.size)
        digest = Digests(raw)(at, at + WIDTH)
        word, more = first_word(raw, at, digest), (mix64(digest + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
        more ^= (digest & np.uint64(0xFFFFFF)).astype(np.uint32)
        order = multikey_order(word, more)
        new = runs(word[order], more[order])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        flag = np.zeros(at.size, np.uint8)
        flag[order] = np.where(several, np.where(new, 1, 2), 0)
        keys = np.array(part["key"], np.int64)
        bucket, _ = bucket_of(shared.value, word, more)
        spread = (mix64(at.astype(np.uint64) + keys[owner].view(np.uint64)) % np.uint64(shared.value.size + 1)).astype(np.int64)
        bucket = np.where(flag & 2, spread, bucket)
        return blobs(bucket, owner, keys, {"word": word, "more": more, "at": (at - begins[owner]).astype(np.uint32), "flag": flag})

    def meet(table: pa.Table) -> pa.Table:
        c = unblob(table, kinds)
        repeated = (c["flag"] & 2) > 0
        left = np.flatnonzero(~repeated)
        left = left[multikey_order(c["word"][left], c["more"][left])]
        n = np.cumsum(runs(c["word"][left], c["more"][left])) - 1
        if n.size:
            repeated[left] = np.bincount(n, 1 + (c["flag"][left] & 1))[n] > 1
        rows = np.flatnonzero(repeated)
        home = c["key"][rows] % homes
        order = np.argsort(home, kind="stable")
        home, key, at = home[order], c["key"][rows][order], c["at"][rows][order]
        starts = np.flatnonzero(runs(home))
        ends = [*starts[1:].tolist(), home.size]
        cut = [(key[x:y].tobytes(), at[x:y].tobytes()) for x, y in zip(starts.tolist(), ends)]
        return pa.table({"home": pa.array(home[starts], pa.int64()), "owner": pa.array([k for k, _ in cut], pa.binary()), "at": pa.array([t for _, t in cut], pa.binary())})

    def collect(table: pa.Table) -> pa.Table:
        key = np.concatenate([np.frombuffer(k, np.int64) for k in table.column("owner").to_pylist()])
        at = np.concatenate([np.frombuffer(k, np.uint32) for k in table.column("at").to_pylist()])
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        starts = np.flatnonzero(runs(key))
        pieces = [at[x:y].tobytes() for x, y in zip(starts.tolist(), [*starts[1:].tolist(), key.size])]
        return pa.table({"key": key[starts], "starts": pa.array(pieces, pa.binary())})

    names = ", ".join(f"{n} binary" for n in ("keys", "owner", *kinds))
    sent = map_rows(rows.select("key", "text", "open"), emit, f"bucket bigint, {names}", rows=ROWS)
    # One blob from each bucket to each group of rows, not one row for each text in each bucket.
    found = sent.groupBy("bucket").applyInArrow(meet, "home bigint, owner binary, at binary")
    return found.groupBy("home").applyInArrow(collect, "key bigint, starts binary")


def only_of(rows: DataFrame, keys: DataFrame, key: str, cell: str) -> tuple[DataFrame, DataFrame]:
    """Rows in a cell of a wanted key, and the others; the wanted cells are CELLS at most, so they are broadcast."""
    cells = keys.select(F.pmod(F.col(keys.columns[0]), F.lit(CELLS)).alias(cell)).distinct()
    rows = rows.withColumn(cell, F.pmod(F.col(key), F.lit(CELLS)))
    return rows.join(F.broadcast(cells), cell, "left_semi").drop(cell), rows.join(F.broadcast(cells), cell, "left_anti").drop(cell)


def removals(docs: DataFrame) -> DataFrame:
    """``key, removed``: maximal byte runs covered by repeated strings, of the rows that have any, in order."""
    spark = docs.sparkSession
    texts = docs.select(key_of_row().alias("key"), "text")
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((size["b"] or 0) / BUCKET))
    cuts = splitters(docs, size["n"], buckets)
    states = anchor_states(texts, cuts, buckets)
    span = F.struct("first", "last")
    of_row = stage(
        states.groupBy("key").agg(
            F.collect_set(F.when(F.col("state").bitwiseAND(SETTLED) > 0, span)).alias("settled"),
            F.collect_set(F.when(F.col("state").bitwiseAND(OPEN) > 0, span)).alias("open"),
        ),
        "spans",
    )
    unsettled = of_row.where(F.size("open") > 0).select("key", "open")
    near, _ = only_of(texts, unsettled, "key", CELL_COLUMN)
    windows = open_windows(near.join(unsettled, "key"), cuts)
    every = of_row.select("key", "settled").join(windows, "key", "left")

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"key": [], "removed": []}
        for key, settled, starts in zip(part["key"], part["settled"], part["starts"]):
            first = np.array([s["first"] for s in settled], np.int64)
            end = np.array([s["last"] for s in settled], np.int64) + WIDTH
            single = np.frombuffer(starts or b"", np.uint32).astype(np.int64)
            first, end = np.concatenate([first, single]), np.concatenate([end, single + WIDTH])
            if not first.size:
                continue
            order = np.argsort(first)
            first, reach = first[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], first[1:] > reach[:-1]])
            begin, upto = first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, first.size - 1)]
            out["key"].append(key)
            out["removed"].append([{"start": a, "end": b} for a, b in zip(begin.tolist(), upto.tolist())])
        return out

    return stage(map_rows(every, run, "key bigint, removed array<struct<start:bigint,end:bigint>>", rows=ROWS), "removals")


def with_removals(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with column REMOVED: the runs to remove, null where nothing repeats."""
    found = removals(docs).select(F.col("key").alias(KEY_COLUMN), F.col("removed").alias(REMOVED))
    near, far = only_of(docs.withColumn(KEY_COLUMN, key_of_row()), found, KEY_COLUMN, CELL_COLUMN)
    near = near.join(found, KEY_COLUMN, "left")
    far = far.withColumn(REMOVED, F.lit(None).cast(found.schema[REMOVED].dataType))
    return near.unionByName(far).drop(KEY_COLUMN)


def kept_bytes(text: str | None, removed) -> bytes:
    data = (text or "").encode()
    if removed is None or not len(removed):
        return data
    at = [0, *(v for s in removed for v in (s["start"], s["end"])), len(data)]
    return b"".join(data[a:b] for a, b in zip(at[0::2], at[1::2]))


def digest(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes and runs of each row, and SHA-256 of what is kept.

    One row per input row.  A null text is an empty one; texts shorter than WIDTH bytes lose nothing; rows that repeat are
    documents of their own, so both lose all strings of WIDTH bytes; an empty table gives no rows.
    """

    def run(part: dict[str, list]) -> dict[str, list]:
        kept = [kept_bytes(t, r) for t, r in zip(part["text"], part[REMOVED])]
        total = [len((t or "").encode()) for t in part["text"]]
        return {
            "doc_id": part["doc_id"],
            "n_bytes": total,
            "n_removed": [n - len(k) for n, k in zip(total, kept)],
            "n_spans": [len(r or []) for r in part[REMOVED]],
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
        }

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return map_rows(with_removals(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")), run, schema)


def kept_text(text: Column, removed: Column) -> Column:
    """What is left of a text; bytes of letters that a cut leaves incomplete go too."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else kept_bytes(t, r).decode(errors="ignore") for t, r in zip(texts, spans)], dtype=object)

    return F.when(removed.isNull(), text).otherwise(cut(text, removed))
