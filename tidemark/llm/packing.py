"""Vector best-fit packing of documents into training sequences.

A sequence has three capacities: tokens, number of pieces, and attention cost (the sum of squared piece lengths).  Pieces go
largest first; the sequence that takes a piece is, of all where it fits in every dimension, the one with the smallest norm
of what stays free (``norm``) or the largest weighted product of free capacity and demand (``dot``).

What a piece needs depends on its length alone, so choosing works on counts: pieces of one length are one class, sequences in
the same state one group, and a whole group takes pieces of a class at once.  The choice sees at most as many classes as
there are lengths, however many documents there are; it is made on the driver from those counts.  Spark cuts and counts the
pieces, numbers those of a class with per-partition offsets (no window over a class, which may hold most rows), and looks
each piece's place up in the plan, one short table per length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import kept, slices, stage


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence, and how the free capacities are weighed (as shares of their limits)."""

    tokens: int = 2048
    pieces: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"


def plan(counts: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces of each length.

    Returns runs ``(length, first rank, number of pieces, first sequence, offset)``: the ranks of a run go to consecutive
    sequences at the same offset.  Raises ValueError for a piece that no empty sequence can take.
    """
    limits = np.array([capacity.tokens, capacity.pieces, capacity.attention], float)
    weights = np.array(capacity.weights, float)
    free = np.zeros((64, 3))  # one row per group of sequences in the same state
    used_groups = np.zeros(64, bool)
    spans: list[list[tuple[int, int]]] = []  # runs of sequence numbers of each group
    runs, opened = [], 0
    index: dict[tuple[int, int, int], int] = {}

    def group(state: np.ndarray) -> int:
        nonlocal free, used_groups
        key = tuple(int(v) for v in state)
        if key not in index:
            index[key] = len(spans)
            if len(spans) == len(free):
                free, used_groups = np.vstack([free, free]), np.concatenate([used_groups, np.zeros(len(free), bool)])
            free[len(spans)] = state
            spans.append([])
        used_groups[index[key]] = True
        return index[key]

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        need = np.array([length, 1, length * length], float)
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds an empty sequence")
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero(used_groups)
            fits = fits[(free[fits] >= need).all(axis=1)]
            if fits.size:
                if capacity.rule == "dot":
                    score = -((free[fits] / limits) * (need / limits) * weights).sum(axis=1)
                else:
                    score = (weights * ((free[fits] - need) / limits) ** 2).sum(axis=1)
                g = int(fits[np.argmin(score)])
                state = free[g].copy()
                taken, spans[g], used_groups[g] = spans[g], [], False
            else:
                # As many new sequences as the class fills by itself.
                per = int(min(limits // need))
                state, fresh = limits, -(-left // per)
                taken = [(opened, fresh)]
                opened += fresh
            target = group(state - need)
            offset = int(limits[0] - state[0])
            for first, size in taken:
                used = min(size, left)
                if used:
                    runs.append((length, rank, used, first, offset))
                    spans[target].append((first, used))
                    rank, left = rank + used, left - used
                if size > used:
                    spans[group(state)].append((first + used, size - used))
    return runs


def _ids(path: str) -> bpe.Cache:
    return kept(("ids", path), lambda: bpe.Cache(bpe.WordBpe(path).encode_chunks))


def cut(docs: DataFrame, path: str, tokens: int = 2048) -> DataFrame:
    """Pieces of at most ``tokens`` ids: each document's ids and a closing id 0; only longer documents are cut.

    Returns ``doc_id, piece, start, length, ids_crc32, part, rank``: ``rank`` counts the pieces of one length within the task
    ``part``.  A null or empty text is the closing id alone.
    """
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank")

    def run(batches):
        part = TaskContext.get().partitionId()
        ranks: dict[int, int] = defaultdict(int)
        for rows in slices(batches, 256):
            texts = [bpe.chunks_of(t) for t in rows["text"]]
            found = _ids(path).prepare(texts)
            out: list[tuple] = []
            for doc, chunks in zip(rows["doc_id"], texts):
                data = b"".join([*map(found.__getitem__, chunks), b"\0\0\0\0"])
                for piece, start in enumerate(range(0, len(data) // 4, tokens)):
                    own = data[4 * start : 4 * (start + tokens)]
                    length = len(own) // 4
                    out.append((doc, piece, start, length, zlib.crc32(own), part, ranks[length]))
                    ranks[length] += 1
            columns = zip(*out)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: Capacity = Capacity()) -> DataFrame:
    """Assign every piece of every document to a sequence.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``; pieces of a sequence lie side by side from
    offset 0.  Rows that repeat are packed each.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = stage(cut(docs, path, capacity.tokens), "pieces")
    # Tasks times lengths at most: each task's ranks start where those of the tasks before it end.
    own = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = own.select(
        "length",
        "part",
        (F.expr("sum(n) OVER (PARTITION BY length ORDER BY part)") - F.col("n")).alias("before"),
    )
    counts = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length: dict[int, list] = defaultdict(list)
    for length, rank, size, first, offset in plan(counts, capacity):
        by_length[length].append((rank, size, first, offset))
    tables = {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in by_length.items()}
    places = spark.sparkContext.broadcast(tables)

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.empty(length.size, np.int64), np.empty(length.size, np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                ranks, _, firsts, offsets = places.value[n]
                run = np.searchsorted(ranks, rank[rows], side="right") - 1
                sequence[rows] = firsts[run] + rank[rows] - ranks[run]
                offset[rows] = offsets[run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return pieces.join(before, ["length", "part"]).mapInArrow(place, schema)
