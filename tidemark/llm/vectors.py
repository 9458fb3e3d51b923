"""Vectors as blocks of matrices, and heaps that merge top lists."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_EVERY = 20
BLOCK = 2048  # vectors of one block
GROUPS = 64  # groups of candidate blocks; each query block meets each group once


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, embedding`` of the rows whose vector has components, all finite; an id must not be null."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad
    )


def rows_of(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the vectors of each length in a batch."""
    ids, lists = batch.column("vec_id").to_numpy(), batch.column("embedding")
    sizes = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    out = []
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        out.append((ids[own], flat[starts[own][:, None] + np.arange(size)]))
    return out


def one_per_id(vectors: DataFrame) -> DataFrame:
    """Of rows with one id the smallest vector."""
    return vectors.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def blocks(vectors: DataFrame, pack: Callable[[np.ndarray], dict[str, bytes]], names: tuple[str, ...], extra: int = 0) -> DataFrame:
    """Vectors of one length in blocks of at most BLOCK: ``size, ids`` and what ``pack`` makes of the matrix, without a shuffle.

    The last ``extra`` components are no part of a vector but numbers that go with it.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        waiting: dict[int, list] = {}

        def out(size: int) -> pa.RecordBatch:
            ids, matrix = (np.concatenate(x) for x in zip(*waiting.pop(size)))
            packed = pack(matrix)
            row = {"size": [size - extra], "ids": [ids.astype(np.int64).tobytes()], **{n: [packed[n]] for n in names}}
            return pa.RecordBatch.from_pydict(row, schema=schema)

        for batch in batches:
            for ids, matrix in rows_of(batch):
                for at in range(0, ids.size, BLOCK):
                    size = matrix.shape[1]
                    waiting.setdefault(size, []).append((ids[at : at + BLOCK], matrix[at : at + BLOCK]))
                    if sum(i.size for i, _ in waiting[size]) >= BLOCK:
                        yield out(size)
        for size in list(waiting):
            yield out(size)

    schema = pa.schema([("size", pa.int32()), ("ids", pa.binary()), *((n, pa.binary()) for n in names)])
    return vectors.mapInArrow(run, "size int, ids binary, " + ", ".join(f"{n} binary" for n in names))


def tiles(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each query block beside each candidate block of its vector length: columns ``q_*`` and ``c_*``.

    Candidate blocks are dealt into GROUPS; each query block goes to every group, so the join is on group and length.
    """
    q = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns], F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("group"))
    c = candidates.select(*[F.col(c).alias(f"c_{c}") for c in candidates.columns], F.pmod(F.xxhash64("ids"), F.lit(GROUPS)).cast("int").alias("group"))
    return c.join(q, (c["group"] == q["group"]) & (F.col("q_size") == F.col("c_size"))).drop("group")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to smaller ids, in that order."""
    if scores.size > 4 * k:
        floor = np.partition(scores, scores.size - k)[scores.size - k]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(scores.size)
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


class Heaps:
    """The ``k`` best of each query so far, as heaps with the worst on top."""

    def __init__(self, k: int):
        self.k, self.heaps = k, {}

    def add(self, query: int, scores, ids) -> None:
        heap = self.heaps.setdefault(query, [])
        for score, i in zip(scores, ids):
            entry = (score, -i)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)

    def floor(self, query: int):
        """Score that a newcomer must reach, or None while there is room."""
        heap = self.heaps.get(query)
        return heap[0][0] if heap and len(heap) == self.k else None

    def rows(self) -> tuple[list, list, list]:
        out: tuple[list, list, list] = ([], [], [])
        for query, heap in self.heaps.items():
            for score, i in heap:
                for column, value in zip(out, (query, -i, score)):
                    column.append(value)
        return out


def merged(partial: DataFrame, k: int) -> DataFrame:
    """Rank the best ``k`` of each query among the lists that tasks kept; a list holds ``k`` entries at most."""
    kind = dict(partial.dtypes)["score"]

    def meet(table: pa.Table) -> pa.Table:
        heaps = Heaps(k)
        heaps.add(0, table.column("score").to_pylist(), table.column("vec_id").to_pylist())
        query = table.column("query_id")[0].as_py()
        top = sorted(heaps.heaps[0], reverse=True)
        return pa.table(
            {
                "query_id": pa.array([query] * len(top), pa.int64()),
                "rank": pa.array(range(1, len(top) + 1), pa.int32()),
                "vec_id": pa.array([-i for _, i in top], pa.int64()),
                "score": pa.array([s for s, _ in top], pa.float64() if kind == "double" else pa.int64()),
            }
        )

    return partial.groupBy("query_id").applyInArrow(meet, f"query_id bigint, rank int, vec_id bigint, score {kind}")
