"""Exact top-k search by a three-phase uniform threshold.

The components are split into LISTS; a candidate's score is the sum of its parts, one per list.  Parts are shifted so that
the smallest part a list can give a query is zero.

1. Each task gathers, for every query and list, its k best parts; summed per candidate, with zero for a part not gathered,
   the k-th best sum is a lower bound of the k-th best score.
2. A candidate of the result has a part of at least that bound divided by the number of lists.  This cutoff, one number per
   query, goes to all tasks; each sends the entries that reach it and drops those whose upper bound, with the cutoff for every
   part not sent, stays below the lower bound.
3. Scores of the remaining candidates are resolved exactly and the best k kept.

Tasks are blocks of candidates, so a block's parts are products of two matrices and only entries above the cutoff leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.llm.vectors import Heaps, best, blocks, merged, one_per_id, tiles, usable

FACTOR = 64
LISTS = 2

LIMIT = 2**61  # a score beyond it counts as it
HIDDEN = -(2**62)  # part of a query's own row
SEEN = -LIMIT - 1
NONE = 2**62
LOW_BITS = 31  # whole numbers travel beside components as two doubles, so that no digit is lost


def whole(matrix: np.ndarray) -> dict[str, bytes]:
    """Components as whole numbers, floor(FACTOR * x); one that no double holds is the largest double."""
    with np.errstate(over="ignore"):
        return {"values": np.nan_to_num(np.floor(FACTOR * matrix)).tobytes()}


def with_cutoffs(matrix: np.ndarray) -> dict[str, bytes]:
    """The same, and the numbers of phase 1 that go with each query."""
    split = matrix.shape[1] - 2 * (1 + LISTS)
    halves = matrix[:, split:].astype(np.int64)
    return {**whole(matrix[:, :split]), "limits": ((halves[:, 0::2] << LOW_BITS) + halves[:, 1::2]).tobytes()}


def cut(size: int) -> list[slice]:
    """The components of each list."""
    edges = [size * n // LISTS for n in range(LISTS + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def large(query: np.ndarray, values: np.ndarray) -> np.ndarray | None:
    """Pairs whose sums need not stay below 2^53; None if there are none."""
    with np.errstate(over="ignore", invalid="ignore"):
        total, peak = np.abs(query).sum(axis=1), np.abs(values).max(axis=1, initial=0)
        if total.max(initial=0) * peak.max(initial=0) < 2**53:
            return None
        return ~(total[:, None] * peak < 2**53)


def exact(query: np.ndarray, values: np.ndarray, big: np.ndarray | None) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles where every sum stays below 2^53, else by Python's integers."""
    with np.errstate(over="ignore", invalid="ignore"):
        product = query @ values.T
    if big is None:
        return product.astype(np.int64)
    out = np.where(big, 0, product).astype(np.int64)
    for m, n in zip(*np.nonzero(big)):
        score = sum(int(a) * int(b) for a, b in zip(query[m], values[n]))
        out[m, n] = max(-LIMIT, min(LIMIT, score))
    return out


def split(query: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Parts (list, query, candidate); a large score is all in the first list, so that no part is beyond LIMIT."""
    big = large(query, values)
    if big is None:
        return np.stack([exact(query[:, s], values[:, s], None) for s in cut(query.shape[1])])
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.stack([np.where(big, 0, query[:, s] @ values[:, s].T) for s in cut(query.shape[1])]).astype(np.int64)
    out[0, big] = exact(query, values, big)[big]
    return out


def parts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and parts (list, query, candidate) of one tile."""
    size = row["q_size"]
    q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
    q = np.frombuffer(row["q_values"]).reshape(q_ids.size, size)
    c = np.frombuffer(row["c_values"]).reshape(c_ids.size, size)
    out = split(q, c)
    out[:, q_ids[:, None] == c_ids] = HIDDEN
    return q_ids, c_ids, out


def rows_of_batches(batches):
    for batch in batches:
        for n in range(batch.num_rows):
            yield {c: batch.column(c)[n].as_py() for c in batch.schema.names}


def gather(pairs: DataFrame, k: int) -> DataFrame:
    """Phase 1: of every query, list and task the k best parts, and the smallest part."""

    def run(batches):
        heaps = [Heaps(k) for _ in range(LISTS)]
        least: dict[tuple[int, int], int] = {}
        for row in rows_of_batches(batches):
            q_ids, c_ids, own = parts(row)
            for n, part in enumerate(own):
                low = np.where(part > SEEN, part, NONE).min(axis=1)
                for m, query in enumerate(q_ids.tolist()):
                    least[n, query] = min(least.get((n, query), NONE), int(low[m]))
                    floor = heaps[n].floor(query)
                    rows = np.flatnonzero(part[m] >= (SEEN if floor is None else floor))
                    top = rows[best(part[m][rows], c_ids[rows], k)]
                    heaps[n].add(query, part[m][top].tolist(), c_ids[top].tolist())
        for n, heap in enumerate(heaps):
            query, ids, part = heap.rows()
            yield pa.RecordBatch.from_pydict(
                {"query_id": query, "list": [n] * len(query), "vec_id": ids, "part": part, "least": [least[n, q] for q in query]}, schema=schema
            )

    schema = pa.schema([("query_id", pa.int64()), ("list", pa.int32()), ("vec_id", pa.int64()), ("part", pa.int64()), ("least", pa.int64())])
    return pairs.mapInArrow(run, "query_id bigint, list int, vec_id bigint, part bigint, least bigint")


def limits(gathered: DataFrame, k: int) -> DataFrame:
    """``query_id, limits``: the lower bound of the k-th best shifted score, then each list's smallest part, each as two doubles."""
    lows = gathered.groupBy("query_id", "list").agg(F.min("least").alias("low"))
    # A candidate that repeats has its parts several times; one of each list counts, so the sum stays a lower bound.
    bounds = (
        gathered.join(lows, ["query_id", "list"])
        .groupBy("query_id", "vec_id", "list")
        .agg(F.min(F.col("part") - F.col("low")).alias("part"))
        .groupBy("query_id", "vec_id")
        .agg(F.sum("part").alias("lower"))
        .groupBy("query_id")
        .agg(F.try_element_at(F.sort_array(F.collect_list("lower"), asc=False), F.lit(k)).alias("bound"))
    )
    shift = lows.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("list", "low"))), lambda x: x["low"]).alias("lows"))
    every = F.concat(F.array(F.coalesce("bound", F.lit(0))), "lows")
    halves = F.flatten(F.transform(every, lambda x: F.array(F.shiftright(x, LOW_BITS), x.bitwiseAND(F.lit(2**LOW_BITS - 1)))))
    return bounds.join(shift, "query_id").select("query_id", halves.cast("array<double>").alias("limits"))


def resolve(pairs: DataFrame, k: int) -> DataFrame:
    """Phases 2 and 3: entries that reach the cutoff, those that may be in the result, and their exact scores."""

    def run(batches):
        heaps = Heaps(k)
        for row in rows_of_batches(batches):
            q_ids, c_ids, own = parts(row)
            known = np.frombuffer(row["q_limits"], np.int64).reshape(q_ids.size, 1 + LISTS)
            for m, query in enumerate(q_ids.tolist()):
                bound, lows = known[m, 0], known[m, 1:]
                shifted = own[:, m] - lows[:, None]
                cutoff = -(-bound // LISTS)
                sent = shifted >= cutoff
                upper = np.where(sent, shifted, cutoff).sum(axis=0)
                rows = np.flatnonzero(sent.any(axis=0) & (upper >= bound))
                score = own[:, m, rows].sum(axis=0)
                rows, score = rows[score > SEEN], score[score > SEEN]
                floor = heaps.floor(query)
                if floor is not None:
                    rows, score = rows[score >= floor], score[score >= floor]
                top = best(score, c_ids[rows], k)
                heaps.add(query, score[top].tolist(), c_ids[rows][top].tolist())
        query, ids, score = heaps.rows()
        yield pa.RecordBatch.from_pydict({"query_id": query, "vec_id": ids, "score": score}, schema=schema)

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    return pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest whole-number inner products, itself left out.

    Vectors that are null, empty or hold a null or non-finite component take no part; only vectors of a query's own length
    are its candidates.  Ties go to the smaller id.  A candidate that repeats counts each time; of queries with one id the
    smallest vector asks.  Scores are exact up to LIMIT; those beyond count as LIMIT, or its negative.
    """
    candidates = stage(blocks(usable(vectors), whole, ("values",)), "blocks")
    asked = one_per_id(usable(queries))
    gathered = stage(gather(tiles(blocks(asked, whole, ("values",)), candidates), k), "gathered")
    limited = asked.join(limits(gathered, k), asked["vec_id"] == F.col("query_id"))
    limited = limited.select("vec_id", F.concat("embedding", "limits").alias("embedding"))
    again = blocks(limited, with_cutoffs, ("values", "limits"), extra=2 * (1 + LISTS))
    return merged(resolve(tiles(again, candidates), k), k)
