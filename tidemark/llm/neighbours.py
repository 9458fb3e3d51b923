"""Nearest neighbours by a block matrix join of int8 tiles.

A vector is kept as int8 components with one scale, beside its norm and the norm of what quantisation lost.  The product of
two int8 blocks gives every inner product of a tile within a bound that follows from those norms:
|x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|.  A pair whose upper bound does not reach the k-th best lower bound of its
query is out; the others are computed again from the original vectors in double precision.  Heaps merge a query's survivors,
within a task over all its tiles and then over tasks.  Nothing is missed: recall is 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import QUERY_EVERY, Heaps, best, blocks, merged, one_per_id, tiles, usable

SLACK = 1e-9  # relative room for rounding in the bounds
LEAST = np.finfo(np.float64).tiny  # room for products too small for a double


def quantised(matrix: np.ndarray) -> dict[str, bytes]:
    """int8 components, the vectors, and four numbers of each: scale and norms, taken of components over the largest one."""
    peak = np.abs(matrix).max(axis=1)
    scale = np.maximum(peak / 127, LEAST)
    small = np.rint(matrix / scale[:, None]).astype(np.int8)
    kept = small * scale[:, None]
    unit = np.maximum(peak, LEAST)
    with np.errstate(over="ignore"):  # a norm that no double holds is infinite
        lost, near, own = (np.sqrt(((m / unit[:, None]) ** 2).sum(axis=1)) * unit for m in (matrix - kept, kept, matrix))
    return {"small": small.tobytes(), "exact": matrix.tobytes(), "scale": np.stack([scale, lost, near, own]).tobytes()}


def unpack(row: dict, side: str):
    size = row[f"{side}_size"]
    ids = np.frombuffer(row[f"{side}_ids"], np.int64)
    scale, lost, near, own = np.frombuffer(row[f"{side}_scale"]).reshape(4, ids.size)
    small = np.frombuffer(row[f"{side}_small"], np.int8).reshape(ids.size, size)
    return ids, small, np.frombuffer(row[f"{side}_exact"]).reshape(ids.size, size), scale, lost, near, own


def inner(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; one that no double holds is infinite, also where terms of both signs are."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = (values * query).sum(axis=1)
    for n in np.flatnonzero(~np.isfinite(out)):
        low, high = np.frexp(np.abs(values[n]).max())[1], np.frexp(np.abs(query).max())[1]
        with np.errstate(over="ignore"):
            out[n] = np.ldexp((np.ldexp(values[n], -low) * np.ldexp(query, -high)).sum(), low + high)
    return out


def tile_into(heaps: Heaps, row: dict, k: int, step: int = 256) -> None:
    """Offer one tile's survivors to the heaps."""
    q_ids, q_small, q_exact, q_scale, q_lost, q_near, q_own = unpack(row, "q")
    c_ids, c_small, c_exact, c_scale, c_lost, c_near, c_own = unpack(row, "c")
    wide = c_small.astype(np.float32).T  # products of int8 stay exact in float32 below 2^24, so split long vectors
    with np.errstate(over="ignore"):
        beyond = not np.isfinite(8 * q_own.max() * c_own.max())
    for at in range(0, q_ids.size, step):
        part = slice(at, at + step)
        product = np.zeros((q_ids[part].size, c_ids.size))
        for d in range(0, q_small.shape[1], 1024):
            product += q_small[part, d : d + 1024].astype(np.float32) @ wide[d : d + 1024]
        with np.errstate(over="ignore", invalid="ignore"):
            product *= q_scale[part, None] * c_scale
            error = q_lost[part, None] * c_own + q_near[part, None] * c_lost
            error += SLACK * (q_own[part, None] * c_own) + LEAST * q_small.shape[1]
            lower, upper = product - error, product + error
        if beyond:  # bounds that no double holds tell nothing
            unknown = ~(np.isfinite(product) & np.isfinite(error))
            lower[unknown], upper[unknown] = -np.inf, np.inf
        own = q_ids[part, None] == c_ids
        lower[own] = upper[own] = -np.inf
        if c_ids.size > k:
            cut = np.partition(lower, c_ids.size - k, axis=1)[:, c_ids.size - k]
        else:
            cut = np.full(lower.shape[0], -np.inf)
        for n, query in enumerate(q_ids[part].tolist()):
            floor = heaps.floor(query)
            keep = np.flatnonzero((upper[n] >= (cut[n] if floor is None else max(cut[n], floor))) & (upper[n] > -np.inf))
            exact = inner(c_exact[keep], q_exact[at + n])
            chosen = best(exact, c_ids[keep], k)
            heaps.add(query, exact[chosen].tolist(), c_ids[keep][chosen].tolist())


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` vectors of largest inner product, itself left out.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part; only vectors of a query's own length are its
    candidates.  Ties go to the smaller id.  A candidate that repeats counts each time; of queries with one id the smallest vector asks.
    A product that no double holds is infinite.
    """
    columns = ("small", "exact", "scale")
    nonzero = F.exists("embedding", lambda x: x != 0)
    candidates = blocks(usable(vectors).where(nonzero), quantised, columns)
    asked = blocks(one_per_id(usable(queries).where(nonzero)), quantised, columns)

    def run(batches):
        heaps = Heaps(k)
        for batch in batches:
            for n in range(batch.num_rows):
                tile_into(heaps, {c: batch.column(c)[n].as_py() for c in batch.schema.names}, k)
        query, ids, score = heaps.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"]
        )

    return merged(tiles(asked, candidates).mapInArrow(run, "query_id bigint, vec_id bigint, score double"), k)


def every_twentieth(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.col("vec_id") % QUERY_EVERY == 0)
