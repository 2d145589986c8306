"""Nearest neighbours of a query set against all vectors, as a block matrix join.

Blocks of queries meet blocks of vectors. In such a tile the products of int8 vectors give every inner
product with a bound on its error; only pairs that the bounds leave among a query's best are recomputed in
double precision, and the tiles' lists are merged by heaps.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map

QUERY_BLOCK = 2048
VECTOR_BLOCK = 8192
_STRIP = 256
"""Queries of a tile whose bounds are held at a time."""


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, the norms of the errors, and the norms of the vectors."""
    largest = np.abs(x).max(axis=1)
    power = np.ldexp(1.0, np.frexp(largest)[1] - 1)  # scaled by a power of two first: no overflow, no underflow
    unit = x / power[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))
    return q, scale * power, error * power, np.sqrt((unit**2).sum(axis=1)) * power


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _alike(ids: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct vectors, and the ``most`` smallest ids of each: more of the same can't be among the best."""
    order = np.argsort(ids, kind="stable")
    rows = np.ascontiguousarray(x[order] + 0.0)
    _, first, which = np.unique(rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
    by = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[by], np.arange(len(first) + 1))
    sorted_ids = ids[order]
    return rows[first], [sorted_ids[by[a : min(b, a + most)]] for a, b in zip(cuts[:-1], cuts[1:])]


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query id, vector id, score) of the ``k`` best in a tile per query, in strips of queries."""
    distinct, members = _alike(ids, vectors, k + 1)
    width = distinct.shape[1]
    exact = np.float32 if width * 127 * 127 < 1 << 24 else np.float64  # whole products stay exact in it
    q, scale, error, norm = quantised(distinct)
    q = q.astype(exact)
    members_of = np.array([len(m) for m in members])
    for begin in range(0, len(query_ids), _STRIP):
        own_ids, own = query_ids[begin : begin + _STRIP], queries[begin : begin + _STRIP]
        p, own_scale, own_error, own_norm = quantised(own)
        with np.errstate(over="ignore", invalid="ignore"):
            about = (p.astype(exact) @ q.T).astype(np.float64) * (own_scale[:, None] * scale[None, :])
            off = own_norm[:, None] * error[None, :] + own_error[:, None] * (norm + error)[None, :]
            off += 1e-9 * own_norm[:, None] * norm[None, :]  # for the rounding of the bounds themselves
            least = about - off
            if len(distinct) > k + 1:  # one more than k, as the query itself may be among them
                bar = np.partition(least, len(distinct) - k - 1, axis=1)[:, len(distinct) - k - 1]
            else:
                bar = np.full(len(own_ids), -np.inf)
            row, column = np.nonzero(~(about + off < bar[:, None]))
        score = np.empty(len(row))
        for a in range(0, len(row), 1 << 16):
            score[a : a + (1 << 16)] = inner(own[row[a : a + (1 << 16)]], distinct[column[a : a + (1 << 16)]])
        times = members_of[column]
        row, score = np.repeat(row, times), np.repeat(score, times)
        found = np.concatenate([members[c] for c in column.tolist()]) if len(column) else np.zeros(0, np.int64)
        other = found != own_ids[row]
        row, score, found = row[other], score[other], found[other]
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        starts = np.searchsorted(row, np.arange(len(own_ids)))
        best = np.arange(len(row)) - starts[row] < k
        yield own_ids[row[best]], found[best], score[best]


def _tiles(k: int):
    def run(batches):
        rows, last = [], None

        def judged():
            asked, held = [r for r in rows if r[0]], [r for r in rows if not r[0]]
            if asked and held:
                as_arrays = lambda rs: (np.array([r[1] for r in rs], np.int64), np.array([r[2] for r in rs], np.float64))
                for query, vec, score in tile(*as_arrays(asked), *as_arrays(held), k):
                    yield pa.record_batch([pa.array(query), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            vectors = batch.column(5)
            for i, (width, qb, vb, asks, vec_id) in enumerate(zip(*columns)):
                if (width, qb, vb) != last:
                    yield from judged()
                    rows, last = [], (width, qb, vb)
                rows.append((asks, vec_id, vectors[i].values.to_numpy(zero_copy_only=False)))
        yield from judged()

    return run


def _merged(k: int):
    def run(batches):
        heap: list[tuple[float, int]] = []  # the k best so far, the worst first
        last = None

        def ranked():
            best = sorted(heap, reverse=True)
            return pa.record_batch([
                pa.array([last] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()),
                pa.array([-v for _, v in best], pa.int64()), pa.array([s for s, _ in best], pa.float64()),
            ], ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for query, vec, score in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if query != last:
                    if heap:
                        yield ranked()
                    heap, last = [], query
                entry = (score, -vec)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        if heap:
            yield ranked()

    return run


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` of rows with an id and a vector without nulls, NaN or infinite components that is not zero."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    source = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return source.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def nearest(df: DataFrame, asks: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest by inner product, ties to the smaller id.

    Queries are the rows of ``df`` for which ``asks`` (an expression over ``vec_id``) holds; candidates are all
    rows but those with the query's own id. Vectors that are null, empty or zero, or hold null or non-finite
    components, take no part, nor do rows without an id. Rows that repeat id and vector count once; rows of one id
    with different vectors are all candidates, and all queries, whose lists are merged under the id. Vectors are compared with those of the same number of components. All candidates are returned if
    there are fewer than ``k``; an empty table gives no rows. Only the two named columns are read. Work grows
    with queries times vectors, in tiles of fixed size; a vector that many rows share is compared once a tile.
    """
    vectors = usable(df, key, vector).distinct().withColumn("width", F.size("v"))
    n, asked = usable(df, key, vector).agg(F.count("*"), F.count_if(asks)).first()
    query_blocks, vector_blocks = max(1, math.ceil(asked / QUERY_BLOCK)), max(1, math.ceil(n / VECTOR_BLOCK))
    block = lambda of: F.pmod(F.xxhash64("vec_id", "v"), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    queries = vectors.filter(asks).select("width", block(query_blocks).alias("qb"), every(vector_blocks).alias("vb"), F.lit(True).alias("asks"), "vec_id", "v")
    held = vectors.select("width", every(query_blocks).alias("qb"), block(vector_blocks).alias("vb"), F.lit(False).alias("asks"), "vec_id", "v")
    tiles = queries.unionByName(held).repartition("width", "qb", "vb").sortWithinPartitions("width", "qb", "vb")
    best = tiles.transform(arrow_map, _tiles(k), "query_id long, vec_id long, score double")
    return best.repartition("query_id").sortWithinPartitions("query_id").transform(arrow_map, _merged(k), "query_id long, rank int, vec_id long, score double")
