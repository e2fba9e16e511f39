"""Nearest neighbours by a block matrix join.

Vectors are rounded to int8 with a scale of their own, and the exact length of
what rounding took away is kept.  A tile multiplies a block of queries with a
block of candidates in int8 values, which gives every distance up to the sum of
the two rounding lengths.  A candidate survives a tile if its lower bound is no
larger than the query's k-th smallest upper bound there, so none of the tile's
k nearest is lost.  Bounds are taken on values scaled by a power of two, and a
candidate whose bound is no number survives, so no size of values loses one.
Survivors are recomputed from the original values in double precision, a task
keeps k per query of all its tiles of a query block, and heaps merge the tasks.

The result is exact.  Defined cases: vectors that are NULL, empty, zero or hold
NULL or a non-finite component take no part, nor do vectors whose length
differs from the query's; rows with a NULL id take no part; equal distances go
to the smaller id; of rows that repeat an id the nearest counts, and no row is
its own query's candidate; with fewer candidates than k all are returned; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import groups, saved

K = 10
#: Rows of a block of queries and of a block of candidates.
QUERY_BLOCK = 4096
ROW_BLOCK = 1024
#: Queries that one step of a tile compares.
STRIPE = 512
#: Tasks of the tiles at most, as a multiple of the session's shuffle partitions.
TASKS = 4
#: Candidates that a task holds before it drops all but k per query.
HELD = 1 << 20


def vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, dim, embedding as doubles) of the rows that take part."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = (F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    return (rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
            .select("vec_id", F.size("v").cast("bigint").alias("dim"), "v"))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scale, squared length of the rounded vector, rounding length)."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1  # too small next to the others of its tile: rounded to nothing
    values = np.rint(x / scale[:, None]).astype(np.int8)
    rounded = values * scale[:, None]
    return (values, scale, np.einsum("ij,ij->i", rounded, rounded),
            np.sqrt(np.square(x - rounded).sum(1)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, components added up in order.

    Where squares overflow, the rows are scaled by a power of two first, which
    changes no digit of the result.
    """
    def plain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(len(a))
        for k in range(a.shape[1]):
            step = a[:, k] - b[:, k]
            total += step * step
        return np.sqrt(total)

    with np.errstate(over="ignore"):
        out = plain(a, b)
        large = np.flatnonzero(~np.isfinite(out))
        if len(large):
            up = np.frexp(np.maximum(np.abs(a[large]).max(1), np.abs(b[large]).max(1)))[1]
            out[large] = np.ldexp(plain(np.ldexp(a[large], -up[:, None]), np.ldexp(b[large], -up[:, None])), up)
    return out


def best_of(q: np.ndarray, c: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest candidates of each query; of rows that repeat an id the nearest."""
    order = np.lexsort((d, c, q))
    q, c, d = q[order], c[order], d[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, d = q[new], c[new], d[new]
    order = np.lexsort((c, d, q))
    q, c, d = q[order], c[order], d[order]
    near = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[near], c[near], d[near]


def tile(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray,
         k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, candidate, distance): the k nearest of the tile, stripe by stripe."""
    up = -int(np.frexp(max(np.abs(q).max(), np.abs(c).max()))[1])
    qv, qs, qq, qe = quantised(np.ldexp(q, up))
    cv, cs, cc, ce = quantised(np.ldexp(c, up))
    # int8 products add up exactly in float32 while the sum stays below 2**24.
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    cv = cv.astype(kind).T
    need = k * int(np.unique(c_id, return_counts=True)[1].max())  # ids may repeat
    for lo in range(0, len(q), STRIPE):
        at = slice(lo, lo + STRIPE)
        dot = (qv[at].astype(kind) @ cv) * qs[at, None] * cs[None, :]
        square = qq[at, None] + cc[None, :] - 2 * dot
        near = np.sqrt(np.maximum(square, 0))
        # A relative slack covers the rounding of this arithmetic itself.
        slack = qe[at, None] + ce[None, :] + 1e-6 * (np.sqrt(qq[at, None]) + np.sqrt(cc)[None, :])
        upper, lower = near + slack, near - slack
        own = q_id[at, None] == c_id[None, :]
        upper[own] = np.inf
        if len(c) > need:
            least = np.partition(upper, need - 1, axis=1)[:, need - 1:need]
            keep = ~(lower > least) & ~own
        else:
            keep = ~own
        i, j = np.nonzero(keep)
        d = distances(q[lo + i], c[j])
        order = np.lexsort((c_id[j], d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        best = rank < need
        yield q_id[lo + i[best]], c_id[j[best]], d[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks != 1 else column.chunk(0).flatten()
    return flat.to_numpy().reshape(len(column), -1)


def nearest(queries: DataFrame, rows: DataFrame, k: int = K, vec_id: str = "vec_id",
            embedding: str = "embedding", query_block: int = QUERY_BLOCK,
            row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows nearest to each query, nearest first.

    A query and a row with the same id are the same vector.  Blocks are dealt
    by hash; every (query block, row block, dim) is a tile, and each row is sent
    once per query block, each query once per row block.  A task takes the tiles
    of a query block with several row blocks, so that there are ``TASKS`` times
    the session's shuffle partitions at most, and sends k candidates a query.
    """
    queries = saved(vectors(queries, vec_id, embedding).dropDuplicates(), "queries")
    rows = saved(vectors(rows, vec_id, embedding).dropDuplicates(), "rows")
    q_blocks = -(-queries.count() // query_block) or 1
    r_blocks = -(-rows.count() // row_block) or 1

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int, query: int) -> DataFrame:
        return df.select("vec_id", "dim", "v", F.lit(query).cast("bigint").alias("query"),
                         F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_own)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_other - 1).cast("bigint")))
                         .alias(other))

    both = dealt(queries, "i", q_blocks, "j", r_blocks, 1).unionByName(
        dealt(rows, "j", r_blocks, "i", q_blocks, 0))
    spark = both.sparkSession
    most = max(TASKS * int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    per_task = -(-q_blocks * r_blocks // most)
    both = (both.withColumn("g", F.floor(F.col("j") / per_task))
            .repartition(min(most, q_blocks * -(-r_blocks // per_task)), "i", "g", "dim")
            .sortWithinPartitions("i", "g", "dim", "j", "query"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, key = 0, None

        def best() -> tuple[np.ndarray, ...]:
            return best_of(*map(np.concatenate, zip(*held)), k)

        for group in groups(batches, "i", "g", "dim", "j"):
            if key != (key := tuple(group.column(c)[0].as_py() for c in ("i", "g", "dim"))) and held:
                yield pa.record_batch(dict(zip(("query_id", "vec_id", "score"), best())))
                held, size = [], 0
            n = int((group.column("query").to_numpy() == 0).sum())
            if n == 0 or n == len(group):
                continue
            ids, values = group.column("vec_id").to_numpy(), _matrix(group.column("v"))
            for found in tile(ids[n:], values[n:], ids[:n], values[:n], k):
                held.append(found)
                size += len(found[0])
            if size > HELD:
                held = [best()]
                size = len(held[0][0])
        if held:
            yield pa.record_batch(dict(zip(("query_id", "vec_id", "score"), best())))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict[int, float]] = {}
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for q, c, d in zip(*(batch.column(x).to_pylist() for x in ("query_id", "vec_id", "score"))):
                heap, seen = heaps.setdefault(q, []), best.setdefault(q, {})
                if c in seen:  # another row of the same id
                    if d < seen[c]:
                        heap[heap.index((-seen[c], -c))] = (-d, -c)
                        heapq.heapify(heap)
                        seen[c] = d
                elif len(heap) < k:
                    heapq.heappush(heap, (-d, -c))
                    seen[c] = d
                elif (-d, -c) > heap[0]:
                    seen.pop(-heapq.heapreplace(heap, (-d, -c))[1])
                    seen[c] = d
        out = [(q, r, -c, -d) for q, heap in heaps.items()
               for r, (d, c) in enumerate(sorted(heap, reverse=True), 1)]
        if out:
            q, r, c, d = zip(*out)
            yield pa.record_batch({"query_id": pa.array(q, pa.int64()), "rank": pa.array(r, pa.int32()),
                                   "vec_id": pa.array(c, pa.int64()), "score": pa.array(d, pa.float64())})

    found = both.mapInArrow(compare, "query_id bigint, vec_id bigint, score double")
    return found.repartition("query_id").mapInArrow(
        merge, "query_id bigint, rank int, vec_id bigint, score double")
