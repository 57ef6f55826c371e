"""Exact top-k inner products by the threshold algorithm over sorted lists, one list for each dimension."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise

#: Candidates and queries of a block; a task joins one block of each.
CANDIDATES, QUERIES = 4096, 8192
#: Entries read of each list before the bound is looked at first, and the factor by which the depth then grows.
DEPTH, GROWTH = 16, 4

PARTIAL = "query long, query_id long, vec_id long, row long, score long"


class Lists:
    """Candidates sorted by each dimension; a negative weight reads a list from its other end."""

    def __init__(self, vectors: np.ndarray):
        self.exact = vectors
        wide = max(1, int(np.abs(vectors).max(initial=0)))
        self.wide = wide
        self.fast = vectors.astype(np.float64)
        self.rising = np.argsort(vectors, axis=0, kind="stable")
        self.value = np.take_along_axis(vectors, self.rising, axis=0)

    def top(self, q: np.ndarray, k: int, own: int | None, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best (score, then smallest `tie`), without row `own`.

        Every row not yet met in any list scores at most the bound: the weights times the next values of the lists. Reading stops
        once the kth best score is above it; at equality an unmet row could still win a tie, so reading goes on.
        """
        n, d = self.exact.shape
        whole = self.wide * max(1, int(np.abs(q).max(initial=0))) * max(1, d) < 1 << 53  # exact in doubles
        table, weights = (self.fast, q.astype(np.float64)) if whole else (self.exact, q)
        met = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, weights.dtype)
        if own is not None:
            met[own] = True
        depth, columns = DEPTH, np.arange(d)
        while True:
            at = min(depth, n)
            ahead = met.copy()
            if d and at < n:
                near = np.where(q >= 0, np.arange(n - 1, n - 1 - at, -1)[:, None], np.arange(at)[:, None])
                ahead[self.rising[near, columns]] = True
            else:
                ahead[:] = True
            fresh = np.flatnonzero(ahead & ~met)
            met = ahead
            rows, scores = np.concatenate((rows, fresh)), np.concatenate((scores, table[fresh] @ weights))
            best = np.lexsort((tie[rows], -scores))[:k]
            rows, scores = rows[best], scores[best]
            if at >= n or d == 0:
                return rows, scores.astype(np.int64)
            following = self.value[np.where(q >= 0, n - 1 - at, at), columns]
            if len(rows) == k and scores[-1] > following.astype(weights.dtype) @ weights:
                return rows, scores.astype(np.int64)
            depth *= GROWTH


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(n, -1)


def _joiner(k: int):
    def join(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        n, m = candidates.num_rows, queries.num_rows
        if not n or not m:
            return pa.table({name: pa.array([], pa.int64()) for name in ("query", "query_id", "vec_id", "row", "score")})
        lists = Lists(_matrix(candidates.column("v"), n))
        vec_id, row = candidates.column("vec_id").to_numpy(), candidates.column("row").to_numpy()
        tie = np.empty(n, np.int64)
        tie[np.lexsort((row, vec_id))] = np.arange(n)
        place = dict(zip(row.tolist(), range(n)))
        vectors = _matrix(queries.column("v"), m)
        q_row, q_id = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
        parts = [lists.top(vectors[i], k, place.get(int(q_row[i])), tie) for i in range(m)]
        sizes = [len(r) for r, _ in parts]
        rows = np.concatenate([r for r, _ in parts])
        return pa.table({
            "query": pa.array(np.repeat(q_row, sizes)), "query_id": pa.array(np.repeat(q_id, sizes)), "vec_id": pa.array(vec_id[rows]),
            "row": pa.array(row[rows]), "score": pa.array(np.concatenate([s for _, s in parts]))})
    return join


def exact_topk(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `embeddings(vec_id, embedding)` whose id is divisible by `every`, the k other
    rows with the highest integer inner product of floor(scale * x), ties to the smaller id.

    Queries and candidates meet in blocks, a query block with every candidate block, and a task runs the threshold algorithm for
    its pair of blocks; k rows a query and block go on. Vectors that are null or hold null or non-finite components take no part, nor do
    rows without an id; vectors of different length are not compared; empty vectors score 0. Rows with equal ids are rows of their
    own: each may be a query and the others its candidates. Fewer than k other rows: all of them. Scores have to fit 64 bits. An
    empty table gives an empty result; other columns are ignored.
    """
    x = F.col("embedding")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(math.inf)))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & x.isNotNull() & sound).select(
        F.col("vec_id").cast("long"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vectors").withColumn("dim", F.size("v"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    n, m = rows.count(), queries.count()
    n_blocks, m_blocks = max(1, math.ceil(n / CANDIDATES)), max(1, math.ceil(m / QUERIES))
    block = lambda of, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(of)).cast("int")
    every_block = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    left = rows.select("*", block(n_blocks, 1).alias("c"), every_block(m_blocks).alias("q"))
    right = queries.select("*", block(m_blocks, 2).alias("q"), every_block(n_blocks).alias("c"))
    partial = left.groupBy("dim", "c", "q").cogroup(right.groupBy("dim", "c", "q")).applyInArrow(_joiner(k), PARTIAL)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return (
        partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
