"""Exact inner-product search with the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks of a bounded number of rows, queries into blocks too,
and each pair of blocks is one group of one task. There, every dimension's list is
sorted once. A query walks the lists from the end that favours its component, scores
each vector it meets in full, and stops when the sum of the list heads, the best any
unseen vector could have, is below its k-th score. Equal bounds go on, so ties are
exact. A query's bests of all blocks are merged by a ranked window, which keeps k rows
of each task before the shuffle.

Components become floor(256 * x), scores are exact integers: a vector whose squared components then
add up to LARGEST or more is an error, and below it no score leaves eight bytes. Defined cases: vectors
that are null or hold a null or non-finite component, and rows without an identifier,
take no part. Vectors are compared only with those of the same length; an empty vector
scores 0. Equal scores go to the smaller identifier; repeated rows are rows of their
own, but never candidates of a query with the same identifier; equal queries are one. Fewer than k candidates
give fewer rows, an empty table none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

BLOCK_ROWS = 8192
SCALE = 256
LARGEST = float(1 << 62)
FOUND = "query_id long, vec_id long, score long"


class SortedLists:
    """One list per dimension over the vectors of a block, ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best, best first; ties to the smaller identifier."""
        n, dims = self.vectors.shape
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        use = np.flatnonzero(query)
        seen = np.zeros(n, bool)
        own = self.ids == query_id
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, 4 * k
        low, high = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        while depth < n and len(use):
            upto = min(n, depth + step)
            met = np.concatenate([self.order[low, depth:upto].ravel(), self.order[high, n - upto : n - depth].ravel()])
            fresh = np.unique(met[~seen[met]])
            seen[fresh] = True
            fresh = fresh[~own[fresh]]
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, self.vectors[fresh] @ query])
            best = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[best], scores[best]
            depth, step = upto, step * 2
            if depth < n and len(rows) == k:
                heads = np.where(query[use] < 0, depth, n - 1 - depth)
                bound = int((self.vectors[self.order[use, heads], use] * query[use]).sum())
                if bound < scores[-1]:
                    break
        if not len(use):  # a query of zeros scores 0 with everything
            rows = np.flatnonzero(~own)[:k]
            scores = np.zeros(len(rows), np.int64)
        return rows, scores


def as_integers(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, dim, vec: the components as eight-byte integers, of the vectors that take part."""
    x = vectors.select(vectors[id_col].cast("long").alias("id"), F.transform(vectors[vec_col], lambda v: v.cast("double")).alias("v"))
    fine = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    size = F.aggregate("v", F.lit(0.0), lambda s, v: s + (F.abs(v) * SCALE + 1) * (F.abs(v) * SCALE + 1))
    whole = F.when(size < LARGEST, F.transform("v", lambda v: F.floor(v * SCALE))).otherwise(F.raise_error(F.lit("a vector is too long for exact scores")))
    return x.where(F.col("id").isNotNull() & fine).select("id", F.size("v").alias("dim"), whole.alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. Every query against every row of vectors but its own."""
    every, asked = as_integers(vectors, id_col, vec_col), as_integers(queries, id_col, vec_col).dropDuplicates()
    n_blocks = max(1, -(-vectors.count() // block_rows))
    n_query_blocks = max(1, -(-queries.count() // block_rows))
    salt = F.xxhash64("id", F.lit(7))
    candidates = every.select("dim", F.pmod(salt, F.lit(n_blocks)).cast("int").alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("qb"), "id", "v")
    wanted = asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("cb"), F.pmod(salt, F.lit(n_query_blocks)).cast("int").alias("qb"), "id", "v")

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t.column("id").to_numpy()
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return ids.astype(np.int64), flat.astype(np.int64).reshape(len(ids), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            lists, found = SortedLists(*matrix(left)), []
            for query_id, query in zip(*matrix(right), strict=True):
                rows, scores = lists.top(query_id, query, k)
                found.append((np.full(len(rows), query_id), lists.ids[rows], scores))
            out = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pa.table([pa.array(x, pa.int64()) for x in out], ["query_id", "vec_id", "score"])

    keys = ["dim", "cb", "qb"]
    found = candidates.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
