"""Exact top-k by inner product with Fagin's threshold algorithm.

Candidates and queries are dealt into blocks of bounded size; the task of a pair
of blocks keeps one sorted list per dimension and reads the lists of a query from
their better ends, scoring every vector that it meets, until the bound on what
was not met (the sum of the lists' current values times the query's) is below the
k-th score.  Blocks' answers are then ranked together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.llm.common import written

BLOCK = 8192
QUERY_BLOCK = 4096
FIRST_DEPTH = 32


class Lists:
    """One sorted list per dimension over a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.n = ids, vectors, len(ids)
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best but ``own``; equal scores by smaller id."""
        n, up, down = self.n, np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        low, high = 0, min(FIRST_DEPTH, n)
        while True:
            reached = np.concatenate([self.order[n - high: n - low, up].ravel(), self.order[low:high, down].ravel()])
            if not len(up) and not len(down):
                reached = np.arange(low, high)
            new = np.zeros(n, bool)
            new[reached] = True
            new = np.flatnonzero(new & ~met)
            met[new] = True
            ids = np.concatenate([ids, self.ids[new]])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            kept = ids != own
            ids, scores = ids[kept], scores[kept]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if high == n or len(up) + len(down) and met.all():
                return ids, scores
            bound = query[up] @ self.values[n - high, up] + query[down] @ self.values[high - 1, down]
            if len(ids) == k and scores[-1] > bound:
                return ids, scores
            low, high = high, min(2 * high, n)


def scaled(vector: Column, by: int = 256) -> Column:
    """Each component times ``by``, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(by))))


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best integer inner products of each query with every other row.

    Ties go to the smaller id; with fewer candidates, all are returned.  Rows with
    a null id, or a vector that is null or holds null or non-finite components,
    take no part; rows that repeat an id count once, with the least vector.
    Shorter vectors are as if padded with zeros.  Vectors so large that a
    product could pass 64 bits, which a score cannot hold, are an error.
    """
    d = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("q"))
    d = d.where(F.col("id").isNotNull() & usable(F.col("v"))).select("id", scaled(F.col("v")).alias("v"), "q")
    d = written(d.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")), "vectors")
    size = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    seen = d.agg(F.count(F.lit(1)), F.sum(F.col("q").cast("long")), F.max(F.size("v")), F.max(size)).first()
    n, n_queries, width, largest = seen[0], seen[1] or 0, seen[2] or 0, seen[3] or 0.0
    blocks, query_blocks = max(-(-n // BLOCK), 1), max(-(-n_queries // QUERY_BLOCK), 1)
    parallel = d.sparkSession.sparkContext.defaultParallelism
    blocks = max(blocks, min(2 * parallel, -(-n // 256)))
    if width * largest * largest >= 2 ** 63:
        raise ValueError(f"products of {width} components of up to {largest:g} may pass 64 bits")
    kind = np.float64 if width * largest * largest < 2 ** 53 else np.int64  # floats are exact that far, and faster

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = d.where("q").select("id", "v", block(query_blocks).alias("qb"), every(blocks).alias("cb"))
    right = d.select("id", "v", block(blocks).alias("cb"), every(query_blocks).alias("qb"))

    def matrix(col) -> np.ndarray:
        out = np.zeros((len(col), width), kind)
        for i, x in enumerate(col):
            out[i, : len(x)] = x
        return out

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        lists = Lists(candidates["id"].to_numpy(np.int64), matrix(candidates["v"])) if len(candidates) else None
        got = [(q, *lists.top(q, x, k)) for q, x in zip(queries["id"].tolist(), matrix(queries["v"]))] if lists else []
        return pd.DataFrame({"query_id": np.repeat(np.array([q for q, _, _ in got], np.int64), [len(i) for _, i, _ in got]),
                             "vec_id": np.concatenate([i for _, i, _ in got] or [np.empty(0, np.int64)]),
                             "score": np.concatenate([s for _, _, s in got] or [np.empty(0)]).astype(np.int64)})

    found = left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
