"""Exact k-nearest-neighbour join and everything built on it
(D4-D6, L6, L7, L14, L15, K6).

References are dealt to the nearest of a bounded number of pivots, and a cell
into rings of distance from its pivot; a block is a ring, known by its pivot, its
least and greatest distance and its size.  By the triangle inequality no
reference of a block is nearer to a query than the query's own distance from the
pivot lies outside the ring.  So a query first looks into its home block, which
bounds its k-th distance, and is then sent to those other blocks alone whose
lower bound does not pass that.  Pivots and block statistics are bounded tables;
blocks and the queries of a block are split by hash into groups of bounded size,
so one dense cell is many tasks.  Neighbouring blocks travel as one chunk, and a
query is sent once to a chunk, however many of its blocks it asks: where the
bounds leave nothing out, as in many dimensions, rows are moved once per chunk
and not once per block.  Inside a chunk, a query still meets only the blocks it
asks.  NumPy computes the distances of a group and keeps the k best per query;
the final top-k is a window over these.

Distances are squared Euclidean in float64; ties are broken by the
reference id (the stable "first wins" order).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from foldsafe.session import scratch_path

DEFAULT_BLOCK = 4096
QUERY_CHUNK = 512
# References that a cell should have, and the most pivots and rings of a cell there can be.
CELL, MAX_PIVOTS, MAX_RINGS = 1024, 1024, 64
SAMPLE_PER_PIVOT = 8
# Blocks' worth of references that travel as one chunk at most, for vectors of up to CHUNK_DIMS values; and how many
# chunks there should be at least, for enough tasks.
CHUNK_BLOCKS, CHUNK_DIMS, MIN_CHUNKS = 16, 64, 8


def _vec_col(df: DataFrame, vec: str | Sequence[str]) -> DataFrame:
    if isinstance(vec, str):
        return df.withColumn("__v", F.transform(vec, lambda x: x.cast("double")))
    return df.withColumn("__v", F.array(*[F.col(c).cast("double") for c in vec]))


def _blocks(n: int, block: int) -> int:
    return max(1, int(math.ceil(n / float(block))))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"knn-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(col) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of two small matrices, without cancellation."""
    return np.sqrt(np.stack([((a - x) ** 2).sum(1) for x in b], 1))


@dataclass
class Cells:
    """Pivots, and the blocks of references around them."""

    pivots: np.ndarray
    cell: np.ndarray = None      # of each block: its pivot,
    low: np.ndarray = None       # the least and
    high: np.ndarray = None      # greatest distance of its references from it,
    size: np.ndarray = None      # and their number;
    ring: np.ndarray = None      # its place in the cell

    def keys(self) -> np.ndarray:
        return self.cell * MAX_RINGS + self.ring

    def lower_bounds(self, vectors: np.ndarray, only: np.ndarray | None = None) -> np.ndarray:
        """What each vector's distance from any reference of each block (or of the blocks at ``only``) is at least."""
        only = np.arange(len(self.cell)) if only is None else only
        used, at = np.unique(self.cell[only], return_inverse=True)
        d = _distances(vectors, self.pivots[used])[:, at]
        high, low = self.high[only], self.low[only]
        slack = 1e-9 * (d + high) + 1e-12  # distances are rounded
        return np.maximum(np.maximum(d - high, low - d) - slack, 0.0)

    def chunks(self, most: int) -> np.ndarray:
        """Each block's chunk: neighbouring blocks, of at most ``most`` references unless one block has more."""
        out, chunk, held = [], 0, 0
        for n in self.size.tolist():
            if held and held + n > most:
                chunk, held = chunk + 1, 0
            out.append(chunk)
            held += n
        return np.array(out, np.int32)


def pivots_of(sample: np.ndarray, n: int, steps: int = 4) -> np.ndarray:
    """Means of a bounded sample's groups around ``n`` of its rows."""
    centres = sample[:n].copy()
    for _ in range(steps):
        own = ((sample ** 2).sum(1)[:, None] - 2 * sample @ centres.T + (centres ** 2).sum(1)).argmin(1)
        for i in np.unique(own):
            centres[i] = sample[own == i].mean(0)
    return centres


def _cells(r: DataFrame, n: int, block: int, cell: int) -> tuple[DataFrame, Cells]:
    """``r`` with its ``block``, and the cells."""
    wanted = min(_blocks(n, cell), MAX_PIVOTS)
    by_hash = r.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE_PER_PIVOT * wanted).select("__v").collect()
    pivots = pivots_of(np.array([x[0] for x in by_hash], np.float64), wanted)

    def nearest(batches):
        for pdf in batches:
            if len(pdf):
                d = _distances(_matrix(pdf["__v"]), pivots)
                pdf["cell"] = d.argmin(1).astype(np.int32)
                pdf["away"] = d.min(1)
                yield pdf

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in r.schema)
    r = _written(r.mapInPandas(nearest, names + ", cell int, away double"), "cells")
    stats = r.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high"))
    stats = stats.withColumn("rings", F.least(F.ceil(F.col("n") / block), F.lit(MAX_RINGS)).cast("int"))
    width = (F.col("high") - F.col("low")) / F.col("rings")
    ring = F.when(width > 0, F.least(F.floor((F.col("away") - F.col("low")) / width).cast("int"), F.col("rings") - 1)).otherwise(0)
    r = r.join(F.broadcast(stats), "cell").withColumn("block", F.col("cell") * MAX_RINGS + ring).drop("n", "low", "high", "rings")
    blocks = r.groupBy("block").agg(F.min("away"), F.max("away"), F.count(F.lit(1))).orderBy("block").collect()
    key, low, high, size = (np.array(x) for x in zip(*blocks))
    return r.drop("cell", "away"), Cells(pivots, key // MAX_RINGS, low, high, size, key % MAX_RINGS)


def _pairs(q: DataFrame, r: DataFrame, sizes: dict[int, int], by: str, most: int, schema: str, rule) -> DataFrame:
    """``rule`` for each group of ``q`` and ``r`` of the same ``by`` (a block or a chunk, with its references in ``sizes``);
    both are split into groups of about ``most`` rows."""
    asked = {x[0]: x[1] for x in q.groupBy(by).agg(F.count(F.lit(1))).collect()}  # a row a block
    # what nobody asks for is not sent
    splits = [(key, _blocks(n, most), _blocks(asked[key], most)) for key, n in sizes.items() if key in asked]
    split = F.broadcast(q.sparkSession.createDataFrame(splits, f"{by} int, rs int, qs int"))
    part = lambda c, by: F.pmod(F.xxhash64(c), F.col(by)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    q = q.join(split, by).withColumn("qb", part("qid", "qs")).withColumn("rb", every("rs")).drop("rs", "qs")
    r = r.join(split, by).withColumn("rb", part("rid", "rs")).withColumn("qb", every("qs")).drop("rs", "qs")
    keys = [by, "qb", "rb"]
    return q.groupBy(*keys).cogroup(r.groupBy(*keys)).applyInPandas(rule, schema)


def knn_join(queries: DataFrame, refs: DataFrame, q_id: str, r_id: str, vec: str | Sequence[str], k: int,
             r_vec: str | Sequence[str] | None = None, exclude_self: bool = False,
             q_group: str | None = None, r_group: str | None = None, group_mode: str | None = None,
             block: int = DEFAULT_BLOCK, carry: Sequence[str] = (), cell: int = CELL) -> DataFrame:
    """The k nearest references of every query.

    Returns (q_id, rank, r_id, dist2, *carry) with rank 1..k.
    ``exclude_self`` drops the pair q_id = r_id (leave-one-out).
    ``group_mode='different'`` only pairs rows whose fold columns differ
    (``q_group`` <> ``r_group``): one join computes every out-of-fold
    neighbourhood at once (K6).
    """
    return _knn(queries, refs, q_id, r_id, vec, k, r_vec, exclude_self, q_group, r_group, group_mode, block, carry, cell)[0]


def knn_visits(queries: DataFrame, refs: DataFrame, q_id: str, r_id: str, vec: str | Sequence[str], k: int, **options) -> DataFrame:
    """Per query of the join with the same arguments: ``blocks`` it was sent to, ``of_blocks``, and ``pairs`` compared, ``of_pairs``."""
    return _knn(queries, refs, q_id, r_id, vec, k, **options)[1]


def _knn(queries, refs, q_id, r_id, vec, k, r_vec=None, exclude_self=False, q_group=None, r_group=None, group_mode=None,
         block=DEFAULT_BLOCK, carry=(), cell=CELL):
    r_vec = r_vec if r_vec is not None else vec
    q = _vec_col(queries, vec).select(F.col(q_id).alias("qid"), "__v", *([F.col(q_group).alias("qg")] if q_group else []))
    r = _vec_col(refs, r_vec).select(F.col(r_id).alias("rid"), "__v", *([F.col(r_group).alias("rg")] if r_group else []),
                                     *[F.col(c).alias(f"c__{c}") for c in carry])
    carry_cols = [f"c__{c}" for c in carry]
    has_qg, has_rg = q_group is not None, r_group is not None

    def group(qdf: pd.DataFrame, rdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": pd.Series([], dtype=qdf["qid"].dtype), "rid": pd.Series([], dtype=rdf["rid"].dtype),
                              "dist2": pd.Series([], dtype="float64"),
                              **{c: pd.Series([], dtype="object") for c in carry_cols}})
        if len(qdf) == 0 or len(rdf) == 0:
            return empty
        rdf = rdf.sort_values("rid", kind="stable")     # tie-break by reference id
        R, rid = _matrix(rdf["__v"]), rdf["rid"].to_numpy()
        rg = rdf["rg"].to_numpy() if has_rg else None
        centre = R.mean(axis=0)                         # far from the origin, the expanded distance cancels
        C = R - centre
        rn = (C * C).sum(axis=1)
        kk = min(k, len(rid))
        outs = []
        Q_all, qid_all = _matrix(qdf["__v"]), qdf["qid"].to_numpy()
        qg_all = qdf["qg"].to_numpy() if has_qg else None
        for s in range(0, len(qid_all), QUERY_CHUNK):
            Q, qid = Q_all[s:s + QUERY_CHUNK], qid_all[s:s + QUERY_CHUNK]
            P = Q - centre
            qn = (P * P).sum(axis=1)
            D = qn[:, None] + rn[None, :] - 2.0 * (P @ C.T)
            if exclude_self:
                D[qid[:, None] == rid[None, :]] = np.inf
            if group_mode == "different":
                D[qg_all[s:s + QUERY_CHUNK][:, None] == rg[None, :]] = np.inf
            # every reference that rounding could put among the k nearest is ranked by its exact distance
            error = 8.0 * (R.shape[1] + 4) * np.finfo(np.float64).eps * (qn + rn.max() + 1e-300)
            kth = np.partition(D, kk - 1, axis=1)[:, kk - 1]
            row, near = np.nonzero(np.isfinite(D) & (D <= (kth + 2.0 * error)[:, None]))
            exact = np.concatenate([((Q[row[i:i + 4096]] - R[near[i:i + 4096]]) ** 2).sum(axis=1) for i in range(0, len(row), 4096)] or [np.empty(0)])
            order = np.lexsort((near, exact, row))      # by query, exact distance, reference id
            row, near, exact = row[order], near[order], exact[order]
            first = np.searchsorted(row, np.arange(len(qid)))
            kept = np.arange(len(row)) - first[row] < kk
            part = pd.DataFrame({"qid": qid[row[kept]], "rid": rid[near[kept]], "dist2": exact[kept]})
            for c in carry_cols:
                part[c] = rdf[c].to_numpy()[near[kept]]
            outs.append(part)
        return pd.concat(outs, ignore_index=True) if outs else empty

    def chunk_group(qdf: pd.DataFrame, rdf: pd.DataFrame) -> pd.DataFrame:
        """The k best per query among the blocks it asks of a chunk, none farther than its bound."""
        if len(qdf) == 0 or len(rdf) == 0:
            return group(qdf, rdf)
        c = sent.value
        rdf = rdf.sort_values("rid", kind="stable")     # tie-break by reference id
        R, rid, of = _matrix(rdf["__v"]), rdf["rid"].to_numpy(), rdf["block"].to_numpy()
        rg = rdf["rg"].to_numpy() if has_rg else None
        centre = R.mean(axis=0)
        C = R - centre
        rn = (C * C).sum(axis=1)
        held = np.flatnonzero(np.isin(c.keys(), np.unique(of)))
        parts = [(j, at[i:i + DEFAULT_BLOCK]) for j, key in enumerate(c.keys()[held].tolist()) for at in [np.flatnonzero(of == key)]
                 for i in range(0, len(at), DEFAULT_BLOCK)]
        parts = [(j, at, C[at], rn[at]) for j, at in parts]
        Q_all, qid_all = _matrix(qdf["__v"]), qdf["qid"].to_numpy()
        home_all, bound_all = qdf["home"].to_numpy(), qdf["bound"].to_numpy()
        qg_all = qdf["qg"].to_numpy() if has_qg else None
        eps = 8.0 * (R.shape[1] + 4) * np.finfo(np.float64).eps
        outs = []
        for s in range(0, len(qid_all), QUERY_CHUNK):
            Q, qid, home, bound = Q_all[s:s + QUERY_CHUNK], qid_all[s:s + QUERY_CHUNK], home_all[s:s + QUERY_CHUNK], bound_all[s:s + QUERY_CHUNK]
            P = Q - centre
            qn = (P * P).sum(axis=1)
            asks = (c.lower_bounds(Q, held) <= bound[:, None]) & (c.keys()[held] != home[:, None])
            limit = bound * bound * (1 + 1e-12)         # no farther reference can be among the k nearest
            best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            for j, at, Cj, rnj in parts:
                who = np.flatnonzero(asks[:, j])
                if not len(who):
                    continue
                D = qn[who, None] + rnj[None, :] - 2.0 * (P[who] @ Cj.T)
                if exclude_self:
                    D[qid[who][:, None] == rid[at][None, :]] = np.inf
                if group_mode == "different":
                    D[qg_all[s:s + QUERY_CHUNK][who][:, None] == rg[at][None, :]] = np.inf
                # every reference that rounding could put among the k nearest is ranked by its exact distance
                error = eps * (qn[who] + rnj.max() + 1e-300)
                most = limit[who] + 2.0 * error
                open_ = np.flatnonzero(np.isinf(most))
                if len(open_) and len(at) > k:
                    most[open_] = np.partition(D[open_], k - 1, axis=1)[:, k - 1] + 2.0 * error[open_]
                row, near = np.nonzero((D <= most[:, None]) & np.isfinite(D))
                if not len(row):
                    continue
                row, near = who[row], at[near]
                exact = np.concatenate([((Q[row[i:i + 4096]] - R[near[i:i + 4096]]) ** 2).sum(axis=1) for i in range(0, len(row), 4096)])
                row, near, exact = (np.concatenate(x) for x in zip(best, (row, near, exact)))
                order = np.lexsort((near, exact, row))  # by query, exact distance, reference id
                row, near, exact = row[order], near[order], exact[order]
                place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(qid)))[row]
                last = place == k - 1
                limit[row[last]] = np.minimum(limit[row[last]], exact[last])
                best = tuple(x[place < k] for x in (row, near, exact))
            row, near, exact = best
            if len(row):
                part = pd.DataFrame({"qid": qid[row], "rid": rid[near], "dist2": exact})
                for x in carry_cols:
                    part[x] = rdf[x].to_numpy()[near]
                outs.append(part)
        return pd.concat(outs, ignore_index=True) if outs else group(qdf[:0], rdf)

    carry_schema = ", ".join(f"`c__{c}` {refs.schema[c].dataType.simpleString()}" for c in carry)
    q_type, r_type = queries.schema[q_id].dataType.simpleString(), refs.schema[r_id].dataType.simpleString()
    schema = f"qid {q_type}, rid {r_type}, dist2 double" + (", " + carry_schema if carry else "")
    n = r.count()
    if _blocks(n, cell) == 1:                           # one cell: nothing to leave out
        cells = Cells(np.empty((0, 0)), np.zeros(1, np.int64), np.zeros(1), np.zeros(1), np.array([n]), np.zeros(1, np.int64))
        q, r = q.withColumn("block", F.lit(0)), r.withColumn("block", F.lit(0))
        found, visits = _pairs(q, r, {0: n}, "block", block, schema, group), q.select("qid", "block")
    else:
        r, cells = _cells(r, n, block, cell)
        dims = max(1, cells.pivots.shape[1])
        most = max(block, min(_blocks(n, MIN_CHUNKS), CHUNK_BLOCKS * block * min(CHUNK_DIMS, dims) // dims))
        chunks = cells.chunks(most)
        of_chunk = F.broadcast(q.sparkSession.createDataFrame(list(zip(cells.keys().tolist(), chunks.tolist())), "block int, chunk int"))
        r, q = _written(r.join(of_chunk, "block"), "references"), _written(q, "queries")
        sent = q.sparkSession.sparkContext.broadcast(cells)
        q_names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in q.schema)

        def home(batches):
            for pdf in batches:
                if len(pdf):
                    c = sent.value
                    bound = c.lower_bounds(_matrix(pdf["__v"]))
                    # of blocks that may hold the query itself, that of the nearest pivot
                    far = _distances(_matrix(pdf["__v"]), c.pivots)[:, c.cell]
                    best = np.where(bound <= bound.min(1, keepdims=True), far, np.inf).argmin(1)
                    pdf["block"] = c.keys()[best].astype(np.int32)
                    yield pdf

        at_home = _written(q.mapInPandas(home, q_names + ", block int"), "home")
        of_block = dict(zip(cells.keys().tolist(), cells.size.tolist()))
        near = _written(_pairs(at_home, r.drop("chunk"), of_block, "block", block, schema, group), "near")
        w = Window.partitionBy("qid").orderBy("dist2")
        bounds = (near.select("qid", "dist2").withColumn("place", F.row_number().over(w)).where(F.col("place") == k)
                  .select("qid", F.sqrt("dist2").alias("bound")))

        def others(batches):
            for pdf in batches:
                if len(pdf):
                    c = sent.value
                    keys, home_block, limit = c.keys(), pdf["block"].to_numpy(), pdf["bound"].to_numpy()
                    asks = [np.flatnonzero((b <= m) & (keys != h))
                            for i in range(0, len(pdf), 64)
                            for b, m, h in zip(c.lower_bounds(_matrix(pdf["__v"][i:i + 64])), limit[i:i + 64], home_block[i:i + 64])]
                    pdf["blocks"] = [keys[x].astype(np.int32) for x in asks]
                    pdf["chunks"] = [np.unique(chunks[x]) for x in asks]
                    yield pdf.rename(columns={"block": "home"})

        # a query with fewer than k references at home is sent everywhere
        asked = at_home.join(bounds, "qid", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        asked = asked.select(*at_home.columns, "bound").mapInPandas(others, q_names + ", home int, bound double, blocks array<int>, chunks array<int>")
        visits = at_home.select("qid", "block").union(asked.select("qid", F.explode("blocks").alias("block")))
        # each query once, with the chunks it asks; it is multiplied on its way into the join only
        asked = _written(asked.drop("blocks"), "away")
        away = asked.withColumn("chunk", F.explode("chunks")).drop("chunks")
        sizes: dict[int, int] = {}
        for c, size in zip(chunks.tolist(), cells.size.tolist()):
            sizes[c] = sizes.get(c, 0) + size
        found = near.union(_pairs(away, r, sizes, "chunk", most, schema, chunk_group))
    w = Window.partitionBy("qid").orderBy(F.col("dist2").asc(), F.col("rid").asc())
    top = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    top = top.select(F.col("qid").alias(q_id), F.col("rank").cast("int").alias("rank"), F.col("rid").alias(f"nn_{r_id}"),
                     "dist2", *[F.col(f"c__{c}").alias(c) for c in carry])
    sizes = visits.sparkSession.createDataFrame([(int(b), int(m)) for b, m in zip(cells.keys(), cells.size)], "block int, bn long")
    visits = visits.join(F.broadcast(sizes), "block").groupBy(F.col("qid").alias(q_id)).agg(
        F.count(F.lit(1)).alias("blocks"), F.lit(len(cells.size)).cast("long").alias("of_blocks"), F.sum("bn").alias("pairs"), F.lit(n).cast("long").alias("of_pairs"))
    return top, visits


def knn_regress(nb: DataFrame, q_id: str, target: str, weights: str = "uniform") -> DataFrame:
    """Mean of the neighbours' targets; ``distance`` weights 1/d and an
    exact hit (d = 0) takes the plain mean of the hits."""
    d = F.sqrt(F.col("dist2"))
    if weights == "uniform":
        return nb.groupBy(q_id).agg(F.avg(target).alias("pred"))
    g = nb.groupBy(q_id).agg(F.sum(F.when(d == 0, F.col(target))).alias("__hs"), F.count_if(d == 0).alias("__hn"),
                             F.sum(F.when(d > 0, F.col(target) / d)).alias("__ws"), F.sum(F.when(d > 0, 1.0 / d)).alias("__w"))
    return g.select(q_id, F.when(F.col("__hn") > 0, F.col("__hs") / F.col("__hn")).otherwise(F.col("__ws") / F.col("__w")).alias("pred"))


def knn_classify(nb: DataFrame, q_id: str, label: str, weights: str = "uniform") -> DataFrame:
    """Weighted vote; ties go to the lowest class."""
    d = F.sqrt(F.col("dist2"))
    if weights == "uniform":
        w = F.lit(1.0)
    else:
        hit = F.max((d == 0).cast("int")).over(Window.partitionBy(q_id))
        nb = nb.withColumn("__hit", hit)
        w = F.when(F.col("__hit") == 1, (d == 0).cast("double")).otherwise(1.0 / d)
    votes = nb.withColumn("__w", w).groupBy(q_id, label).agg(F.sum("__w").alias("__s"))
    return votes.groupBy(q_id).agg(F.min_by(label, F.struct(-F.col("__s"), F.col(label))).alias("pred"))
