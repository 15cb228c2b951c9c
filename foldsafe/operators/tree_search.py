"""Search over trees, forests and boosting by histogram tables.

All candidates of a search, on all folds, grow together, level by level.  One pass
over the binned rows counts a table (tree, node, feature, bin) -> rows, target sum:
every task adds up its own cells and Spark sums them.  Running sums over the bins
give each node its best cut, and only these cuts, one row a node, reach the driver.
A tree is a few arrays sent to the next pass, which finds each row's node anew, so
no state of the rows is kept between passes and a lost task is simply run again.

Targets and residuals are counted in whole units of ``unit``; their sums are exact
integers, so cuts do not depend on how the rows are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.functions.keys import seeded_hash
from foldsafe.operators.quantiles import exact_quantiles

KINDS = ("tree", "forest", "boosted")
CELLS = 8_000_000              # cells that one task counts in a pass; more growing nodes take more passes
NODE_LIMIT = 5_000_000         # nodes of all trees of a search, which the driver and the tasks hold
# Cumulated Poisson(1) probabilities up to 9, the rows of a bootstrap sample.
BOOTSTRAP = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(10)])


@dataclass(frozen=True)
class Candidate:
    """One point of the search space.

    ``trees`` are the members of a forest or the rounds of boosting.  A forest's
    members see bootstrap samples (Poisson weights); ``subsample`` is the share of
    rows that each round of boosting sees; ``max_features`` the share of the
    features that each node may cut.
    """

    key: str
    kind: str = "tree"
    max_depth: int = 5
    min_leaf: int = 1
    min_split: int = 2
    trees: int = 1
    rate: float = 0.1
    subsample: float = 1.0
    max_features: float = 1.0

    def __post_init__(self):
        if self.kind not in KINDS or self.max_depth < 0 or self.min_leaf < 1 or self.trees < 1 or not 0 < self.subsample <= 1 or not 0 < self.max_features <= 1:
            raise ValueError(f"no valid candidate: {self}")


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` -1 is a leaf, bins up to ``cut`` go left."""

    seed: int
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    growing: list = field(default_factory=lambda: [0])

    def arrays(self) -> tuple:
        return tuple(map(np.array, (self.feature, self.cut, self.left, self.right, self.value)))

    def add(self, value: float) -> int:
        for column, v in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, value)):
            column.append(v)
        return len(self.feature) - 1


@dataclass
class Model:
    """A candidate's trees, fitted on the rows of all folds but ``without_fold`` (None: on all rows)."""

    candidate: Candidate
    without_fold: int | None
    base: float = 0.0
    trees: list = field(default_factory=list)

    def sent(self) -> tuple:
        c = self.candidate
        share = c.rate if c.kind == "boosted" else 1.0 / max(len(self.trees), 1)
        return self.without_fold, self.base, share, [t.arrays() for t in self.trees]


def _walk(bins: np.ndarray, tree: tuple) -> np.ndarray:
    """The leaf of every row."""
    feature, cut, left, right, _ = tree
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while len(rows):
        at = node[rows]
        inner = feature[at] >= 0
        rows, at = rows[inner], at[inner]
        node[rows] = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])
    return node


def _predict(bins: np.ndarray, model: tuple) -> np.ndarray:
    _, base, share, trees = model
    out = np.full(len(bins), base)
    for t in trees:
        out += share * t[4][_walk(bins, t)]
    return out


def _draw(row_hash: np.ndarray, seed: int) -> np.ndarray:
    """A uniform number of each row and tree, the same wherever and however often the row is read."""
    with np.errstate(over="ignore"):
        z = row_hash.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 32) -> dict[str, list[float]]:
    """The cut points of every feature, its distinct exact quantiles i / bins.  They come
    from the features of all rows and know nothing of the target."""
    out = {f: set() for f in features}
    finite = df.select(*[F.when(F.isnan(F.col(f).cast("double")), None).otherwise(F.col(f).cast("double")).alias(f) for f in features])
    for r in exact_quantiles(finite, features, [i / bins for i in range(1, bins)], discrete=True).collect():   # features x bins rows
        if r["value"] is not None:
            out[r["column"]].add(r["value"])
    return {f: sorted(v) for f, v in out.items()}


def _bins(edges: dict[str, list[float]]) -> Column:
    def bin_of(f):
        v = F.col(f).cast("double")
        inside = F.size(F.filter(F.array(*map(F.lit, edges[f])).cast("array<double>"), lambda e: v > e)) + 1
        return F.when(v.isNull() | F.isnan(v), 0).otherwise(inside).cast("smallint")
    return F.array(*map(bin_of, edges))


def bin_rows(df: DataFrame, edges: dict[str, list[float]], key: str, fold: str, target: str, unit: float, seed: int = 42) -> DataFrame:
    """Rows as ``row_hash, fold, y, bins``: bin 0 for null and NaN, else 1 + the cut points below the value.
    Rows with a null or non-finite target or a null fold take no part."""
    d = df.withColumn("__y", F.col(target).cast("double"))
    d = d.where(F.col(fold).isNotNull() & F.col("__y").isNotNull() & ~F.isnan("__y") & (F.abs("__y") < float("inf")))
    whole = F.when(F.abs("__y") < float("inf"), F.rint(F.col("__y") / unit)).cast("long")     # the cast may come before the filter
    return d.select(seeded_hash(key, seed).alias("row_hash"), F.col(fold).cast("long").alias("fold"), whole.alias("y"), _bins(edges).alias("bins"))


def _read(batch) -> tuple:
    """Row hashes, folds, targets and the bins as a matrix."""
    n = batch.num_rows
    return (*[np.asarray(batch.column(i)) for i in range(3)], np.asarray(batch.column(3).flatten()).reshape(n, -1).astype(np.int64))


def _cells(rows: DataFrame, growing: list[tuple[int, Model, Tree]], features: int, bins: int, seed: int) -> tuple[DataFrame, Broadcast]:
    """The histogram table of the growing nodes: g, node, feature, bin -> n, s, and the bounds of g's cuts; and what the tasks were sent."""
    sent = []
    for g, m, t in growing:
        c = m.candidate
        take = math.ceil(c.max_features * features)
        allowed = np.zeros((len(t.growing), features), bool)
        for i, node in enumerate(t.growing):
            allowed[i, np.random.default_rng([seed, t.seed, node]).permutation(features)[:take]] = True
        before = Model(c, m.without_fold, m.base, m.trees[:-1]) if c.kind == "boosted" else None
        sent.append((g, m.without_fold, c, t.seed, t.arrays(), np.array(t.growing), allowed, before.sent() if before else None))
    shared = rows.sparkSession.sparkContext.broadcast(sent)

    def run(batches):
        total = [np.zeros((2, len(nodes) * features * bins), np.int64) for _, _, _, _, _, nodes, _, _ in shared.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            row_hash, fold, y, x = _read(batch)
            for (g, without, c, tree_seed, tree, nodes, _, before), out in zip(shared.value, total):
                weight = np.ones(len(y), np.int64) if without is None else (fold != without).astype(np.int64)
                if c.kind == "forest":
                    weight *= np.searchsorted(BOOTSTRAP, _draw(row_hash, tree_seed), side="right")
                elif c.kind == "boosted" and c.subsample < 1:
                    weight *= _draw(row_hash, tree_seed) < c.subsample
                used = np.flatnonzero(weight)
                slot = np.full(len(tree[0]), -1)
                slot[nodes] = np.arange(len(nodes))
                at = slot[_walk(x[used], tree)]
                used, at = used[at >= 0], at[at >= 0]
                left = y[used] if before is None else np.rint(y[used] - _predict(x[used], before)).astype(np.int64)
                cell = ((at[:, None] * features + np.arange(features)) * bins + x[used]).ravel()
                np.add.at(out[0], cell, np.repeat(weight[used], features))
                np.add.at(out[1], cell, np.repeat(weight[used] * left, features))
        for (g, _, c, _, _, nodes, allowed, _), out in zip(shared.value, total):
            at = np.flatnonzero(out[0])
            node, f, b = np.unravel_index(at, (len(nodes), features, bins))
            fine = allowed[node, f]
            at, node, f, b = at[fine], node[fine], f[fine], b[fine]
            yield pa.RecordBatch.from_pydict({
                "g": pa.array(np.full(len(at), g), pa.int64()), "node": pa.array(nodes[node], pa.int64()), "feature": pa.array(f, pa.int32()),
                "bin": pa.array(b, pa.int32()), "min_leaf": pa.array(np.full(len(at), c.min_leaf), pa.int64()),
                "min_split": pa.array(np.full(len(at), c.min_split), pa.int64()), "n": out[0][at], "s": out[1][at]})

    schema = "g long, node long, feature int, bin int, min_leaf long, min_split long, n long, s long"
    # a task has added up its rows; one exchange by node serves the sums, the running sums and the choice of cuts
    cells = rows.mapInArrow(run, schema).repartition("g", "node").groupBy("g", "node", "feature", "bin", "min_leaf", "min_split")
    return cells.agg(F.sum("n").alias("n"), F.sum("s").alias("s")), shared


def best_cuts(cells: DataFrame) -> DataFrame:
    """Per (g, node): its rows and sum, and the cut that lowers the squared error most (null: none does),
    ties to the first feature and bin, with the rows and sum on its left."""
    part = Window.partitionBy("g", "node", "feature")
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    c = cells.select("*", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"),
                     F.sum("n").over(part).alias("nt"), F.sum("s").over(part).alias("st"))
    nl, nt, sl, st = (F.col(k).cast("double") for k in ("nl", "nt", "sl", "st"))
    c = c.withColumn("gain", F.when(F.col("nl") < F.col("nt"), sl * sl / nl + (st - sl) * (st - sl) / F.nullif(nt - nl, F.lit(0.0))))
    able = (F.col("gain") > st * st / nt * (1 + 1e-12)) & (F.col("nt") >= F.col("min_split"))
    able = able & (F.col("nl") >= F.col("min_leaf")) & (F.col("nt") - F.col("nl") >= F.col("min_leaf"))
    best = F.max(F.when(able, F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "nl", "sl")))
    return c.groupBy("g", "node").agg(F.max("nt").alias("n"), F.max("st").alias("s"), best.alias("best"))


def _grow(rows: DataFrame, live: list[tuple[Model, Tree]], width: int, bins: int, seed: int) -> None:
    """Grow the trees of ``live`` to their ends, one pass a level for all of them together."""
    depth = 0
    while True:
        growing = [(g, m, t) for g, (m, t) in enumerate(live) if t.growing]
        if not growing:
            return
        while growing:
            part, cells = [], 0
            while growing and (not part or cells + len(growing[0][2].growing) * width * bins <= CELLS):
                part.append(growing.pop(0))
                cells += len(part[-1][2].growing) * width * bins
            trees = {g: (m, t) for g, m, t in part}
            grown = {g: [] for g in trees}
            table, shared = _cells(rows, part, width, bins, seed)
            cuts = best_cuts(table).collect()                                          # one row a growing node
            shared.destroy()
            for r in cuts:
                m, t = trees[r["g"]]
                node, best = r["node"], r["best"]
                t.value[node] = r["s"] / r["n"]
                if best is None or depth >= m.candidate.max_depth:
                    continue
                t.feature[node], t.cut[node] = -best["f"], -best["b"]
                t.left[node] = t.add(best["sl"] / best["nl"])
                t.right[node] = t.add((r["s"] - best["sl"]) / (r["n"] - best["nl"]))
                grown[r["g"]] += [t.left[node], t.right[node]]
            for g, (m, t) in trees.items():
                t.growing = sorted(grown[g]) if depth + 1 < m.candidate.max_depth else []
        if sum(len(t.feature) for _, t in live) > NODE_LIMIT:
            raise ValueError(f"the search's trees have over {NODE_LIMIT} nodes: lower max_depth or raise min_leaf")
        depth += 1


def fit_candidates(rows: DataFrame, candidates: Sequence[Candidate], folds: Sequence[int | None], width: int, bins: int, seed: int = 42) -> list[Model]:
    """Every candidate fitted without each of the folds, on rows of :func:`bin_rows`.

    Trees and whole forests grow in the first round, boosting adds one tree a round;
    the search takes max(rounds) x max(depth) passes, whatever the number of candidates
    and folds.  A model without training rows has no trees and predicts 0.
    """
    per_fold = {r["fold"]: (r["n"], r["s"]) for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect()}
    models = []
    for c in candidates:
        for f in folds:
            n, s = (sum(v[i] for k, v in per_fold.items() if f is None or k != f) for i in (0, 1))
            models.append((Model(c, f, s / n if n and c.kind == "boosted" else 0.0), n))
    models, trained = [m for m, _ in models], [m for m, n in models if n]
    for step in range(max((m.candidate.trees for m in trained if m.candidate.kind == "boosted"), default=1)):
        live = []
        for m in trained:
            c = m.candidate
            new = {"tree": int(step == 0), "forest": c.trees * (step == 0), "boosted": int(step < c.trees)}[c.kind]
            for _ in range(new):
                m.trees.append(Tree(len(m.trees)))
                live.append((m, m.trees[-1]))
        _grow(rows, live, width, bins, seed)
    return models


def score_folds(rows: DataFrame, models: Sequence[Model], unit: float) -> DataFrame:
    """Candidate x fold: root mean squared error of each model on the fold it has not seen; one pass for all."""
    sent = rows.sparkSession.sparkContext.broadcast([(m.candidate.key, m.sent()) for m in models if m.trees])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            _, fold, y, x = _read(batch)
            out = []
            for key, model in sent.value:
                held = fold == model[0]
                if held.any():
                    error = (y[held] - _predict(x[held], model)) * unit
                    out.append((key, int(model[0]), int(held.sum()), float((error * error).sum())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["cand_key", "fold", "n", "se"])

    parts = rows.mapInArrow(run, "cand_key string, fold long, n long, se double")
    return parts.groupBy("cand_key", "fold").agg(F.sqrt(F.sum("se") / F.sum("n")).alias("rmse"), F.sum("n").alias("n")).select(
        "cand_key", F.col("fold").cast("int").alias("fold"), "rmse", "n")


def predict_rows(df: DataFrame, edges: dict[str, list[float]], model: Model, unit: float, out: str = "pred") -> DataFrame:
    """``df`` with the model's prediction, as one expression over literal node arrays per tree."""
    bins = _bins(edges)
    _, base, share, trees = model.sent()

    def value(tree: tuple) -> Column:
        nodes = F.array(*[F.struct(F.lit(int(f)).alias("f"), F.lit(int(c)).alias("c"), F.lit(int(lo)).alias("lo"), F.lit(int(hi)).alias("hi"), F.lit(float(v)).alias("v"))
                          for f, c, lo, hi, v in zip(*tree)])

        def step(at, _):
            here = F.get(nodes, at)
            return F.when(here["f"] < 0, at).when(F.get(bins, here["f"]) <= here["c"], here["lo"]).otherwise(here["hi"])

        levels = F.sequence(F.lit(1), F.lit(max(model.candidate.max_depth, 1)))
        return F.get(nodes, F.aggregate(levels, F.lit(0), step))["v"]

    total = sum((float(share) * value(t) for t in trees), F.lit(float(base)))
    return df.withColumn(out, total * F.lit(float(unit)))


def search_trees(df: DataFrame, candidates: Sequence[Candidate], features: Sequence[str], key: str, fold: str, target: str,
                 unit: float, bins: int = 32, seed: int = 42) -> DataFrame:
    """M1 over trees, forests and boosting: candidate x fold with the root mean squared error on the fold.

    Fold 0 of one fold only has nothing to be fitted on, and so no row; nor has an
    empty table.  Features may be null or NaN, which have a bin of their own.
    """
    if len({c.key for c in candidates}) < len(candidates):
        raise ValueError("candidates must have keys of their own")
    edges = bin_edges(df, features, bins)
    rows = bin_rows(df, edges, key, fold, target, unit, seed).persist()
    try:
        folds = [r["fold"] for r in rows.select("fold").distinct().orderBy("fold").collect()]
        models = fit_candidates(rows, candidates, folds, len(features), bins + 1, seed)
        out = score_folds(rows, models, unit).collect()                # candidates x folds rows
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(out, "cand_key string, fold int, rmse double, n long")


def refit(df: DataFrame, candidate: Candidate, features: Sequence[str], key: str, fold: str, target: str, unit: float,
          bins: int = 32, seed: int = 42) -> tuple[dict[str, list[float]], Model]:
    """M8: the chosen candidate on all rows, with the cut points that :func:`predict_rows` needs."""
    edges = bin_edges(df, features, bins)
    rows = bin_rows(df, edges, key, fold, target, unit, seed).persist()
    try:
        return edges, fit_candidates(rows, [candidate], [None], len(features), bins + 1, seed)[0]
    finally:
        rows.unpersist()
