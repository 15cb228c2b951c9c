"""Searches over trees by histogram tables: exhaustive splits in numpy, one pass a level, ensembles that learn."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldsafe.operators import tree_search as TS

SCHEMA = "id long, fold int, a double, b double, c int, y double"
FEATURES, UNIT, BINS = ["a", "b", "c"], 2.0 ** -20, 8


def frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), np.round(rng.normal(size=n), 1), rng.integers(0, 4, n)
    y = np.where(a > 0.3, 3.0, 0.0) + np.where((b > 0) & (c > 1), 2.0, 0.0) + rng.normal(size=n) * 0.2
    rows = [(i, i % 3, None if i % 17 == 0 else float(a[i]), float("nan") if i % 23 == 0 else float(b[i]), int(c[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def binned(df):
    edges = TS.bin_edges(df, FEATURES, BINS)
    rows = TS.bin_rows(df, edges, "id", "fold", "y", UNIT)
    got = [(r["fold"], r["y"], list(r["bins"])) for r in rows.collect()]
    return edges, rows, tuple(np.array(v) for v in zip(*got))


def exhaustive(x, y, held, depth, min_leaf, min_split=2):
    """Predictions of ``held`` by a tree that tries every cut of every feature."""
    mean = y.sum() / len(y)
    best = None
    if depth and len(y) >= min_split:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                nl, sl, n, s = float(left.sum()), float(y[left].sum()), float(len(y)), float(y.sum())
                if nl < min_leaf or n - nl < min_leaf:
                    continue
                gain = sl * sl / nl + (s - sl) * (s - sl) / (n - nl)
                if gain > s * s / n * (1 + 1e-12) and (best is None or gain > best[0]):
                    best = gain, f, cut
    if best is None:
        return np.full(len(held), mean)
    _, f, cut = best
    out, left, to = np.empty(len(held)), x[:, f] <= cut, held[:, f] <= cut
    out[to] = exhaustive(x[left], y[left], held[to], depth - 1, min_leaf, min_split)
    out[~to] = exhaustive(x[~left], y[~left], held[~to], depth - 1, min_leaf, min_split)
    return out


def test_every_candidate_equals_exhaustive_splits(spark):
    df = frame(spark)
    _, _, (fold, y, x) = binned(df)
    cands = [TS.Candidate(f"{d}:{leaf}:{split}", "tree", d, leaf, split) for d in (0, 1, 3, 5) for leaf in (1, 15) for split in (2, 60)]
    got = {(r["cand_key"], r["fold"]): (r["rmse"], r["n"]) for r in TS.search_trees(df, cands, FEATURES, "id", "fold", "y", UNIT, BINS).collect()}
    assert len(got) == 3 * len(cands)
    for c in cands:
        for f in range(3):
            p = exhaustive(x[fold != f], y[fold != f], x[fold == f], c.max_depth, c.min_leaf, c.min_split)
            rmse = np.sqrt((((y[fold == f] - p) * UNIT) ** 2).mean())
            assert got[c.key, f] == (pytest.approx(rmse, rel=1e-9), (fold == f).sum())


def test_boosting_equals_rounds_of_exhaustive_trees(spark):
    df = frame(spark)
    _, _, (fold, y, x) = binned(df)
    cand = TS.Candidate("b", "boosted", 2, 3, trees=3, rate=0.5)
    got = {r["fold"]: r["rmse"] for r in TS.search_trees(df, [cand], FEATURES, "id", "fold", "y", UNIT, BINS).collect()}
    for f in range(3):
        train, held = fold != f, fold == f
        at = np.full(len(y), y[train].sum() / train.sum())
        for _ in range(cand.trees):
            left = np.rint(y[train] - at[train]).astype(np.int64)
            at = at + cand.rate * exhaustive(x[train], left, x, cand.max_depth, cand.min_leaf)
        assert got[f] == pytest.approx(np.sqrt((((y - at)[held] * UNIT) ** 2).mean()), rel=1e-6)


def test_one_pass_a_level_and_more_passes_change_nothing(spark, monkeypatch):
    df = frame(spark)
    cands = [TS.Candidate(f"{d}", "tree", d) for d in (1, 2, 4)] + [TS.Candidate("f", "forest", 3, trees=3, max_features=0.7)]
    passes = []
    cells = TS._cells
    monkeypatch.setattr(TS, "_cells", lambda *a: passes.append(1) or cells(*a))
    once = sorted(TS.search_trees(df, cands, FEATURES, "id", "fold", "y", UNIT, BINS).collect())
    assert len(passes) == 4                                # the deepest candidate's levels
    monkeypatch.setattr(TS, "CELLS", 400)
    again = sorted(TS.search_trees(df.repartition(2), cands, FEATURES, "id", "fold", "y", UNIT, BINS).collect())
    assert len(passes) > 10 and [tuple(r)[:2] for r in once] == [tuple(r)[:2] for r in again]
    assert np.allclose([r["rmse"] for r in once], [r["rmse"] for r in again], rtol=1e-12)


def test_ensembles_learn_and_the_refit_predicts(spark):
    df = frame(spark, 1500)
    cands = [TS.Candidate("mean", max_depth=0), TS.Candidate("forest", "forest", 5, 3, trees=10, max_features=0.7),
             TS.Candidate("boosted", "boosted", 3, 5, trees=6, rate=0.5, subsample=0.7)]
    scores = TS.search_trees(df, cands, FEATURES, "id", "fold", "y", UNIT, BINS).groupBy("cand_key").agg(F.avg("rmse").alias("r")).collect()
    rmse = {r["cand_key"]: r["r"] for r in scores}
    assert rmse["forest"] < 0.6 * rmse["mean"] and rmse["boosted"] < 0.5 * rmse["mean"]
    edges, model = TS.refit(df, cands[2], FEATURES, "id", "fold", "y", UNIT, BINS)
    rows = TS.predict_rows(df, edges, model, UNIT).collect()
    assert len(rows) == 1500 and np.sqrt(np.mean([(r["pred"] - r["y"]) ** 2 for r in rows])) < 0.5 * rmse["mean"]
    _, _, (_, _, x) = binned(df)
    assert np.allclose(sorted(r["pred"] for r in rows), sorted(TS._predict(x, model.sent()) * UNIT))


def test_edges(spark):
    df = frame(spark)
    cands = [TS.Candidate("t", max_depth=2), TS.Candidate("b", "boosted", 2, trees=2)]
    search = lambda d: TS.search_trees(d, cands, FEATURES, "id", "fold", "y", UNIT, BINS)
    assert search(df.limit(0)).count() == 0
    assert search(df.where("fold = 0")).count() == 0      # nothing to be fitted on
    odd = spark.createDataFrame([(900, 1, 1.0, 1.0, 1, None), (901, 1, 1.0, 1.0, 1, float("nan")), (902, None, 1.0, 1.0, 1, 1.0)], SCHEMA)
    assert sum(r["n"] for r in search(df.union(odd)).collect()) == 2 * 400
    flat = df.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(1.0)).withColumn("c", F.lit(2))
    assert search(flat).count() == 6
    with pytest.raises(ValueError, match="keys"):
        TS.search_trees(df, [cands[0], cands[0]], FEATURES, "id", "fold", "y", UNIT)
    with pytest.raises(ValueError, match="no valid"):
        TS.Candidate("x", "svr")
