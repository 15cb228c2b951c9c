"""Learners (L1-L5, L8-L10, L12, L13, K5, K9, K11, I10, I11, M3, M9, M10).

``pyspark.ml`` does the fitting wherever it means the same thing as the
reference; the penalty conventions are converted (trap 19).  Closed-form
learners (least squares on a few columns, shrunk means) are one aggregate
job plus a bounded solve on the driver, which keeps them exactly checkable.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame, Window, functions as F



def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# --- L1: least squares by one Gramian aggregate ------------------------------

def fit_ols_gram(df: DataFrame, x: Sequence[str], y: str, ridge: float = 0.0) -> dict:
    """L1/L2 closed form: one aggregate of all (p+1)² centred co-moments, then a
    (p x p) solve on the driver (bounded by the column count).  ``ridge`` adds
    alpha to the diagonal with an unpenalised intercept (the reference's
    penalty convention)."""
    cols = list(x)
    aggs = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)] + [F.avg(y).alias("m_y"), F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j >= i:
                aggs.append(F.covar_pop(a, b).alias(f"c_{i}_{j}"))
        aggs.append(F.covar_pop(a, y).alias(f"c_{i}_y"))
    r = df.agg(*aggs).first()
    p, n = len(cols), r["n"]
    S = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            S[i, j] = S[j, i] = r[f"c_{i}_{j}"]
    sxy = np.array([r[f"c_{i}_y"] for i in range(p)])
    beta = np.linalg.solve(S * n + ridge * np.eye(p), sxy * n)
    intercept = r["m_y"] - sum(beta[i] * r[f"m_{i}"] for i in range(p))
    return {"coef": dict(zip(cols, beta.tolist())), "intercept": float(intercept), "n": n}


def predict_linear(df: DataFrame, model: dict, out: str = "pred") -> DataFrame:
    e = F.lit(model["intercept"])
    for c, b in model["coef"].items():
        e = e + F.lit(b) * F.col(c)
    return df.withColumn(out, e)


# --- L1-L5 / L9 / L10 via pyspark.ml ----------------------------------------

def regressor(name: str, **kw):
    """Name -> estimator registry (the reference's model factory dict)."""
    if name == "ols":
        return LinearRegression(solver="normal", regParam=0.0, **kw)
    if name == "ridge":
        return LinearRegression(solver="normal", elasticNetParam=0.0, standardization=False, **kw)
    if name == "tree":
        return DecisionTreeRegressor(maxDepth=kw.pop("maxDepth", 10), seed=42, **kw)
    if name == "forest":
        return RandomForestRegressor(numTrees=kw.pop("numTrees", 50), maxDepth=kw.pop("maxDepth", 10), seed=42, **kw)
    if name == "boosted":
        return GBTRegressor(maxIter=kw.pop("maxIter", 30), maxDepth=kw.pop("maxDepth", 5), stepSize=kw.pop("stepSize", 0.1),
                            subsamplingRate=kw.pop("subsamplingRate", 0.8), seed=42, **kw)
    raise KeyError(name)


def ridge_reg_param(df: DataFrame, y: str, alpha: float) -> float:
    """Trap 19: Spark scales the L2 penalty by the label std even without
    standardisation; alpha on sum of squares = regParam * n / sigma_pop(y)."""
    r = df.agg(F.stddev_pop(y).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return alpha * r["s"] / r["n"]


def fit_majority(df: DataFrame, label: str):
    """The most frequent class (smallest on ties), as a literal."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("m")).first()["m"]


# --- I10: out-of-fold prediction --------------------------------------------

def oof_predict(df: DataFrame, estimator, fold: str, k: int, keep: Sequence[str], score_col: str = "prediction") -> DataFrame:
    """Each fold scored by a model that never saw it; folds unioned.
    The base table should be cached by the caller (it is read k times)."""
    outs = []
    for i in range(k):
        m = estimator.fit(df.where(F.col(fold) != i))
        outs.append(m.transform(df.where(F.col(fold) == i)).select(*keep, fold, score_col))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def oof_simple_ols(df: DataFrame, x: str, y: str, fold: str) -> DataFrame:
    """I10 closed form: per-fold sums once; fold i's line is fitted on the
    complement (totals minus part i) and applied to fold i — every fold in one
    pass, no refit loop."""
    parts = df.groupBy(fold).agg(F.count(F.col(x) + F.col(y)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
                                 F.sum(F.col(x) * F.col(x)).alias("sxx"), F.sum(F.col(x) * F.col(y)).alias("sxy"))
    w = Window.partitionBy(F.lit(1))
    comp = parts.select(fold, *[(F.sum(c).over(w) - F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    comp = comp.withColumn("slope", (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") ** 2))
    comp = comp.withColumn("intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n"))
    return df.join(F.broadcast(comp.select(fold, "slope", "intercept")), fold).withColumn(   # one row per fold
        "pred", F.col("intercept") + F.col("slope") * F.col(x)).drop("slope", "intercept")


# --- K5: k-means centres with restarts ---------------------------------------

def fit_kmeans_restarts(df: DataFrame, features: str, k: int, restarts: int = 10, weight: str | None = None,
                        seed: int = 42) -> list[list[float]]:
    """K5: the best of ``restarts`` k-means runs (lowest training cost)."""
    best = None
    for r in range(restarts):
        km = KMeans(k=k, seed=seed + r, featuresCol=features, maxIter=50)
        if weight:
            km = km.setWeightCol(weight)
        m = km.fit(df)
        cost = m.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, [c.tolist() for c in m.clusterCenters()])
    return best[1]


# --- K9 / M9: importances -----------------------------------------------------

def importance_table(spark, names: Sequence[str], values) -> DataFrame:
    """M9: importances as a (feature, importance) table (bounded by columns)."""
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


def select_by_importance(imp: DataFrame, threshold: float | None = None) -> DataFrame:
    """K9: keep features whose importance >= the median importance (or an
    absolute threshold); report survivors / total."""
    if threshold is None:
        thr = imp.agg(F.median("importance")).first()[0]     # one row per feature: bounded
    else:
        thr = threshold
    n = imp.count()
    return imp.withColumn("kept", (F.col("importance") >= F.lit(thr)).cast("int")).withColumn("n_total", F.lit(n))


# --- M10: permutation importance --------------------------------------------

def permute_column(df: DataFrame, key: str, col: str, seed: int) -> DataFrame:
    """Replace ``col`` by its value at a seeded permutation of the rows: the
    row at position p (key order) receives the value of the row at position p
    in seeded-hash order.  A join on position, no driver round trip."""
    from foldsafe.operators.positions import hash_positions, ordered_positions
    a = ordered_positions(df, key, out="__p")
    b = hash_positions(df.select(key, col), key, seed, out="__p").select("__p", F.col(col).alias("__perm"))
    return a.join(b, "__p").drop(col, "__p").withColumnRenamed("__perm", col)


def learning_curve_verdict(gap, val, gap_max: float = 0.05, val_max: float = 0.55):
    """I11 verdict: gap > 0.05 overfit, else validation > 0.55 underfit, else calibrated."""
    return F.when(gap > gap_max, "overfit").when(val > val_max, "underfit").otherwise("calibrated")
