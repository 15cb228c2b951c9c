"""Forest classifier (L4): a fitted forest as a table whose leaves hold class shares, scored by vote and by probability.

The table's size is bounded by trees x 2^(depth+1) and checked; its arrays are
sent to the tasks, which walk all rows of a batch down a tree together, so rows
are scored where they are, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

NODE_LIMIT = 2_000_000


def fit_forest_classifier(df: DataFrame, features: str, label: str, path: str, trees: int = 30, depth: int = 6, seed: int = 42) -> DataFrame:
    """The node table of a forest fitted on an array column and an integer label from 0; rows with a null in either are left out.

    Columns: tree_id, node_id, feature, threshold, left, right (-1 in a leaf),
    shares (of each class among the training rows there).
    """
    d = df.select(F.transform(features, lambda v: v.cast("double")).alias("x"), F.col(label).cast("double").alias("y"))
    d = d.where("x is not null and y is not null and not exists(x, v -> v is null or isnan(v))").withColumn("f", array_to_vector("x"))
    model = RandomForestClassifier(featuresCol="f", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=False).fit(d)
    return export_class_table(df.sparkSession, model, path)


def export_class_table(spark: SparkSession, model, path: str) -> DataFrame:
    """A fitted forest's nodes from Spark's own saved table."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, b: a + b)
    return spark.read.parquet(path.rstrip("/") + "/data").select(
        F.col("treeID").cast("int").alias("tree_id"), n["id"].cast("int").alias("node_id"), n["split"]["featureIndex"].cast("int").alias("feature"),
        F.try_element_at(n["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"), n["leftChild"].cast("int").alias("left"),
        n["rightChild"].cast("int").alias("right"), F.transform(n["impurityStats"], lambda v: v / total).alias("shares"))


@dataclass
class Forest:
    """The arrays of a node table; a tree's nodes stand together, its root first."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, nodes: DataFrame) -> "Forest":
        n = nodes.count()
        if n > NODE_LIMIT:
            raise ValueError(f"a forest of {n} nodes; at most {NODE_LIMIT} are sent to tasks")
        t = nodes.orderBy("tree_id", "node_id").toPandas()
        start = t.groupby("tree_id")["node_id"].transform("size").groupby(t["tree_id"]).first()
        roots = np.concatenate([[0], np.cumsum(start.to_numpy())])[:-1]
        base = np.repeat(roots, start.to_numpy())
        if not (t["node_id"].to_numpy() == np.arange(n) - base).all():
            raise ValueError("node ids must run from 0 in each tree")
        child = lambda c: np.where(t[c].to_numpy() < 0, -1, t[c].to_numpy() + base)
        return cls(roots, t["feature"].fillna(-1).to_numpy().astype(int), t["threshold"].fillna(0.0).to_numpy(), child("left"), child("right"),
                   np.stack(t["shares"].to_numpy()))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while (inner := self.left[at] >= 0).any():
            go = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
        return at

    def probabilities(self, leaves: np.ndarray) -> np.ndarray:
        return self.shares[leaves].mean(1)

    def votes(self, leaves: np.ndarray) -> np.ndarray:
        """Trees for each class; a tree's tie goes to the first."""
        best = self.shares[leaves].argmax(2)
        return np.stack([(best == c).sum(1) for c in range(self.shares.shape[1])], 1)


def score_forest(df: DataFrame, nodes: DataFrame, features: str) -> DataFrame:
    """``df`` with ``proba`` (mean leaf shares), ``votes`` (trees), ``pred`` and ``pred_vote`` (their first largest class).

    A row with a null or NaN feature has nulls in all four.
    """
    forest = df.sparkSession.sparkContext.broadcast(Forest.of(nodes))

    @F.pandas_udf("struct<proba:array<double>,votes:array<int>,pred:int,pred_vote:int>")
    def scored(vectors: pd.Series) -> pd.DataFrame:
        ok = np.array([v is not None and not np.isnan(np.asarray(v, float)).any() for v in vectors], bool)
        out = pd.DataFrame({c: pd.Series([None] * len(vectors), dtype=object) for c in ("proba", "votes", "pred", "pred_vote")})
        if ok.any():
            leaves = forest.value.leaves(np.stack([np.asarray(v, float) for v in vectors[ok]]))
            p, v = forest.value.probabilities(leaves), forest.value.votes(leaves)
            where = np.flatnonzero(ok)
            for name, values in (("proba", list(p)), ("votes", list(v)), ("pred", p.argmax(1).tolist()), ("pred_vote", v.argmax(1).tolist())):
                out[name] = pd.Series(values, index=where, dtype=object).reindex(range(len(vectors))).where(ok, None)
        return out

    # a null component reaches the tasks as NaN
    vector = F.transform(features, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    return df.withColumn("__s", scored(vector)).select(*df.columns, "__s.proba", "__s.votes", "__s.pred", "__s.pred_vote")
