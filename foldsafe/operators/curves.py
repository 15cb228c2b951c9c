"""Confusion matrices and threshold curves.

The PR/ROC curves need running counts over all distinct scores.  An
unpartitioned window would pull every score into one task, so the running
sum is two-level (F4): distinct scores are cut into ranges whose number
follows theirs (``ranges``), per-range totals are cumulated to offsets, and
the window runs per range.  The result does not depend on the cut points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from foldsafe.operators.ranges import ROWS_PER_RANGE, Key, elastic_ranges


def class_labels(df: DataFrame, cols: Sequence[str], max_labels: int = 10000) -> list:
    """Distinct class labels over the given columns (a bounded constant)."""
    u = None
    for c in cols:
        x = df.select(F.col(c).alias("l"))
        u = x if u is None else u.union(x)
    got = [r[0] for r in u.distinct().limit(max_labels + 1).collect()]
    if len(got) > max_labels:
        raise ValueError("too many classes for a confusion matrix")
    return sorted(got, key=lambda v: (v is None, v))


def eval_confusion(df: DataFrame, real: str, pred: str, labels: Sequence | None = None) -> DataFrame:
    """K x k counts including empty cells (row = real, col = pred).

    The cell grid comes from the class list (bounded by k²) and is
    left-joined to the grouped counts; no data row is paired with another."""
    counts = df.groupBy(F.col(real).alias("real"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    labels = list(labels) if labels is not None else class_labels(df, [real, pred])
    typ = df.schema[real].dataType.simpleString()
    grid = df.sparkSession.createDataFrame([(a, b) for a in labels for b in labels], f"real {typ}, pred {typ}")
    c = counts.toDF("__real", "__pred", "n")
    same = F.col("real").eqNullSafe(F.col("__real")) & F.col("pred").eqNullSafe(F.col("__pred"))
    return grid.join(c, same, "left").select("real", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def eval_confusion_norm(conf: DataFrame) -> DataFrame:
    """Row-normalised rates, diagonal zeroed (off-diagonal error rates)."""
    w = Window.partitionBy("real")
    rate = F.try_divide(F.col("n").cast("double"), F.sum("n").over(w))
    return conf.withColumn("rate", F.when(F.col("real") == F.col("pred"), F.lit(0.0)).otherwise(F.coalesce(rate, F.lit(0.0))))


def score_table(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with their positive and negative counts (map-side combined)."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label).cast("long"))).alias("neg"))


def suffix_counts(st: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """for every distinct score, positives and negatives with score >= it
    (``tp``, ``fp``) and the totals P, N — a distributed suffix sum."""
    order = Key("score", descending=True)
    d = elastic_ranges(st, [], [order], "__rid", rows_per_range)
    tot = d.groupBy("__rid").agg(F.sum("pos").alias("__rp"), F.sum("neg").alias("__rn"))
    before = Window.orderBy("__rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(F.lit(1))
    tot = (tot.withColumn("__op", F.sum("__rp").over(before) - F.col("__rp"))
              .withColumn("__on", F.sum("__rn").over(before) - F.col("__rn"))
              .withColumn("P", F.sum("__rp").over(wall)).withColumn("N", F.sum("__rn").over(wall))
              .drop("__rp", "__rn"))
    d = d.join(tot, "__rid")
    w = Window.partitionBy("__rid").orderBy(order.sort()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (d.withColumn("tp", F.col("__op") + F.sum("pos").over(w))
             .withColumn("fp", F.col("__on") + F.sum("neg").over(w))
             .drop("__rid", "__op", "__on"))


def eval_pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, precision, recall) for each distinct score, plus the
    sentinel (NULL, 1, 0)."""
    s = suffix_counts(score_table(df, score, label))
    curve = s.select(F.col("score").alias("threshold"),
                     (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                     F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("P")), F.lit(0.0)).alias("recall"))
    sentinel = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return curve.unionByName(sentinel)


def eval_threshold_at_precision(curve: DataFrame, target: float) -> DataFrame:
    """The lowest threshold whose precision reaches the target, with its
    precision and recall; NULLs when only the sentinel qualifies."""
    q = curve.where(F.col("threshold").isNotNull() & (F.col("precision") >= F.lit(target)))
    return q.agg(F.min_by(F.struct("threshold", "precision", "recall"), "threshold").alias("b")).select(
        F.lit(target).alias("target"), F.col("b.threshold").alias("threshold"),
        F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"))


def eval_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """E14 points: (threshold, fpr, tpr) per distinct score."""
    s = suffix_counts(score_table(df, score, label))
    return s.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"))


def eval_roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """E14 area: trapezoids between consecutive distinct scores, i.e. the
    rank-sum AUC with ties counted half: sum over scores of
    neg_s * (positives above s + pos_s / 2) / (P * N)."""
    s = suffix_counts(score_table(df, score, label))
    contrib = F.col("neg") * ((F.col("tp") - F.col("pos")) + F.col("pos") / 2.0)
    return s.agg((F.sum(contrib) / (F.first("P") * F.first("N"))).alias("auc"),
                 F.first("P").alias("n_pos"), F.first("N").alias("n_neg"))
