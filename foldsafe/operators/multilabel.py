"""Multi-label / multi-output kNN votes and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def knn_multilabel_vote(nb: DataFrame, labels: DataFrame, q_id: str, label_col: str = "labels") -> DataFrame:
    """Per label, the majority of the k neighbours' 0/1 labels."""
    nn = labels.select(F.col(q_id).alias(f"nn_{q_id}"), F.posexplode(label_col).alias("label_idx", "y"))
    v = nb.join(nn, f"nn_{q_id}").groupBy(q_id, "label_idx").agg(
        (F.sum("y") * 2 > F.count(F.lit(1))).cast("int").alias("p"))
    return v.groupBy(q_id).agg(F.array_sort(F.collect_list(F.struct("label_idx", "p"))).alias("__s")).select(
        q_id, F.transform("__s", lambda s: s["p"]).alias("pred"))


def eval_multilabel_f1(df: DataFrame, real: str, pred: str):
    """Per-label F1 with support, then macro and support-weighted F1."""
    e = df.select(F.posexplode(F.arrays_zip(F.col(real).alias("y"), F.col(pred).alias("p"))).alias("label_idx", "z"))
    per = e.groupBy("label_idx").agg(
        F.sum(F.col("z.y") * F.col("z.p")).alias("tp"), F.sum((1 - F.col("z.y")) * F.col("z.p")).alias("fp"),
        F.sum(F.col("z.y") * (1 - F.col("z.p"))).alias("fn"), F.sum(F.col("z.y")).cast("bigint").alias("support"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)))
    per = per.withColumn("label_idx", F.col("label_idx").cast("int"))
    summ = per.agg(F.round(F.avg("f1"), 6).alias("macro_f1"),
                   F.round(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), 6).alias("weighted_f1"))
    return per, summ


def knn_multioutput_mode(nb: DataFrame, vectors: DataFrame, q_id: str, vec: str) -> DataFrame:
    """Per element, the most frequent neighbour value (smallest on ties);
    the result vector is rebuilt in element order (bounded by its length)."""
    nn = vectors.select(F.col(q_id).alias(f"nn_{q_id}"), F.col(vec).alias("__x"))
    g = nb.select(q_id, f"nn_{q_id}").join(nn, f"nn_{q_id}").where(F.size("__x") > 0).groupBy(q_id).agg(F.collect_list("__x").alias("__xs"))

    def mode(i):
        values = F.transform(F.filter("__xs", lambda x: F.size(x) > i), lambda x: F.get(x, i))
        votes = F.transform(values, lambda v: F.struct((-F.size(F.filter(values, lambda u: u.eqNullSafe(v)))).alias("n"), v.alias("v")))
        return F.array_min(votes)["v"]

    longest = F.array_max(F.transform("__xs", lambda x: F.size(x)))
    return g.select(q_id, F.transform(F.sequence(F.lit(0), longest - 1), mode).alias("denoised"))
