"""Many linear classifiers in one pass per step.

One-vs-rest, one-vs-one and out-of-fold fits are the same rows under different
labels.  A step reads the rows once: every task adds the loss, gradient and
Hessian sums of all models to one vector a model, Spark sums the vectors, and the
driver, which holds nothing but these bounded sums, takes a Newton step for each
model.  Models that have converged are left out of later steps.  Scores of all
models are one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

LOSSES = ("logistic", "squared_hinge")


@dataclass(frozen=True)
class Task:
    """One model: a positive class against a negative one (None: all others), on the rows of all folds but one."""

    name: str
    positive: int
    negative: int | None = None
    without_fold: int | None = None


def one_vs_rest_tasks(classes: Sequence[int]) -> list[Task]:
    return [Task(f"{c}", c) for c in classes]


def one_vs_one_tasks(classes: Sequence[int]) -> list[Task]:
    return [Task(f"{a}_{b}", b, a) for i, a in enumerate(classes) for b in classes[i + 1:]]


def out_of_fold_tasks(positive: int, folds: int) -> list[Task]:
    return [Task(f"fold{f}", positive, None, f) for f in range(folds)]


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, loss: str) -> np.ndarray:
    """Loss, gradient and Hessian (upper triangle) of rows with labels -1 and 1."""
    m = y * (x @ w)
    if loss == "logistic":
        value = np.logaddexp(0.0, -m).sum()
        p = np.exp(-np.logaddexp(0.0, m))          # 1 - P(own class)
        slope, curve = -y * p, p * (1.0 - p)
    else:
        short = np.maximum(0.0, 1.0 - m)
        value, slope, curve = (short * short).sum(), -2.0 * y * short, 2.0 * (short > 0)
    gradient, hessian = x.T @ slope, (x * curve[:, None]).T @ x
    return np.concatenate([[value], gradient, hessian[np.triu_indices(len(w))]])


def fit_linear(df: DataFrame, features: str, label: str, tasks: Sequence[Task], loss: str = "logistic", C: float = 1.0,
               fold: str | None = None, max_steps: int = 50, tol: float = 1e-10) -> dict[str, np.ndarray]:
    """Coefficients of every task's model, the last one the intercept, which carries no penalty.

    Each minimises C times the sum of the loss plus half the squared norm of its
    weights.  ``features`` is an array column, ``label`` an integer; rows with a null
    label, array or component take no part.  A task without rows of both kinds has
    weights of 0.  ``df`` is kept for the steps and let go of at the end.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    d = df.select(F.transform(features, lambda v: v.cast("double")).alias("x"), F.col(label).cast("long").alias("y"),
                  (F.col(fold).cast("long") if fold else F.lit(-1).cast("long")).alias("fold"))
    d = d.where("x is not null and y is not null and not exists(x, v -> v is null)").persist()
    try:
        width = (d.agg(F.max(F.size("x"))).first()[0] or 0) + 1
        upper = np.triu_indices(width)
        penalty = np.append(np.ones(width - 1), 0.0)
        weights = {t.name: np.zeros(width) for t in tasks}
        moves: dict[str, tuple] = {}               # of each model: where it stood, its loss there, direction, slope, share
        live = {t.name: t for t in tasks}
        for _ in range(max_steps):
            if not live:
                break
            sums = _step(d, list(live.values()), {n: weights[n] for n in live}, loss, width)
            for name in list(live):
                got = sums.get(name)
                if got is None or got[1] == 0 or got[2] == 0:     # no rows of one of the kinds
                    weights[name] = np.zeros(width)
                    del live[name]
                    continue
                w = weights[name]
                value = C * got[0] + 0.5 * (penalty * w * w).sum()
                if name in moves:
                    start, before, way, slope, share = moves[name]
                    if value > before + 1e-4 * share * slope and share > 1e-8:
                        moves[name] = (start, before, way, slope, share / 2)
                        weights[name] = start + share / 2 * way
                        continue
                gradient = C * got[3: 3 + width] + penalty * w
                hessian = np.zeros((width, width))
                hessian[upper] = C * got[3 + width:]
                hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty + 1e-12)
                way = -np.linalg.solve(hessian, gradient)
                slope = float(gradient @ way)
                if -slope <= tol * (1.0 + abs(value)):
                    weights[name] = w + way            # the last step, so small, leaves next to nothing
                    del live[name]
                    continue
                moves[name] = (w, value, way, slope, 1.0)
                weights[name] = w + way
        return weights
    finally:
        d.unpersist()


def _step(d: DataFrame, tasks: list[Task], weights: dict[str, np.ndarray], loss: str, width: int) -> dict[str, np.ndarray]:
    """Per task: loss, numbers of negative and positive rows, gradient and Hessian, summed over all rows."""
    sent = d.sparkSession.sparkContext.broadcast([(t, weights[t.name]) for t in tasks])
    size = 3 + width + width * (width + 1) // 2

    def run(batches):
        total = np.zeros((len(tasks), size))
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, ends = np.asarray(batch.column(0).flatten()), batch.column(0).offsets.to_numpy()
            x = np.zeros((batch.num_rows, width))
            lengths = np.diff(ends)
            x[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)] = flat
            x[:, -1] = 1.0
            y, fold = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for i, (t, w) in enumerate(sent.value):
                used = np.ones(len(y), bool) if t.negative is None else (y == t.positive) | (y == t.negative)
                if t.without_fold is not None:
                    used &= fold != t.without_fold
                mine = np.where(y[used] == t.positive, 1.0, -1.0)
                s = _sums(x[used], mine, w, loss)
                total[i] += np.concatenate([s[:1], [(mine < 0).sum(), (mine > 0).sum()], s[1:]])
        yield pa.RecordBatch.from_arrays([pa.array([t.name for t, _ in sent.value]), pa.array(list(total), pa.list_(pa.float64()))], ["task", "sums"])

    rows = d.mapInArrow(run, "task string, sums array<double>").withColumn("v", array_to_vector("sums"))
    summed = rows.groupBy("task").agg(Summarizer.metrics("sum").summary(F.col("v")).alias("s"))
    out = {r["task"]: np.array(r["a"]) for r in summed.select("task", vector_to_array("s.sum").alias("a")).collect()}
    sent.destroy()
    return out


def _number(x: float) -> Column:
    return F.lit(float(x))


def decisions(features: str, weights: dict[str, np.ndarray]) -> Column:
    """An array of the models' decision values, in the order of ``weights``; one expression."""
    models = F.array(*[F.array(*map(_number, w)) for w in weights.values()])

    def decision(w: Column) -> Column:
        dot = F.aggregate(F.zip_with(F.transform(features, lambda v: v.cast("double")), F.slice(w, F.lit(1), F.size(w) - 1), lambda a, b: a * b),
                          F.lit(0.0), lambda s, p: s + p)
        return dot + F.element_at(w, -1)

    return F.transform(models, decision)


def probability(decision: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-decision))


def vote(decision: Column, tasks: Sequence[Task], classes: Sequence[int]) -> Column:
    """The class with most one-vs-one votes, ties to the first."""
    won = F.zip_with(decision, F.array(*[F.struct(F.lit(t.positive).alias("p"), F.lit(t.negative).alias("n")) for t in tasks]),
                     lambda v, t: F.when(v > 0, t["p"]).otherwise(t["n"]))
    counts = F.transform(F.array(*map(F.lit, classes)), lambda c: F.size(F.filter(won, lambda x: x == c)))
    return F.element_at(F.array(*map(F.lit, classes)), F.array_position(counts, F.array_max(counts)).cast("int"))


def largest(decision: Column, classes: Sequence[int]) -> Column:
    """The one-vs-rest class of largest decision, ties to the first."""
    return F.element_at(F.array(*map(F.lit, classes)), F.array_position(decision, F.array_max(decision)).cast("int"))
