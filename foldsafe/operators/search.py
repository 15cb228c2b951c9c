"""Search bookkeeping.

The reference runs one search of <= 50 candidates at a time.  Here a search
is data: candidates are rows, fold results are rows, and every bookkeeping
step (cost projection, budget cut, resume, ranking, closing) is a grouped
operator keyed by ``search_id``, so one plan serves one search or millions.

Candidate evaluation uses single-pass folds: one grouped aggregate of
per-(fold, group) sums; the statistics of "every fold but i" are totals
minus part i; scoring a held-out fold is a join of a (fold, group)-row
constants table.  Candidates multiply rows only by the candidate count
(an ``explode`` of the bounded candidate list), never pairwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from foldsafe.functions.keys import seeded_uniform


def grid(spark: SparkSession, space: dict[str, Sequence]) -> DataFrame:
    """M1: Cartesian product of parameter lists as a candidate table built by
    successive explodes of literal arrays (size = product of list lengths)."""
    names = list(space)
    df = spark.range(1).select(*[F.explode(F.array(*[F.lit(v) for v in space[n]])).alias(n) for n in names[:1]])
    for n in names[1:]:
        df = df.withColumn(n, F.explode(F.array(*[F.lit(v) for v in space[n]])))
    return df


def random_draws(spark: SparkSession, n: int, seed: int, lists: dict[str, Sequence] | None = None,
                 log_uniform: dict[str, tuple[float, float]] | None = None,
                 exponential: dict[str, float] | None = None,
                 drop_when: dict[str, tuple[str, Sequence]] | None = None) -> DataFrame:
    """M2: n reproducible draws: uniform choice from lists, log-uniform in
    [a, b], exponential with a scale — each from a seeded hash of (draw, name).
    ``drop_when={param: (other, values)}`` sets ``param`` to NULL where
    ``other`` takes one of ``values`` (a parameter that does not apply, like
    gamma for a linear kernel)."""
    d = spark.range(n).withColumnRenamed("id", "draw")
    for name, vals in (lists or {}).items():
        u = seeded_uniform("draw", seed, name)
        d = d.withColumn(name, F.element_at(F.array(*[F.lit(v) for v in vals]), (F.floor(u * len(vals)) + 1).cast("int")))
    for name, (a, b) in (log_uniform or {}).items():
        u = seeded_uniform("draw", seed, name)
        d = d.withColumn(name, F.exp(F.lit(math.log(a)) + u * F.lit(math.log(b / a))))
    for name, scale in (exponential or {}).items():
        u = seeded_uniform("draw", seed, name)
        d = d.withColumn(name, -F.log(1 - u) * F.lit(scale))
    for name, (other, values) in (drop_when or {}).items():
        d = d.withColumn(name, F.when(~F.col(other).isin(list(values)), F.col(name)))
    return d


def eval_shrunk_means(data: DataFrame, cands: DataFrame, fold: str, target: str, k: int) -> DataFrame:
    """Candidate x fold validation RMSE of a shrunk group-mean regressor:
    pred(g) = (sum_g + alpha * global_mean) / (n_g + alpha), fitted on every
    fold but i and scored on fold i.  Candidates: (cand_key, group_col, alpha)."""
    group_cols = [r[0] for r in cands.select("group_col").distinct().collect()]   # bounded: column names
    parts = []
    for gc in group_cols:
        s = data.groupBy(fold, F.col(gc).cast("string").alias("g")).agg(
            F.sum(target).alias("s"), F.count(target).alias("n"), F.sum(F.col(target) * F.col(target)).alias("q"), F.count(F.lit(1)).alias("rows"))
        parts.append(s.withColumn("group_col", F.lit(gc)))
    stats = parts[0]
    for p in parts[1:]:
        stats = stats.unionByName(p)
    w_g = Window.partitionBy("group_col", "g")
    w_all = Window.partitionBy("group_col")
    comp = (stats.withColumn("cs", F.sum("s").over(w_g) - F.col("s")).withColumn("cn", F.sum("n").over(w_g) - F.col("n"))
                 .withColumn("gs", F.sum("s").over(w_all)).withColumn("gn", F.sum("n").over(w_all)))
    fold_tot = stats.groupBy("group_col", fold).agg(F.sum("s").alias("fs"), F.sum("n").alias("fn"))
    comp = comp.join(fold_tot, ["group_col", fold]).withColumn("gmean", (F.col("gs") - F.col("fs")) / (F.col("gn") - F.col("fn")))
    alpha = F.coalesce(F.col("alpha"), F.lit(0.0))          # a dropped alpha means no shrinkage
    consts = cands.join(comp, "group_col").select(
        "cand_key", "group_col", fold, "g",
        F.try_divide(F.col("cs") + alpha * F.col("gmean"), F.col("cn") + alpha).alias("pred"),
        "gmean", "s", "n", "q", "rows")
    # the squared error of a constant over a group follows from the group's sums: the data is read once
    sse = F.col("q") - 2 * F.col("p") * F.col("s") + F.col("n") * F.col("p") * F.col("p")
    sc = consts.withColumn("p", F.coalesce("pred", "gmean")).withColumn("sse", F.greatest(sse, F.lit(0.0)))
    return sc.groupBy("cand_key", fold).agg(F.sqrt(F.sum("sse") / F.nullif(F.sum("n"), F.lit(0))).alias("rmse"), F.sum("rows").alias("n"))


def fold_moments(data: DataFrame, fold: str, cols: Sequence[str]) -> dict:
    """Per fold: rows, means and centred second moments of ``cols``, in one
    pass; rows with a null in any of them take no part.  The driver gets
    folds x columns^2 numbers."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    whole = data.select(fold, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]).dropna(subset=[f"v{i}" for i in range(len(cols))])
    rows = whole.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"v{i}").alias(f"m{i}") for i in range(len(cols))],
                                   *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in rows:
        second = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"c{i}_{j}"]
        out[r[fold]] = (r["n"], np.array([r[f"m{i}"] for i in range(len(cols))]), second)
    return out


def _merged(parts: Sequence[tuple]) -> tuple:
    """The moments of several folds together."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    return n, mean, sum(p[0] * (p[2] + np.outer(p[1] - mean, p[1] - mean)) for p in parts) / n


def eval_ridge(data: DataFrame, cands: Sequence[tuple[str, Sequence[str], float]], fold: str, target: str) -> DataFrame:
    """Candidate x fold validation RMSE of ridge regressions ``(cand_key,
    features, alpha)``: standardisation and fit on every fold but i, scored on
    fold i.  Both the fit and the squared error of a linear model follow from
    the folds' moments, so the data is read once for any number of candidates.
    The intercept is not penalised; a constant feature has scale 1, and a
    singular system its solution of least norm.  With one fold there is nothing
    to fit on, and so no row."""
    names = sorted({f for _, features, _ in cands for f in features})
    moments = fold_moments(data, fold, [*names, target])
    rows = []
    for i in moments if len(moments) > 1 else ():
        n, mean, second = _merged([m for f, m in moments.items() if f != i])
        held_n, held_mean, held_second = moments[i]
        scale = np.sqrt(np.diag(second))[:-1]
        scale[scale == 0] = 1.0
        for key, features, alpha in cands:
            at = [names.index(f) for f in features]
            gram = n * second[np.ix_(at, at)] / np.outer(scale[at], scale[at]) + alpha * np.eye(len(at))
            beta = np.linalg.lstsq(gram, n * second[at, -1] / scale[at], rcond=None)[0] / scale[at]
            line = np.zeros(len(names) + 1)  # the residual as a combination of the columns
            line[at], line[-1] = -beta, 1.0
            error = line @ held_second @ line + (line @ (held_mean - mean)) ** 2
            rows.append((key, int(i), math.sqrt(max(error, 0.0)), int(held_n)))
    return data.sparkSession.createDataFrame(rows, f"cand_key string, {fold} int, rmse double, n long")


def log_candidates(fold_scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M4: every candidate with mean score, population std over folds and rank."""
    g = fold_scores.groupBy(*by, "cand_key").agg(F.avg("rmse").alias("cv_rmse"), F.stddev_pop("rmse").alias("cv_std"),
                                                 F.count(F.lit(1)).alias("n_folds"))
    w = Window.partitionBy(*by).orderBy(F.col("cv_rmse").asc()) if by else Window.orderBy(F.col("cv_rmse").asc())
    return g.withColumn("rank", F.rank().over(w).cast("int"))


def project_costs(measured: DataFrame, todo: DataFrame, cap: float, kernel: str = "kernel",
                  x1: str = "c", x2: str = "gamma", y: str = "seconds") -> DataFrame:
    """M6: per kernel, fit ln t = a ln C + b ln gamma + c on measured runs,
    project every pending candidate, mark those over the cap (kept, with a
    reason), and cumulate the projected clock cheapest first."""
    from foldsafe.operators.stats import fit_cost_plane, project_cost_plane
    plane = fit_cost_plane(measured, x1, x2, y, by=[kernel])
    p = project_cost_plane(todo, plane, x1, x2, by=[kernel])
    from foldsafe.operators.positions import ordered_sum
    from foldsafe.operators.ranges import Key
    p = p.withColumn("skipped", (F.col("projected") > F.lit(cap)).cast("int"))
    spent = F.when(F.col("skipped") == 0, F.col("projected")).otherwise(F.lit(0.0))
    return ordered_sum(p, ["search_id"], [Key("projected", nulls_last=True), "run_id"], spent, "clock")


def close_partial(measured: DataFrame, unrun: DataFrame, by: Sequence[str] = ("search_id",)) -> DataFrame:
    """M7: measured vs remaining hours per search."""
    m = measured.groupBy(*by).agg(F.count(F.lit(1)).alias("n_run"), (F.sum("seconds") / 3600.0).alias("hours_run"))
    u = unrun.groupBy(*by).agg(F.count(F.lit(1)).alias("n_unrun"), (F.sum("projected") / 3600.0).alias("hours_unrun"))
    return m.join(u, list(by), "full_outer").select(*by, F.coalesce("n_run", F.lit(0)).alias("n_run"),
                                                    F.coalesce("hours_run", F.lit(0.0)).alias("hours_run"),
                                                    F.coalesce("n_unrun", F.lit(0)).alias("n_unrun"),
                                                    F.coalesce("hours_unrun", F.lit(0.0)).alias("hours_unrun"))


def timing_study(timings: DataFrame, group: str, x: str, t: str = "seconds") -> DataFrame:
    """Per group the growth exponent of time vs x (log-log slope), the
    slowest and fastest run and their ratio."""
    from foldsafe.operators.stats import fit_power_law
    pl = fit_power_law(timings, x, t, by=[group])
    mm = timings.groupBy(group).agg(F.max(t).alias("slowest"), F.min(t).alias("fastest"))
    return pl.join(mm, group).withColumn("ratio", F.try_divide(F.col("slowest"), F.col("fastest")))
