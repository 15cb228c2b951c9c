"""Regression and classification metrics.

Each metric is one aggregate pass; grouped variants take ``by`` columns so the
same plan serves one model or millions of (model, segment, day) groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regression_aggs(pred, real, prefix: str = "") -> list[Column]:
    """Rmse, mae, r2 (1 - SSE/SST, SST = var_pop * n), bias, n."""
    e = _c(pred) - _c(real)
    sse = F.sum(e * e)
    sst = F.var_pop(_c(real)) * F.count(e)
    return [
        F.count(e).alias(prefix + "n"),
        F.sqrt(F.avg(e * e)).alias(prefix + "rmse"),
        F.avg(F.abs(e)).alias(prefix + "mae"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias(prefix + "r2"),
        F.avg(e).alias(prefix + "bias"),
    ]


def eval_regression(df: DataFrame, pred: str, real: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*regression_aggs(pred, real))


# Quantiles up to this many degrees of freedom come from a table; beyond it the expansion is within 1e-10.
T_TABLE = 100


@lru_cache
def t_quantiles(confidence: float = 0.95) -> tuple[float, ...]:
    """The two-sided Student-t quantiles for 1 to T_TABLE degrees of freedom, by
    bisecting the finite sums of sines and cosines that P(|T| < t) is for whole degrees."""
    def inside(angle: float, v: int) -> float:
        sin, cos = math.sin(angle), math.cos(angle)
        odd = v % 2
        term, total = (cos, 0.0) if odd else (1.0, 0.0)
        for j in range(1 + odd, v, 2):
            total += term
            term *= cos * cos * j / (j + 1)
        return (angle + sin * total) * 2 / math.pi if odd else sin * total

    out = []
    for v in range(1, T_TABLE + 1):
        lo, hi = 0.0, math.pi / 2
        while lo < (mid := (lo + hi) / 2) < hi:
            lo, hi = (mid, hi) if inside(mid, v) < confidence else (lo, mid)
        out.append(math.sqrt(v) * math.tan(lo))
    return tuple(out)


def _t_expansion(confidence: float) -> list[float]:
    """Coefficients of 1, 1/v, 1/v^2, ... of the Cornish-Fisher expansion around the normal quantile."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2.0)
    return [z, (z ** 3 + z) / 4.0, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96.0, (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384.0,
            (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160.0]


def t_quantile_expr(dof: Column, confidence: float = 0.95) -> Column:
    """Student-t quantile of whole degrees of freedom (null below one), evaluated per group on the executors."""
    v = dof.cast("double")
    table = F.get(F.array(*[F.lit(t) for t in t_quantiles(confidence)]), dof.cast("int") - 1)
    terms = [F.lit(g) / F.pow(v, F.lit(float(i))) for i, g in enumerate(_t_expansion(confidence))]
    return F.when(v <= T_TABLE, table).otherwise(sum(terms[1:], terms[0]))


def t_quantile_sql(dof_sql: str, confidence: float = 0.95) -> str:
    v = f"CAST({dof_sql} AS DOUBLE)"
    table = f"list_extract([{', '.join(map(repr, t_quantiles(confidence)))}], CAST({dof_sql} AS INTEGER))"
    terms = " + ".join(f"{g!r} / pow({v}, {i})" for i, g in enumerate(_t_expansion(confidence)))
    return f"(CASE WHEN ({dof_sql}) <= {T_TABLE} THEN {table} ELSE {terms} END)"


def eval_rmse_ci(df: DataFrame, pred: str, real: str, confidence: float = 0.95,
                 by: Sequence[str] = ()) -> DataFrame:
    """T-interval on the mean squared error, square root of both ends
    (lower end floored at 0); sem uses ddof=1."""
    e = F.col(pred) - F.col(real)
    agg = df.groupBy(*by).agg(F.avg(e * e).alias("__m"), F.stddev_samp(e * e).alias("__s"),
                              F.count(e).alias("n"))
    # one row has no spread: its bounds are null
    half = F.when(F.col("n") > 1, t_quantile_expr(F.nullif(F.col("n") - 1, F.lit(0)), confidence) * F.col("__s") / F.sqrt("n"))
    return agg.select(*by, "n", F.sqrt("__m").alias("rmse"),
                      F.sqrt(F.when(half.isNotNull(), F.greatest(F.lit(0.0), F.col("__m") - half))).alias("rmse_lo"),
                      F.sqrt(F.col("__m") + half).alias("rmse_hi"))


def prf_aggs(real, pred, positive=1) -> list[Column]:
    """Accuracy, precision, recall, F1 for one positive class (0 when undefined)."""
    r, p = _c(real), _c(pred)
    tp = F.sum(((r == positive) & (p == positive)).cast("long"))
    fp = F.sum(((r != positive) & (p == positive)).cast("long"))
    fn = F.sum(((r == positive) & (p != positive)).cast("long"))
    acc = F.avg((r == p).cast("double"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    return [tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), acc.alias("accuracy"),
            prec.alias("precision"), rec.alias("recall"), f1.alias("f1")]


def eval_prf(df: DataFrame, real: str, pred: str, positive=1, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*prf_aggs(real, pred, positive))


def agg_prevalence(df: DataFrame, label: str, pred: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Positive share, majority-class baseline accuracy and the model's gap to it."""
    cols = [F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("positive_share")]
    if pred is not None:
        cols.append(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))
    a = df.groupBy(*by).agg(*cols)
    a = a.withColumn("majority_accuracy", F.greatest(F.col("positive_share"), 1 - F.col("positive_share")))
    if pred is not None:
        a = a.withColumn("gap", F.col("accuracy") - F.col("majority_accuracy"))
    return a


def agg_cv_scores(df: DataFrame, cand: Sequence[str], score: str) -> DataFrame:
    """Mean and population std of fold scores per candidate."""
    return df.groupBy(*cand).agg(F.avg(score).alias("cv_mean"), F.stddev_pop(score).alias("cv_std"),
                                 F.count(score).alias("n_folds"))


def eval_vector_mae(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error per element between two vectors, averaged."""
    per_row = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))),
                          F.lit(0.0), lambda acc, x: acc + x) / F.size(a)
    return df.groupBy(*by).agg(F.avg(per_row).alias("mae_per_element"), F.count(F.lit(1)).alias("n"))


def eval_out_of_range(df: DataFrame, pred: str, real: str, lo, hi, by: Sequence[str] = ()) -> DataFrame:
    """Predictions outside the training-target range and RMSE raw vs clipped."""
    p = F.col(pred)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    out = (p < lo_c) | (p > hi_c)
    excess = F.greatest(lo_c - p, p - hi_c, F.lit(0.0))
    clipped = F.greatest(lo_c, F.least(hi_c, p))
    e_raw = p - F.col(real)
    e_clip = clipped - F.col(real)
    return df.groupBy(*by).agg(
        F.count_if(out).alias("n_out"),
        F.max(F.when(out, excess)).alias("max_excess"),
        F.sqrt(F.avg(e_raw * e_raw)).alias("rmse_raw"),
        F.sqrt(F.avg(e_clip * e_clip)).alias("rmse_clipped"))
