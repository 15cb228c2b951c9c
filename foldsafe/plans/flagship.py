"""Flagship plan: source -> null policy -> stratify -> exact split -> fit on
train only -> score test -> metrics with a confidence interval.

orders ⋈ customer -> price band (right-closed bins) -> exact stratified 20 %
test -> median imputation fitted on train -> least-squares line fitted on
train -> RMSE / MAE / R² / bias on test + t-interval on the RMSE.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldsafe.operators.metrics import regression_aggs, t_quantile_expr, t_quantile_sql
from foldsafe.operators.prep import apply_impute
from foldsafe.operators.quantiles import exact_median
from foldsafe.operators.splits import split_stratified
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_BANDED, districts_banded
from foldsafe.plans.sqlutil import stratified_split_sql


def fit_imputed_line(train: DataFrame, x: str, y: str) -> dict:
    """Median imputation of x and the least-squares line of y on the imputed
    x, fitted together in ONE aggregate: imputed sums follow from the sums
    over present values plus (missing count) x median."""
    present = F.col(x).isNotNull()
    med = exact_median(train, [x])[x]
    r = train.agg(F.lit(med).alias("med"), F.count(F.lit(1)).alias("n"),
                  F.count_if(~present).alias("n_miss"), F.sum(x).alias("sx"), F.sum(F.col(x) * F.col(x)).alias("sxx"),
                  F.sum(F.when(present, F.col(x) * F.col(y))).alias("sxy"), F.sum(y).alias("sy"),
                  F.sum(F.when(~present, F.col(y))).alias("sy_miss")).first()
    n, m = r["n"], r["med"]
    sx = (r["sx"] or 0.0) + r["n_miss"] * m
    sxx = (r["sxx"] or 0.0) + r["n_miss"] * m * m
    sxy = (r["sxy"] or 0.0) + m * (r["sy_miss"] or 0.0)
    slope = (n * sxy - sx * r["sy"]) / (n * sxx - sx * sx)
    return {"median": m, "slope": slope, "intercept": (r["sy"] - slope * sx) / n, "n": n}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = split_stratified(districts_banded(spark, sf_dir), "row_id", "band", 0.2, seed=42)
    d = d.select("acctbal", "target", "is_test").persist(StorageLevel.MEMORY_AND_DISK)   # read by two jobs
    fit = fit_imputed_line(d.where(F.col("is_test") == 0), "acctbal", "target")        # K1 + E21 on train only
    scored = apply_impute(d.where(F.col("is_test") == 1), {"acctbal": fit["median"]}).withColumn(
        "pred", F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("acctbal"))
    e = F.col("pred") - F.col("target")
    m = scored.agg(*regression_aggs("pred", "target"),
                   F.avg(e * e).alias("__m"), F.stddev_samp(e * e).alias("__s"))
    half = t_quantile_expr(F.col("n") - 1) * F.col("__s") / F.sqrt(F.col("n"))
    return m.select(
        F.lit(int(fit["n"])).cast("bigint").alias("n_train"),
        F.col("n").alias("n_test"),
        F.round(F.lit(fit["slope"]), 9).alias("slope"),
        F.round(F.lit(fit["intercept"]), 6).alias("intercept"),
        F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"),
        F.round("r2", 6).alias("r2"), F.round("bias", 6).alias("bias"),
        F.round(F.sqrt(F.greatest(F.lit(0.0), F.col("__m") - half)), 6).alias("rmse_lo"),
        F.round(F.sqrt(F.col("__m") + half), 6).alias("rmse_hi"),
    )


FLAGSHIP_SQL = f"""WITH {SQL_BANDED},
{stratified_split_sql('banded', 'row_id', 'band')},
med AS (SELECT median(acctbal) AS m FROM banded_split WHERE is_test = 0),
d AS (SELECT s.* REPLACE (coalesce(s.acctbal, med.m) AS acctbal) FROM banded_split s, med),
fit AS (SELECT regr_slope(target, acctbal) AS slope, regr_intercept(target, acctbal) AS intercept,
               regr_count(target, acctbal) AS n FROM d WHERE is_test = 0),
sc AS (SELECT d.target, fit.intercept + fit.slope * d.acctbal AS pred FROM d, fit WHERE d.is_test = 1),
m AS (SELECT count(pred - target) AS n, sqrt(avg((pred - target) * (pred - target))) AS rmse,
             avg(abs(pred - target)) AS mae,
             1 - sum((pred - target) * (pred - target)) / (var_pop(target) * count(pred - target)) AS r2,
             avg(pred - target) AS bias,
             avg((pred - target) * (pred - target)) AS mm, stddev_samp((pred - target) * (pred - target)) AS ss
      FROM sc)
SELECT CAST(fit.n AS BIGINT) AS n_train, m.n AS n_test, round(fit.slope, 9) AS slope,
       round(fit.intercept, 6) AS intercept, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
       round(r2, 6) AS r2, round(bias, 6) AS bias,
       round(sqrt(greatest(0.0, mm - {t_quantile_sql('m.n - 1')} * ss / sqrt(m.n))), 6) AS rmse_lo,
       round(sqrt(mm + {t_quantile_sql('m.n - 1')} * ss / sqrt(m.n)), 6) AS rmse_hi
FROM m, fit"""

register("flagship_regression", FLAGSHIP_SQL)(flagship)
