"""Registered queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.operators import metrics as M
from foldsafe.operators import stats as ST
from foldsafe.operators.splits import split_random, split_stratified
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_BANDED, SQL_DISTRICTS, districts, districts_banded
from foldsafe.plans.sqlutil import random_split_sql, stratified_split_sql
from foldsafe.session import read_table

LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


@register("agg_null_counts", f"""WITH {SQL_DISTRICTS},
u AS (SELECT 'row_id' AS column, CAST(count_if(row_id IS NULL) AS BIGINT) AS nulls FROM districts
      UNION ALL SELECT 'acctbal', CAST(count_if(acctbal IS NULL) AS BIGINT) FROM districts
      UNION ALL SELECT 'doy', CAST(count_if(doy IS NULL) AS BIGINT) FROM districts
      UNION ALL SELECT 'priority', CAST(count_if(priority IS NULL) AS BIGINT) FROM districts
      UNION ALL SELECT 'segment', CAST(count_if(segment IS NULL) AS BIGINT) FROM districts
      UNION ALL SELECT 'target', CAST(count_if(target IS NULL) AS BIGINT) FROM districts)
SELECT * FROM u WHERE nulls > 0""")
def q_e1(spark, sf):
    d = districts(spark, sf)
    return ST.agg_null_counts(d, ["row_id", "acctbal", "doy", "priority", "segment", "target"])


def _describe_sql(cols):
    parts = [f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
      round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
      round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem""" for c in cols]
    return " UNION ALL ".join(parts)


@register("agg_describe", _describe_sql(LI_COLS))
def q_e2(spark, sf):
    d = ST.agg_describe(read_table(spark, sf, "lineitem"), LI_COLS)
    return _r(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register("agg_value_counts", """
SELECT l_returnflag, l_linestatus, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 9) AS proportion
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_e3(spark, sf):
    d = ST.agg_value_counts(read_table(spark, sf, "lineitem"), "l_linestatus", by=["l_returnflag"])
    return _r(d, ["proportion"], 9)


@register("agg_split_bias", f"""WITH {SQL_BANDED}, {stratified_split_sql('banded', 'row_id', 'band', 0.2, 42, 'strat_test')},
{random_split_sql('banded_split', 'row_id', 0.2, 42, 'rand_test')},
g AS (SELECT band, count(*) AS n, sum(strat_test) AS ns, sum(rand_test) AS nr FROM banded_split_rsplit GROUP BY band),
s AS (SELECT band, n / sum(n) OVER () AS overall, ns / sum(ns) OVER () AS stratified, nr / sum(nr) OVER () AS random FROM g)
SELECT band, round(overall, 6) AS overall, round(stratified, 6) AS stratified, round(random, 6) AS random,
       round(100.0 * (stratified / overall - 1), 6) AS strat_err_pct, round(100.0 * (random / overall - 1), 6) AS rand_err_pct
FROM s""")
def q_e4(spark, sf):
    d = split_stratified(districts_banded(spark, sf), "row_id", "band", 0.2, 42, out="strat_test")
    d = split_random(d, "row_id", 0.2, 42, out="rand_test")
    b = ST.agg_split_bias(d, "band", "strat_test", "rand_test")
    return _r(b, ["overall", "stratified", "random", "strat_err_pct", "rand_err_pct"])


@register("agg_group_rate", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(CAST(event_type = 'purchase' AS INTEGER)), 9) AS rate, count(*) AS n
FROM events GROUP BY 1""")
def q_e5(spark, sf):
    e = read_table(spark, sf, "events").select(F.hour("ts").cast("int").alias("hour"),
                                              (F.col("event_type") == "purchase").cast("int").alias("purchase"))
    return _r(ST.agg_group_rate(e, "hour", "purchase"), ["rate"], 9)


@register("eval_regression", f"""WITH {SQL_DISTRICTS},
m AS (SELECT segment, avg(target) AS pred FROM districts GROUP BY segment),
s AS (SELECT d.priority, m.pred, d.target FROM districts d JOIN m USING (segment))
SELECT priority, count(pred - target) AS n, round(sqrt(avg((pred - target) ^ 2)), 6) AS rmse,
       round(avg(abs(pred - target)), 6) AS mae,
       round(1 - sum((pred - target) ^ 2) / (var_pop(target) * count(pred - target)), 6) AS r2,
       round(avg(pred - target), 6) AS bias
FROM s GROUP BY priority""")
def q_e6(spark, sf):
    d = districts(spark, sf)
    m = d.groupBy("segment").agg(F.avg("target").alias("pred"))
    s = d.join(bounded(m), "segment")
    return _r(M.eval_regression(s, "pred", "target", by=["priority"]), ["rmse", "mae", "r2", "bias"])


@register("eval_rmse_ci", f"""WITH {SQL_DISTRICTS},
m AS (SELECT segment, avg(target) AS pred FROM districts GROUP BY segment),
s AS (SELECT d.priority, (m.pred - d.target) ^ 2 AS se FROM districts d JOIN m USING (segment)),
a AS (SELECT priority, avg(se) AS mm, stddev_samp(se) AS ss, count(se) AS n FROM s GROUP BY priority)
SELECT priority, n, round(sqrt(mm), 6) AS rmse,
       round(sqrt(CASE WHEN n > 1 THEN greatest(0.0, mm - {M.t_quantile_sql('n - 1')} * ss / sqrt(n)) END), 6) AS rmse_lo,
       round(sqrt(mm + {M.t_quantile_sql('n - 1')} * ss / sqrt(n)), 6) AS rmse_hi
FROM a""")
def q_e7(spark, sf):
    d = districts(spark, sf)
    m = d.groupBy("segment").agg(F.avg("target").alias("pred"))
    s = d.join(bounded(m), "segment")
    return _r(M.eval_rmse_ci(s, "pred", "target", by=["priority"]), ["rmse", "rmse_lo", "rmse_hi"])


EVENTS_CLS_SQL = """cls AS (SELECT event_id, user_id, CAST(event_type = 'purchase' AS INTEGER) AS real,
                      CAST(value > 250 AS INTEGER) AS pred FROM events)"""


def _events_cls(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", "user_id", (F.col("event_type") == "purchase").cast("int").alias("real"),
                    (F.col("value") > 250).cast("int").alias("pred"))


@register("eval_prf", f"""WITH {EVENTS_CLS_SQL},
a AS (SELECT sum(CAST(real = 1 AND pred = 1 AS BIGINT)) AS tp, sum(CAST(real <> 1 AND pred = 1 AS BIGINT)) AS fp,
             sum(CAST(real = 1 AND pred <> 1 AS BIGINT)) AS fn, avg(CAST(real = pred AS DOUBLE)) AS accuracy FROM cls)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, round(accuracy, 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1 FROM a""")
def q_e9(spark, sf):
    return _r(M.eval_prf(_events_cls(spark, sf), "real", "pred"), ["accuracy", "precision", "recall", "f1"])


@register("agg_prevalence", f"""WITH {EVENTS_CLS_SQL},
a AS (SELECT count(*) AS n, avg(CAST(real AS DOUBLE)) AS ps, avg(CAST(real = pred AS DOUBLE)) AS acc FROM cls)
SELECT n, round(ps, 6) AS positive_share, round(acc, 6) AS accuracy, round(greatest(ps, 1 - ps), 6) AS majority_accuracy,
       round(acc - greatest(ps, 1 - ps), 6) AS gap FROM a""")
def q_e15(spark, sf):
    return _r(M.agg_prevalence(_events_cls(spark, sf), "real", "pred"), ["positive_share", "accuracy", "majority_accuracy", "gap"])


@register("agg_histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, lo, hi FROM lineitem, r)
SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS lo, round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS hi, count(*) AS n
FROM b GROUP BY bin, b.lo, b.hi""")
def q_e16(spark, sf):
    return _r(ST.agg_histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", 50), ["lo", "hi"])


@register("agg_box_stats", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3, count(l_extendedprice) AS n FROM lineitem GROUP BY 1),
w AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_whisker, q3 + 1.5 * (q3 - q1) AS hi_whisker FROM q),
o AS (SELECT l.l_returnflag, CAST(count_if(l.l_extendedprice < w.lo_whisker OR l.l_extendedprice > w.hi_whisker) AS BIGINT) AS n_outliers
      FROM lineitem l JOIN w USING (l_returnflag) GROUP BY 1)
SELECT w.l_returnflag, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(lo_whisker, 6) AS lo_whisker, round(hi_whisker, 6) AS hi_whisker, n_outliers FROM w JOIN o USING (l_returnflag)""")
def q_e17(spark, sf):
    b = ST.agg_box_stats(read_table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return _r(b, ["q1", "median", "q3", "lo_whisker", "hi_whisker"])


@register("agg_corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in LI_COLS for b in LI_COLS))
def q_e18(spark, sf):
    return _r(ST.agg_corr_matrix(read_table(spark, sf, "lineitem"), LI_COLS), ["corr"])


@register("agg_ranges", " UNION ALL ".join(
    f"""SELECT '{c}' AS column, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.01), 6) AS p_lo,
        round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.99), 6) AS p_hi, round(max({c}), 6) AS max
        FROM lineitem""" for c in LI_COLS))
def q_e20(spark, sf):
    return _r(ST.agg_ranges(read_table(spark, sf, "lineitem"), LI_COLS), ["min", "p_lo", "median", "p_hi", "max"])


@register("fit_ols_simple", """
SELECT CAST(p_size AS INTEGER) % 5 AS size_group, round(regr_slope(p_retailprice, p_size), 6) AS slope,
       round(regr_intercept(p_retailprice, p_size), 6) AS intercept, round(regr_r2(p_retailprice, p_size), 6) AS r2,
       CAST(regr_count(p_retailprice, p_size) AS BIGINT) AS n
FROM part GROUP BY 1""")
def q_e21(spark, sf):
    p = read_table(spark, sf, "part").withColumn("size_group", F.col("p_size").cast("int") % 5)
    return _r(ST.fit_ols_simple(p, "p_size", "p_retailprice", by=["size_group"]), ["slope", "intercept", "r2"])


@register("fit_power_law", """
WITH t AS (SELECT l_returnflag, CASE WHEN l_quantity > 0 AND l_extendedprice > 0 THEN ln(l_quantity) END AS lx,
                  CASE WHEN l_quantity > 0 AND l_extendedprice > 0 THEN ln(l_extendedprice) END AS ly FROM lineitem),
f AS (SELECT l_returnflag, regr_slope(ly, lx) AS exponent, regr_intercept(ly, lx) AS b, regr_count(ly, lx) AS n FROM t GROUP BY 1)
SELECT l_returnflag, round(exponent, 6) AS exponent, CAST(n AS BIGINT) AS n, round(exp(b), 4) AS factor,
       round(exp(b) * pow(100.0, exponent), 4) AS projected FROM f""")
def q_e22(spark, sf):
    f = ST.fit_power_law(read_table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", by=["l_returnflag"], at=100.0)
    return f.select("l_returnflag", F.round("exponent", 6).alias("exponent"), "n",
                    F.round("factor", 4).alias("factor"), F.round("projected", 4).alias("projected"))


@register("fit_cost_plane", """
WITH t AS (SELECT l_linestatus, ln(l_quantity) AS u, ln(1 + l_tax) AS v, ln(l_extendedprice) AS w
           FROM lineitem WHERE l_quantity > 0 AND 1 + l_tax > 0 AND l_extendedprice > 0),
g AS (SELECT l_linestatus, var_pop(u) AS suu, var_pop(v) AS svv, covar_pop(u, v) AS suv, covar_pop(u, w) AS suw,
             covar_pop(v, w) AS svw, avg(u) AS mu, avg(v) AS mv, avg(w) AS mw, count(w) AS n FROM t GROUP BY 1),
s AS (SELECT *, (suw * svv - svw * suv) / (suu * svv - suv * suv) AS a, (svw * suu - suw * suv) / (suu * svv - suv * suv) AS b FROM g)
SELECT l_linestatus, round(a, 6) AS a, round(b, 6) AS b, round(mw - a * mu - b * mv, 6) AS c, n FROM s""")
def q_e23(spark, sf):
    li = read_table(spark, sf, "lineitem").withColumn("tax1", 1 + F.col("l_tax"))
    return _r(ST.fit_cost_plane(li, "l_quantity", "tax1", "l_extendedprice", by=["l_linestatus"]), ["a", "b", "c"])


@register("agg_cv_scores", """
WITH f AS (SELECT user_id AS cand, hour(ts) % 5 AS fold, avg(value) AS score FROM events GROUP BY 1, 2)
SELECT cand, round(avg(score), 6) AS cv_mean, round(stddev_pop(score), 6) AS cv_std, count(score) AS n_folds
FROM f GROUP BY cand""")
def q_e24(spark, sf):
    e = read_table(spark, sf, "events")
    f = e.groupBy(F.col("user_id").alias("cand"), (F.hour("ts") % 5).alias("fold")).agg(F.avg("value").alias("score"))
    return _r(M.agg_cv_scores(f, ["cand"], "score"), ["cv_mean", "cv_std"])


@register("eval_vector_mae", """
WITH p AS (SELECT a.vec_id, a.embedding AS x, b.embedding AS y, a.label FROM embeddings a
           JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT CAST(label AS INTEGER) AS label,
       round(avg(list_sum(list_transform(list_zip(x, y), lambda t: abs(CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE)))) / len(x)), 6) AS mae_per_element,
       count(*) AS n
FROM p GROUP BY label""")
def q_e25(spark, sf):
    e = read_table(spark, sf, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    p = e.join(nxt, "vec_id").select("vec_id", F.col("embedding").alias("x"), "y", F.col("label").cast("int").alias("label"))
    return _r(M.eval_vector_mae(p, "x", "y", by=["label"]), ["mae_per_element"])


@register("eval_out_of_range", f"""WITH {SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)},
rng AS (SELECT min(target) AS lo, max(target) AS hi FROM districts_rsplit WHERE is_test = 0),
sc AS (SELECT d.priority, d.target, 2.5 + (d.acctbal / 2000.0) AS pred FROM districts_rsplit d WHERE is_test = 1 AND acctbal IS NOT NULL)
SELECT priority, CAST(count_if(pred < lo OR pred > hi) AS BIGINT) AS n_out,
       round(max(CASE WHEN pred < lo OR pred > hi THEN greatest(lo - pred, pred - hi, 0.0) END), 6) AS max_excess,
       round(sqrt(avg((pred - target) ^ 2)), 6) AS rmse_raw,
       round(sqrt(avg((greatest(lo, least(hi, pred)) - target) ^ 2)), 6) AS rmse_clipped
FROM sc, rng GROUP BY priority""")
def q_e26(spark, sf):
    d = split_random(districts(spark, sf), "row_id", 0.2, 42)
    lo, hi = d.where("is_test = 0").agg(F.min("target"), F.max("target")).first()
    sc = d.where("is_test = 1 AND acctbal IS NOT NULL").withColumn("pred", 2.5 + F.col("acctbal") / 2000.0)
    return _r(M.eval_out_of_range(sc, "pred", "target", lo, hi, by=["priority"]),
              ["max_excess", "rmse_raw", "rmse_clipped"])
