"""Registered queries: learners, out-of-fold prediction, learning curves,
importances (L1-L5, L8-L10, L12, L13, K5, K9, K11, I10, I11, M3, M9, M10).

Stochastic / iterative learners have no SQL oracle (rows-only check); the
closed-form ones do."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from foldsafe.functions.keys import sql_seeded_hash
from foldsafe.operators import curves as CV, forest as FR, learners as LR, linear as LN
from foldsafe.operators.joins import rbf_features
from foldsafe.operators.metrics import regression_aggs
from foldsafe.operators.positions import hash_positions
from foldsafe.operators.prep import apply_branches, apply_impute, fit_branches, fit_impute_numeric
from foldsafe.operators.splits import fold_kfold_shuffled, fold_stratified, split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, districts, districts_split
from foldsafe.plans.sqlutil import kfold_sql, random_split_sql
from foldsafe.session import read_table, scratch_path


def _split_imputed(spark, sf):
    d = districts_split(spark, sf)
    med = fit_impute_numeric(d.where("is_test = 0"), ["acctbal"])
    return apply_impute(d, med).withColumn("doy", F.col("doy").cast("double"))


def _metrics(scored, pred="pred", real="target"):
    m = scored.agg(*regression_aggs(pred, real))
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2", "bias")])


OLS_SQL = f"""{SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)},
med AS (SELECT median(acctbal) AS m FROM districts_rsplit WHERE is_test = 0),
d AS (SELECT row_id, is_test, target, coalesce(acctbal, med.m) AS x1, CAST(doy AS DOUBLE) AS x2 FROM districts_rsplit, med),
g AS (SELECT var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, target) AS s1y,
             covar_pop(x2, target) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(target) AS my FROM d WHERE is_test = 0),
f AS (SELECT (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM g),
fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM f),
sc AS (SELECT d.target, fit.b0 + fit.b1 * d.x1 + fit.b2 * d.x2 AS pred FROM d, fit WHERE d.is_test = 1)"""


@register("fit_ols", f"""WITH {OLS_SQL}
SELECT count(*) AS n, round(sqrt(avg((pred - target) ^ 2)), 6) AS rmse, round(avg(abs(pred - target)), 6) AS mae,
       round(1 - sum((pred - target) ^ 2) / (var_pop(target) * count(*)), 6) AS r2, round(avg(pred - target), 6) AS bias,
       round(max(fit.b1), 9) AS coef_acctbal, round(max(fit.b2), 9) AS coef_doy FROM sc, fit""")
def q_l1(spark, sf):
    d = _split_imputed(spark, sf)
    m = LR.fit_ols_gram(d.where("is_test = 0"), ["acctbal", "doy"], "target")
    sc = LR.predict_linear(d.where("is_test = 1"), m)
    return _metrics(sc).select("*", F.round(F.lit(m["coef"]["acctbal"]), 9).alias("coef_acctbal"),
                               F.round(F.lit(m["coef"]["doy"]), 9).alias("coef_doy"))


def _features(spark, sf):
    d = _split_imputed(spark, sf)
    br = fit_branches(d.where("is_test = 0"), numeric=["acctbal", "doy"], log=[], categorical=["segment", "priority"],
                      passthrough=["row_id", "is_test", "target"])
    x = apply_branches(d, br)
    feats = [c for c in br.output_names() if c not in ("row_id", "is_test", "target")]
    return LR.assemble(x, feats), feats


def _fit_eval(spark, sf, est, x=None):
    x = (_features(spark, sf)[0] if x is None else x).cache()
    m = est.setFeaturesCol("features").setLabelCol("target").fit(x.where("is_test = 0"))
    sc = m.transform(x.where("is_test = 1")).withColumnRenamed("prediction", "pred")
    return _metrics(sc)


@register("fit_ridge")
def q_l2(spark, sf):
    """Ridge with the reference's penalty convention (alpha = 1 on the sum of squares)."""
    x, _ = _features(spark, sf)
    tr = x.where("is_test = 0")
    est = LR.regressor("ridge", regParam=LR.ridge_reg_param(tr, "target", 1.0))
    return _fit_eval(spark, sf, est, x)


@register("fit_tree")
def q_l3(spark, sf):
    return _fit_eval(spark, sf, LR.regressor("tree", maxDepth=10))


@register("fit_forest")
def q_l4(spark, sf):
    return _fit_eval(spark, sf, LR.regressor("forest", numTrees=50, maxDepth=8))


@register("fit_forest_classifier")
def q_l4_binary(spark, sf):
    """L4 for two classes: held-out probability of a purchase, from the leaves' class shares."""
    d = split_random(_event_vectors(spark, sf), "event_id", 0.2, 42)
    nodes = FR.fit_forest_classifier(d.where("is_test = 0"), "x", "label", scratch_path(spark, f"forest-{uuid.uuid4().hex}"))
    sc = FR.score_forest(d.where("is_test = 1").select("event_id", "label", "x"), nodes, "x")
    return sc.select("event_id", "label", F.round(F.col("proba")[1], 6).alias("proba"), "pred")


@register("fit_forest_multiclass")
def q_l4_classes(spark, sf):
    """L4 for many classes: held-out class by the trees' votes and by mean probability."""
    d = _class_vectors(spark, sf)
    nodes = FR.fit_forest_classifier(d.where("is_test = 0"), "embedding", "label", scratch_path(spark, f"forest-{uuid.uuid4().hex}"))
    sc = FR.score_forest(d.where("is_test = 1").select("vec_id", "label", "embedding"), nodes, "embedding")
    return sc.select("vec_id", "label", "pred", "pred_vote", F.element_at("votes", F.col("pred_vote") + 1).alias("votes"))


@register("fit_boosted")
def q_l5(spark, sf):
    return _fit_eval(spark, sf, LR.regressor("boosted", maxIter=30, maxDepth=5))


EV_CLS = """ev AS (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS label, value, CAST(hour(ts) AS DOUBLE) AS hour FROM events)"""


def _events(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("label"), "value",
                    F.hour("ts").cast("double").alias("hour"))


@register("fit_majority", f"""WITH {EV_CLS}, {random_split_sql('ev', 'event_id', 0.2, 42)},
c AS (SELECT label, count(*) AS n FROM ev_rsplit WHERE is_test = 0 GROUP BY label),
m AS (SELECT arg_min(label, (-n, label)) AS majority FROM c)
SELECT CAST(m.majority AS INTEGER) AS majority, round(avg(CAST(label = m.majority AS DOUBLE)), 6) AS accuracy, count(*) AS n
FROM ev_rsplit, m WHERE is_test = 1 GROUP BY m.majority""")
def q_l8(spark, sf):
    d = split_random(_events(spark, sf), "event_id", 0.2, 42)
    maj = LR.fit_majority(d.where("is_test = 0"), "label")
    te = d.where("is_test = 1")
    return te.agg(F.lit(maj).cast("int").alias("majority"), F.round(F.avg((F.col("label") == maj).cast("double")), 6).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def _event_vectors(spark, sf):
    return _events(spark, sf).withColumn("x", F.array("value", "hour"))


@register("fit_linear_classifier")
def q_l9(spark, sf):
    """L2-regularised squared-hinge classifier: Newton steps on grouped sums."""
    d = split_random(_event_vectors(spark, sf), "event_id", 0.2, 42)
    w = LN.fit_linear(d.where("is_test = 0"), "x", "label", [LN.Task("purchase", 1)], "squared_hinge")
    sc = d.where("is_test = 1").withColumn("decision", LN.decisions("x", w)[0])
    return sc.select("event_id", "decision", (F.col("decision") > 0).cast("int").alias("pred"))


def newton_sql(rows: str, models: str, steps: int = 12) -> str:
    """Recursive CTE text: logistic weights b0, b1, b2 of y on v, h (penalty 1 on b1, b2) per model, on the rows of other folds."""
    return f"""x AS ({rows}), newton AS (
  SELECT model, 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM ({models})
  UNION ALL
  SELECT model, i + 1, b0 + (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / det,
         b1 + (a * (g1 * f - e * g2) - g0 * (b * f - c * e) + c * (b * g2 - g1 * c)) / det,
         b2 + (a * (d * g2 - g1 * e) - b * (b * g2 - g1 * c) + g0 * (b * e - c * d)) / det
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM (
    SELECT model, i, b0, b1, b2, sum(y - p) AS g0, sum((y - p) * v) - b1 AS g1, sum((y - p) * h) - b2 AS g2, sum(p * (1 - p)) AS a,
           sum(p * (1 - p) * v) AS b, sum(p * (1 - p) * h) AS c, sum(p * (1 - p) * v * v) + 1 AS d, sum(p * (1 - p) * v * h) AS e,
           sum(p * (1 - p) * h * h) + 1 AS f
    FROM (SELECT newton.*, x.y, x.v, x.h, 1 / (1 + exp(-(b0 + b1 * x.v + b2 * x.h))) AS p
          FROM newton JOIN x ON x.fold <> model WHERE i < {steps} AND x.v IS NOT NULL AND x.h IS NOT NULL)
    GROUP BY model, i, b0, b1, b2))),
weights AS (SELECT model, b0, b1, b2 FROM newton WHERE i = {steps})"""


@register("fit_logistic", f"""WITH RECURSIVE {EV_CLS}, {random_split_sql('ev', 'event_id', 0.2, 42)},
{newton_sql("SELECT label AS y, value AS v, hour AS h, 0 AS fold FROM ev_rsplit WHERE is_test = 0", "SELECT -1 AS model")},
s AS (SELECT event_id, b0 + b1 * value + b2 * hour AS t FROM ev_rsplit, weights WHERE is_test = 1)
SELECT event_id, round(1 / (1 + exp(-t)), 6) AS proba, CAST(t > 0 AS INTEGER) AS pred FROM s""")
def q_l10(spark, sf):
    d = split_random(_event_vectors(spark, sf), "event_id", 0.2, 42)
    w = LN.fit_linear(d.where("is_test = 0"), "x", "label", [LN.Task("purchase", 1)])
    sc = d.where("is_test = 1").withColumn("t", LN.decisions("x", w)[0])
    return sc.select("event_id", F.round(LN.probability(F.col("t")), 6).alias("proba"), (F.col("t") > 0).cast("int").alias("pred"))


OOF_LOGISTIC_SQL = f"""{EV_CLS}, {kfold_sql('ev', 'event_id', 5, 42)},
{newton_sql("SELECT label AS y, value AS v, hour AS h, fold FROM ev_kf", "SELECT DISTINCT fold AS model FROM ev_kf")},
oof AS (SELECT event_id, fold, label, b0 + b1 * value + b2 * hour AS t FROM ev_kf JOIN weights ON model = fold)"""


def _oof_logistic(spark, sf):
    """Every event's decision by the model of the folds that it is not in; all folds' models in one pass a step."""
    d = fold_kfold_shuffled(_event_vectors(spark, sf), "event_id", 5, 42)
    w = LN.fit_linear(d, "x", "label", LN.out_of_fold_tasks(1, 5), fold="fold")
    return d.withColumn("t", F.element_at(LN.decisions("x", w), F.col("fold").cast("int") + 1))


@register("oof_logistic", f"""WITH RECURSIVE {OOF_LOGISTIC_SQL}
SELECT event_id, CAST(fold AS INTEGER) AS fold, round(t, 6) AS decision, round(1 / (1 + exp(-t)), 6) AS proba, CAST(t > 0 AS INTEGER) AS pred FROM oof""")
def q_i10_logistic(spark, sf):
    o = _oof_logistic(spark, sf)
    return o.select("event_id", F.col("fold").cast("int").alias("fold"), F.round("t", 6).alias("decision"),
                    F.round(LN.probability(F.col("t")), 6).alias("proba"), (F.col("t") > 0).cast("int").alias("pred"))


@register("eval_oof_roc_auc", f"""WITH RECURSIVE {OOF_LOGISTIC_SQL},
s AS (SELECT round(t, 6) AS score, sum(label) AS pos, sum(1 - label) AS neg FROM oof GROUP BY 1),
c AS (SELECT *, sum(pos) OVER () AS p, sum(neg) OVER () AS n, coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM s)
SELECT round(sum(neg * (above + pos / 2.0)) / (max(p) * max(n)), 6) AS auc, CAST(max(p) AS BIGINT) AS n_pos, CAST(max(n) AS BIGINT) AS n_neg FROM c""")
def q_e14_oof(spark, sf):
    a = CV.eval_roc_auc(_oof_logistic(spark, sf).withColumn("score", F.round("t", 6)), "score", "label")
    return a.select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


@register("eval_oof_pr_curve", f"""WITH RECURSIVE {OOF_LOGISTIC_SQL},
s AS (SELECT round(t, 6) AS score, sum(label) AS pos, count(*) AS n FROM oof GROUP BY 1),
c AS (SELECT score, sum(pos) OVER w AS tp, sum(n) OVER w AS called, sum(pos) OVER () AS p FROM s
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT score AS threshold, round(tp / called, 6) AS precision, round(coalesce(tp / nullif(p, 0), 0.0), 6) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_e12_oof(spark, sf):
    c = CV.eval_pr_curve(_oof_logistic(spark, sf).withColumn("score", F.round("t", 6)), "score", "label")
    return c.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def _emb_features(spark, sf):
    e = read_table(spark, sf, "embeddings")
    e = e.select("vec_id", F.col("label").cast("double").alias("y"), "embedding")
    from pyspark.ml.functions import array_to_vector
    e = e.withColumn("features", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))))
    return split_random(e, "vec_id", 0.2, 42).cache()


def _class_vectors(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("int").alias("label"), "embedding")
    return split_random(e, "vec_id", 0.2, 42)


def _classes(d):
    return sorted(r[0] for r in d.where("is_test = 0 and label is not null").select("label").distinct().collect())


@register("fit_one_vs_rest")
def q_l12(spark, sf):
    d = _class_vectors(spark, sf)
    classes = _classes(d)
    w = LN.fit_linear(d.where("is_test = 0"), "embedding", "label", LN.one_vs_rest_tasks(classes), "squared_hinge")
    return d.where("is_test = 1").select("vec_id", "label", LN.largest(LN.decisions("embedding", w), classes).alias("pred"))


@register("fit_one_vs_one")
def q_l13(spark, sf):
    d = _class_vectors(spark, sf)
    classes = _classes(d)
    tasks = LN.one_vs_one_tasks(classes)
    w = LN.fit_linear(d.where("is_test = 0"), "embedding", "label", tasks, "squared_hinge")
    return d.where("is_test = 1").select("vec_id", "label", LN.vote(LN.decisions("embedding", w), tasks, classes).alias("pred"))


@register("prep_cluster_similarity")
def q_k5(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("lat"),
                                                  F.element_at("embedding", 2).cast("double").alias("lon"))
    x = LR.assemble(e, ["lat", "lon"]).cache()
    centres = LR.fit_kmeans_restarts(x, "features", k=8, restarts=10)
    out = rbf_features(e, ["lat", "lon"], centres, gamma=1.0)
    return out.select("vec_id", *[F.round(f"sim_{j}", 6).alias(f"sim_{j}") for j in range(len(centres))])


@register("prep_select_features")
def q_k9(spark, sf):
    x, feats = _features(spark, sf)
    m = RandomForestRegressor(numTrees=30, maxDepth=6, seed=42, featuresCol="features", labelCol="target").fit(x.where("is_test = 0"))
    imp = LR.importance_table(spark, feats, m.featureImportances.toArray())
    return LR.select_by_importance(imp)


@register("importance_model")
def q_m9(spark, sf):
    x, feats = _features(spark, sf)
    tr = x.where("is_test = 0").cache()
    rf = RandomForestRegressor(numTrees=30, maxDepth=6, seed=42, featuresCol="features", labelCol="target").fit(tr)
    lin = LinearRegression(featuresCol="features", labelCol="target", solver="normal").fit(tr)
    a = LR.importance_table(spark, feats, rf.featureImportances.toArray()).withColumn("kind", F.lit("impurity"))
    b = LR.importance_table(spark, feats, [abs(v) for v in lin.coefficients.toArray()]).withColumn("kind", F.lit("abs_coef"))
    return a.unionByName(b).orderBy("kind", F.desc("importance"), "feature")


@register("prep_scaling_effect")
def q_k11(spark, sf):
    """Same learner on raw and on standardised inputs, out-of-fold accuracy, delta."""
    e = _emb_features(spark, sf).withColumn("label", F.col("y").cast("int"))
    e = fold_stratified(e, "vec_id", "label", 3, 42).cache()
    res = []
    for name, scale in (("raw", False), ("scaled", True)):
        stages = []
        feat = "features"
        if scale:
            stages.append(StandardScaler(inputCol="features", outputCol="zf", withMean=True, withStd=True))
            feat = "zf"
        stages.append(LogisticRegression(featuresCol=feat, labelCol="y", maxIter=50, regParam=0.01))
        oof = LR.oof_predict(e, Pipeline(stages=stages), "fold", 3, ["vec_id", "y"])
        acc = oof.agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("acc")).first()["acc"]
        res.append((name, acc))
    (n1, a1), (n2, a2) = res
    return e.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(a1).alias("acc_raw"), F.lit(a2).alias("acc_scaled"),
                                                      F.lit(a2 - a1).alias("delta"))


@register("oof_predict", f"""WITH {SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)},
p AS (SELECT fold, count(doy + target) AS n, sum(doy) AS sx, sum(target) AS sy, sum(doy * doy) AS sxx, sum(doy * target) AS sxy
      FROM districts_kf GROUP BY fold),
c AS (SELECT fold, sum(n) OVER () - n AS n, sum(sx) OVER () - sx AS sx, sum(sy) OVER () - sy AS sy,
             sum(sxx) OVER () - sxx AS sxx, sum(sxy) OVER () - sxy AS sxy FROM p),
l AS (SELECT fold, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, sx, sy, n FROM c),
l2 AS (SELECT fold, slope, (sy - slope * sx) / n AS intercept FROM l)
SELECT d.row_id, CAST(d.fold AS INTEGER) AS fold, round(l2.intercept + l2.slope * d.doy, 6) AS pred FROM districts_kf d JOIN l2 USING (fold)""")
def q_i10(spark, sf):
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42).withColumn("doy", F.col("doy").cast("double"))
    o = LR.oof_simple_ols(d, "doy", "target", "fold")
    return o.select("row_id", F.col("fold").cast("int").alias("fold"), F.round("pred", 6).alias("pred"))


@register("oof_predict_ml")
def q_i10_ml(spark, sf):
    """I10 with an iterative learner: k fits, each scoring only its held-out fold."""
    x, _ = _features(spark, sf)
    x = fold_kfold_shuffled(x, "row_id", 5, 42).cache()
    est = LR.regressor("tree", maxDepth=5).setFeaturesCol("features").setLabelCol("target")
    o = LR.oof_predict(x, est, "fold", 5, ["row_id", "target"])
    return o.select("row_id", F.col("fold").cast("int").alias("fold"), F.col("prediction").alias("pred"))


SIZES = [0.1 + i * (0.9 / 7) for i in range(8)]


def _lc_sums():
    return ["n", "sx", "sy", "sxx", "sxy", "syy"]


LC_SQL = f"""WITH {SQL_DISTRICTS},
h AS (SELECT CAST(doy AS DOUBLE) AS x, target AS y, row_number() OVER (ORDER BY {sql_seeded_hash('row_id', 42)}, row_id) - 1 AS p,
             count(*) OVER () AS N FROM districts),
k AS (SELECT *, floor(N / 5) AS q, N - floor(N / 5) * 5 AS r FROM h),
f AS (SELECT *, CASE WHEN p < r * (q + 1) THEN floor(p / (q + 1)) ELSE r + floor((p - r * (q + 1)) / q) END AS fold FROM k),
sz AS (SELECT i AS si, 0.1 + i * (0.9 / 7) AS frac FROM range(0, 8) t(i)),
fi AS (SELECT i AS fi FROM range(0, 5) t(i)),
tr AS (SELECT fi.fi, sz.si, f.x, f.y, floor(sz.frac * (f.N - (f.q + CASE WHEN f.r > 0 THEN 1 ELSE 0 END))) AS m FROM f, fi, sz
       WHERE f.fold <> fi.fi AND (CASE WHEN f.p < fi.fi * f.q + least(fi.fi, f.r) THEN f.p
                                       ELSE f.p - (f.q + CASE WHEN fi.fi < f.r THEN 1 ELSE 0 END) END)
                                  < floor(sz.frac * (f.N - (f.q + CASE WHEN f.r > 0 THEN 1 ELSE 0 END)))),
ts AS (SELECT fi, si, max(m) AS m, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy
       FROM tr GROUP BY fi, si),
vs AS (SELECT fold AS fi, count(*) AS vn, sum(x) AS vx, sum(y) AS vy, sum(x * x) AS vxx, sum(x * y) AS vxy, sum(y * y) AS vyy FROM f GROUP BY fold),
l1 AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b FROM ts),
l2 AS (SELECT *, (sy - b * sx) / n AS a FROM l1),
e AS (SELECT l2.si, l2.m,
             sqrt(greatest(syy - 2 * a * sy - 2 * b * sxy + n * a * a + 2 * a * b * sx + b * b * sxx, 0.0) / n) AS tr_rmse,
             sqrt(greatest(vyy - 2 * a * vy - 2 * b * vxy + vn * a * a + 2 * a * b * vx + b * b * vxx, 0.0) / vn) AS va_rmse
      FROM l2 JOIN vs USING (fi)),
g AS (SELECT si, max(m) AS m, avg(tr_rmse) AS tm, stddev_pop(tr_rmse) AS tsd, avg(va_rmse) AS vm, stddev_pop(va_rmse) AS vsd FROM e GROUP BY si)
SELECT CAST(g.si AS INTEGER) AS size_idx, CAST(g.m AS INTEGER) AS n_train, round(sz.frac, 6) AS frac, round(tm, 6) AS train_rmse,
       round(tsd, 6) AS train_std, round(vm, 6) AS val_rmse, round(vsd, 6) AS val_std,
       CASE WHEN vm - tm > 0.05 THEN 'overfit' WHEN vm > 0.55 THEN 'underfit' ELSE 'calibrated' END AS verdict
FROM g JOIN sz USING (si)"""


@register("learning_curve", LC_SQL)
def q_i11(spark, sf):
    """Nested training subsets (first m rows of each fold's complement in
    seeded-hash order), closed-form line per (size, fold) from conditional sums
    in ONE pass; train and validation RMSE from the same sums."""
    k = 5
    d = districts(spark, sf).withColumn("doy", F.col("doy").cast("double"))
    d = hash_positions(d, "row_id", 42, out="p", total_out="N")
    q = F.floor(F.col("N") / k)
    r = F.col("N") - q * k
    fold = F.when(F.col("p") < r * (q + 1), F.floor(F.col("p") / (q + 1))).otherwise(r + F.floor((F.col("p") - r * (q + 1)) / q))
    d = d.withColumn("fold", fold.cast("int")).withColumn("q", q).withColumn("r", r)
    x, y = F.col("doy"), F.col("target")
    vals = {"n": F.lit(1.0), "sx": x, "sy": y, "sxx": x * x, "sxy": x * y, "syy": y * y}
    aggs = [F.first("N").alias("N"), F.first("q").alias("q"), F.first("r").alias("r")]
    for i in range(k):
        start = F.lit(i) * F.col("q") + F.least(F.lit(i), F.col("r"))
        size_i = F.col("q") + (F.lit(i) < F.col("r")).cast("long")
        rank_c = F.when(F.col("p") < start, F.col("p")).otherwise(F.col("p") - size_i)
        size_0 = F.col("q") + (F.col("r") > 0).cast("long")
        for si, s in enumerate(SIZES):
            m = F.floor(F.lit(s) * (F.col("N") - size_0))
            cond = (F.col("fold") != i) & (rank_c < m)
            for nm, v in vals.items():
                aggs.append(F.sum(F.when(cond, v)).alias(f"t_{i}_{si}_{nm}"))
        for nm, v in vals.items():
            aggs.append(F.sum(F.when(F.col("fold") == i, v)).alias(f"v_{i}_{nm}"))
    row = d.agg(*aggs).first()           # one row of sums, size k x sizes x 6
    out = []
    for si, s in enumerate(SIZES):
        tr_r, va_r = [], []
        for i in range(k):
            t = {nm: row[f"t_{i}_{si}_{nm}"] for nm in vals}
            v = {nm: row[f"v_{i}_{nm}"] for nm in vals}
            b = (t["n"] * t["sxy"] - t["sx"] * t["sy"]) / (t["n"] * t["sxx"] - t["sx"] ** 2)
            a = (t["sy"] - b * t["sx"]) / t["n"]

            def sse(z):
                return z["syy"] - 2 * a * z["sy"] - 2 * b * z["sxy"] + z["n"] * a * a + 2 * a * b * z["sx"] + b * b * z["sxx"]
            tr_r.append(max(sse(t), 0.0) / t["n"])
            va_r.append(max(sse(v), 0.0) / v["n"])
        import math
        tr_rmse = [math.sqrt(z) for z in tr_r]
        va_rmse = [math.sqrt(z) for z in va_r]
        mean = lambda z: sum(z) / len(z)
        std = lambda z: math.sqrt(sum((u - mean(z)) ** 2 for u in z) / len(z))
        out.append((si, s, int(t["n"]), mean(tr_rmse), std(tr_rmse), mean(va_rmse), std(va_rmse)))
    res = spark.createDataFrame(out, "size_idx int, frac double, n_train int, train_rmse double, train_std double, val_rmse double, val_std double")
    return res.withColumn("verdict", LR.learning_curve_verdict(F.col("val_rmse") - F.col("train_rmse"), F.col("val_rmse"))).select(
        "size_idx", "n_train", *[F.round(c, 6).alias(c) for c in ("frac", "train_rmse", "train_std", "val_rmse", "val_std")], "verdict")


@register("search_prep_and_model")
def q_m3(spark, sf):
    """Preprocessing options in the same search space, refit inside each fold."""
    d = split_random(districts(spark, sf), "row_id", 0.2, 42).where("is_test = 0").withColumn("doy", F.col("doy").cast("double"))
    d = fold_kfold_shuffled(d, "row_id", 3, 42).cache()
    rows = []
    for strategy in ("median", "mean"):
        for reg in (0.0, 0.1):
            pipe = Pipeline(stages=[Imputer(inputCols=["acctbal"], outputCols=["acctbal_i"], strategy=strategy),
                                    VectorAssembler(inputCols=["acctbal_i", "doy"], outputCol="features"),
                                    LinearRegression(featuresCol="features", labelCol="target", regParam=reg, solver="normal")])
            o = LR.oof_predict(d, pipe, "fold", 3, ["row_id", "target"])
            per = o.groupBy("fold").agg(F.sqrt(F.avg((F.col("prediction") - F.col("target")) ** 2)).alias("rmse"))
            r = per.agg(F.avg("rmse").alias("m"), F.stddev_pop("rmse").alias("s")).first()
            rows.append((f"impute={strategy}|reg={reg}", r["m"], r["s"]))
    return spark.createDataFrame(rows, "cand_key string, cv_rmse double, cv_std double")
