"""Registered queries: nearest-neighbour joins and learners built on them
(D4-D6, L6, L7, L14, L15, K6, E11, E19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.functions.scalars import quantize_vector
from foldsafe.operators import knn as K
from foldsafe.operators.splits import fold_kfold_shuffled, split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.sqlutil import kfold_sql, random_split_sql
from foldsafe.session import read_table

D2_64 = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda t: (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE)) ^ 2))"
D2_2 = "((CAST(a.embedding[1] AS DOUBLE) - CAST(b.embedding[1] AS DOUBLE)) ^ 2 + (CAST(a.embedding[2] AS DOUBLE) - CAST(b.embedding[2] AS DOUBLE)) ^ 2)"


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings")


def _geo(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", F.element_at("embedding", 1).cast("double").alias("lat"),
                    F.element_at("embedding", 2).cast("double").alias("lon"), F.col("label").cast("int").alias("label"))


def loo_knn_sql(k: int, dist: str = D2_64, extra: str = "") -> str:
    return f"""nb AS (SELECT * FROM (
  SELECT a.vec_id, b.vec_id AS nn_vec_id, CAST(b.label AS INTEGER) AS nn_label, {dist} AS dist2,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {dist}, b.vec_id) AS rank
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id {extra}) WHERE rank <= {k})"""


@register("join_knn", f"""WITH {loo_knn_sql(5)}
SELECT vec_id, CAST(rank AS INTEGER) AS rank, nn_vec_id, round(dist2, 6) AS dist2 FROM nb""")
def q_d6(spark, sf):
    e = _emb(spark, sf)
    nb = K.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, exclude_self=True)
    return nb.select("vec_id", "rank", "nn_vec_id", F.round("dist2", 6).alias("dist2"))


GEO_SPLIT_SQL = f"""g AS (SELECT vec_id, embedding, CAST(label AS INTEGER) AS label FROM embeddings),
{random_split_sql('g', 'vec_id', 0.2, 42)}"""


@register("join_nearest_one", f"""WITH {GEO_SPLIT_SQL},
p AS (SELECT a.vec_id, b.vec_id AS nn_vec_id, b.label AS nn_label, {D2_2} AS dist2,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY {D2_2}, b.vec_id) AS rn
      FROM g_rsplit a, g_rsplit b WHERE a.is_test = 1 AND b.is_test = 0)
SELECT vec_id, nn_vec_id, nn_label, round(dist2, 9) AS dist2 FROM p WHERE rn = 1""")
def q_d4(spark, sf):
    g = split_random(_geo(spark, sf), "vec_id", 0.2, 42)
    nb = K.knn_join(g.where("is_test = 1"), g.where("is_test = 0"), "vec_id", "vec_id", ["lat", "lon"], 1, carry=["label"])
    return nb.select("vec_id", "nn_vec_id", F.col("label").alias("nn_label"), F.round("dist2", 9).alias("dist2"))


@register("join_nearest_radius", f"""WITH {GEO_SPLIT_SQL},
p AS (SELECT a.vec_id, b.vec_id AS nn_vec_id, {D2_2} AS dist2,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY {D2_2}, b.vec_id) AS rn
      FROM g_rsplit a, g_rsplit b WHERE a.is_test = 1 AND b.is_test = 0)
SELECT t.vec_id, CASE WHEN p.dist2 < 0.0025 THEN p.nn_vec_id END AS nn_vec_id,
       CASE WHEN p.dist2 < 0.0025 THEN round(p.dist2, 9) END AS dist2
FROM g_rsplit t JOIN p ON p.vec_id = t.vec_id AND p.rn = 1 WHERE t.is_test = 1""")
def q_d5(spark, sf):
    """1-NN within radius 0.05 (d² < 0.0025), else no match: the exact 1-NN
    join followed by the radius test, so a dense cell never multiplies pairs."""
    g = split_random(_geo(spark, sf), "vec_id", 0.2, 42)
    nb = K.knn_join(g.where("is_test = 1"), g.where("is_test = 0"), "vec_id", "vec_id", ["lat", "lon"], 1)
    inside = F.col("dist2") < 0.0025
    return nb.select("vec_id", F.when(inside, F.col("nn_vec_id")).alias("nn_vec_id"),
                     F.when(inside, F.round("dist2", 9)).alias("dist2"))


@register("fit_knn_regress", f"""WITH {loo_knn_sql(5, D2_2)},
w AS (SELECT vec_id, avg(nn_label) AS pred_uniform,
             CASE WHEN count_if(dist2 = 0) > 0 THEN avg(CASE WHEN dist2 = 0 THEN nn_label END)
                  ELSE sum(nn_label / sqrt(dist2)) / sum(1 / sqrt(dist2)) END AS pred_distance FROM nb GROUP BY vec_id)
SELECT vec_id, round(pred_uniform, 6) AS pred_uniform, round(pred_distance, 6) AS pred_distance FROM w""")
def q_l6(spark, sf):
    g = _geo(spark, sf)
    nb = K.knn_join(g, g, "vec_id", "vec_id", ["lat", "lon"], 5, exclude_self=True, carry=["label"]).cache()
    u = K.knn_regress(nb, "vec_id", "label", "uniform").withColumnRenamed("pred", "pred_uniform")
    d = K.knn_regress(nb, "vec_id", "label", "distance").withColumnRenamed("pred", "pred_distance")
    return u.join(d, "vec_id").select("vec_id", F.round("pred_uniform", 6).alias("pred_uniform"),
                                      F.round("pred_distance", 6).alias("pred_distance"))


def _vote_sql(k: int, weights: str) -> str:
    w = "1.0" if weights == "uniform" else "CASE WHEN hit = 1 THEN CAST(dist2 = 0 AS DOUBLE) ELSE 1 / sqrt(dist2) END"
    return f"""SELECT vec_id, {k} AS k, '{weights}' AS weights, arg_min(nn_label, (-s, nn_label)) AS pred FROM (
      SELECT vec_id, nn_label, sum({w}) AS s FROM (
        SELECT *, max(CAST(dist2 = 0 AS INTEGER)) OVER (PARTITION BY vec_id) AS hit FROM nb WHERE rank <= {k})
      GROUP BY vec_id, nn_label) GROUP BY vec_id"""


@register("fit_knn_classify", f"""WITH {loo_knn_sql(5)},
v AS ({' UNION ALL '.join(_vote_sql(k, w) for k in (3, 4, 5) for w in ('uniform', 'distance'))})
SELECT CAST(k AS INTEGER) AS k, weights, round(avg(CAST(v.pred = CAST(e.label AS INTEGER) AS DOUBLE)), 6) AS accuracy, count(*) AS n
FROM v JOIN embeddings e USING (vec_id) GROUP BY k, weights""")
def q_l7(spark, sf):
    e = _emb(spark, sf)
    nb = K.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, exclude_self=True, carry=["label"]).cache()
    truth = e.select("vec_id", F.col("label").cast("int").alias("truth"))
    out = None
    for k in (3, 4, 5):
        for w in ("uniform", "distance"):
            p = K.knn_classify(nb.where(F.col("rank") <= k), "vec_id", "label", w)
            a = p.join(truth, "vec_id").agg(F.round(F.avg((F.col("pred") == F.col("truth")).cast("double")), 6).alias("accuracy"),
                                            F.count(F.lit(1)).alias("n"))
            a = a.select(F.lit(k).alias("k"), F.lit(w).alias("weights"), "accuracy", "n")
            out = a if out is None else out.unionByName(a)
    return out


ML_SQL = f"""{loo_knn_sql(5)},
lab AS (SELECT vec_id, CAST(label >= 7 AS INTEGER) AS y0, CAST(label % 2 = 1 AS INTEGER) AS y1 FROM embeddings),
pr AS (SELECT nb.vec_id, CAST(sum(l.y0) * 2 > count(*) AS INTEGER) AS p0, CAST(sum(l.y1) * 2 > count(*) AS INTEGER) AS p1
       FROM nb JOIN lab l ON l.vec_id = nb.nn_vec_id GROUP BY nb.vec_id),
j AS (SELECT t.*, pr.p0, pr.p1 FROM lab t JOIN pr USING (vec_id)),
per AS (SELECT 0 AS label_idx, sum(y0 * p0) AS tp, sum((1 - y0) * p0) AS fp, sum(y0 * (1 - p0)) AS fn, sum(y0) AS support FROM j
        UNION ALL SELECT 1, sum(y1 * p1), sum((1 - y1) * p1), sum(y1 * (1 - p1)), sum(y1) FROM j),
f AS (SELECT *, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM per)"""


@register("fit_knn_multilabel", f"""WITH {ML_SQL}
SELECT CAST(label_idx AS INTEGER) AS label_idx, CAST(support AS BIGINT) AS support, round(f1, 6) AS f1 FROM f""")
def q_l14(spark, sf):
    per, _ = _multilabel(spark, sf)
    return per.select("label_idx", "support", F.round("f1", 6).alias("f1"))


@register("eval_multilabel_f1", f"""WITH {ML_SQL}
SELECT round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM f""")
def q_e11(spark, sf):
    _, summ = _multilabel(spark, sf)
    return summ


def _multilabel(spark, sf):
    from foldsafe.operators.multilabel import eval_multilabel_f1, knn_multilabel_vote
    e = _emb(spark, sf)
    lab = e.select("vec_id", F.array((F.col("label") >= 7).cast("int"), (F.col("label") % 2 == 1).cast("int")).alias("labels"))
    nb = K.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, exclude_self=True)
    pred = knn_multilabel_vote(nb, lab, "vec_id")
    return eval_multilabel_f1(pred.join(lab, "vec_id"), "labels", "pred")


@register("fit_knn_multioutput", f"""WITH {loo_knn_sql(5)},
q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(greatest(0, least(255, round((x + 1.0) / 2.0 * 255))) AS INTEGER)) AS px FROM embeddings),
el AS (SELECT nb.vec_id, u.i, u.v FROM nb JOIN q ON q.vec_id = nb.nn_vec_id,
       LATERAL (SELECT unnest(range(0, len(q.px))) AS i, unnest(q.px) AS v) u),
m AS (SELECT vec_id, i, arg_min(v, (-n, v)) AS v FROM (SELECT vec_id, i, v, count(*) AS n FROM el GROUP BY ALL) GROUP BY ALL),
pv AS (SELECT vec_id, list(v ORDER BY i) AS denoised FROM m GROUP BY vec_id)
SELECT pv.vec_id, pv.denoised,
       round(list_sum(list_transform(list_zip(pv.denoised, q.px), lambda t: abs(t[1] - t[2]))) / len(q.px), 6) AS mae
FROM pv JOIN q USING (vec_id)""")
def q_l15(spark, sf):
    from foldsafe.operators.multilabel import knn_multioutput_mode
    e = _emb(spark, sf)
    px = e.select("vec_id", F.transform(quantize_vector("embedding"), lambda x: x.cast("int")).alias("px"))
    nb = K.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, exclude_self=True)
    den = knn_multioutput_mode(nb, px, "vec_id", "px")
    j = den.join(px, "vec_id")
    mae = F.aggregate(F.zip_with("denoised", "px", lambda a, b: F.abs(a - b)), F.lit(0), lambda s, x: s + x) / F.size("px")
    return j.select("vec_id", "denoised", F.round(mae, 6).alias("mae"))


OOF_SQL = f"""g AS (SELECT vec_id, embedding, CAST(label AS INTEGER) AS label FROM embeddings),
{random_split_sql('g', 'vec_id', 0.2, 42)},
tr AS (SELECT vec_id, embedding, label FROM g_rsplit WHERE is_test = 0),
{kfold_sql('tr', 'vec_id', 5, 42)},
q AS (SELECT vec_id, embedding, fold, 0 AS is_test FROM tr_kf
      UNION ALL SELECT vec_id, embedding, -1 AS fold, 1 AS is_test FROM g_rsplit WHERE is_test = 1),
p AS (SELECT a.vec_id, a.is_test, b.label AS nl,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY {D2_2}, b.vec_id) AS rn
      FROM q a, tr_kf b WHERE a.fold <> b.fold),
oof AS (SELECT vec_id, is_test, avg(nl) AS knn_oof FROM p WHERE rn <= 5 GROUP BY vec_id, is_test),
pin AS (SELECT a.vec_id, b.label AS nl,
             row_number() OVER (PARTITION BY a.vec_id ORDER BY {D2_2}, b.vec_id) AS rn FROM g a, g b),
inf AS (SELECT vec_id, avg(nl) AS knn_in FROM pin WHERE rn <= 5 GROUP BY vec_id)"""


@register("prep_oof_target_knn", f"""WITH {OOF_SQL}
SELECT vec_id, CAST(is_test AS INTEGER) AS is_test, round(knn_oof, 6) AS knn_oof FROM oof""")
def q_k6(spark, sf):
    return _oof_knn(spark, sf).select("vec_id", "is_test", F.round("knn_oof", 6).alias("knn_oof"))


def _oof_knn(spark, sf):
    """K6: training rows get the kNN target mean over the OTHER folds of the
    training rows; new (test) rows over all training rows.  One kNN join does
    both: test rows carry fold -1, which differs from every training fold."""
    g = split_random(_geo(spark, sf), "vec_id", 0.2, 42)
    train = fold_kfold_shuffled(g.where("is_test = 0"), "vec_id", 5, 42)
    test = g.where("is_test = 1").withColumn("fold", F.lit(-1))
    q = train.unionByName(test)
    nb = K.knn_join(q, train, "vec_id", "vec_id", ["lat", "lon"], 5, q_group="fold", r_group="fold",
                    group_mode="different", carry=["label"])
    feat = K.knn_regress(nb, "vec_id", "label").withColumnRenamed("pred", "knn_oof")
    return feat.join(q.select("vec_id", F.col("is_test").cast("int").alias("is_test")), "vec_id")


@register("agg_leak_check", f"""WITH {OOF_SQL}
SELECT round(corr(i.knn_in, g.label), 6) AS corr_in_fold, round(corr(o.knn_oof, g.label), 6) AS corr_out_of_fold
FROM g JOIN oof o USING (vec_id) JOIN inf i USING (vec_id)""")
def q_e19(spark, sf):
    g = _geo(spark, sf)
    oof = _oof_knn(spark, sf)
    nb_in = K.knn_join(g, g, "vec_id", "vec_id", ["lat", "lon"], 5, carry=["label"])   # the leaky version sees itself
    inf = K.knn_regress(nb_in, "vec_id", "label").withColumnRenamed("pred", "knn_in")
    j = g.join(oof, "vec_id").join(inf, "vec_id")
    return j.agg(F.round(F.corr("knn_in", "label"), 6).alias("corr_in_fold"),
                 F.round(F.corr("knn_oof", "label"), 6).alias("corr_out_of_fold"))
