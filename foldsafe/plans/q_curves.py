"""Registered queries: confusion family and threshold curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.operators import curves as CV
from foldsafe.plans.catalog import register
from foldsafe.session import read_table

SCORES_SQL = """s AS (SELECT value AS score, sum(CAST(event_type = 'purchase' AS BIGINT)) AS pos,
                      sum(1 - CAST(event_type = 'purchase' AS BIGINT)) AS neg FROM events GROUP BY value),
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM s)"""


def _scored(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select(F.col("value").alias("score"), (F.col("event_type") == "purchase").cast("int").alias("label"))


# Confusion stand-in: real = embedding label, pred = a deterministic rule on the vector.
CONF_SQL = """p AS (SELECT CAST(label AS INTEGER) AS real,
                 CAST(floor((embedding[1] + 1.0) * 5) AS INTEGER) % 10 AS pred FROM embeddings)"""


def _conf_input(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select(F.col("label").cast("int").alias("real"),
                    (F.floor((F.element_at("embedding", 1).cast("double") + 1.0) * 5).cast("int") % 10).alias("pred"))


@register("eval_confusion", f"""WITH {CONF_SQL},
l AS (SELECT real AS v FROM p UNION SELECT pred FROM p),
g AS (SELECT a.v AS real, b.v AS pred FROM l a, l b),
n AS (SELECT real, pred, count(*) AS n FROM p GROUP BY 1, 2)
SELECT g.real, g.pred, CAST(coalesce(n.n, 0) AS BIGINT) AS n FROM g LEFT JOIN n USING (real, pred)""")
def q_e8(spark, sf):
    return CV.eval_confusion(_conf_input(spark, sf), "real", "pred")


CONF_NORM_SQL = f"""{CONF_SQL},
l AS (SELECT real AS v FROM p UNION SELECT pred FROM p),
g AS (SELECT a.v AS real, b.v AS pred FROM l a, l b),
n AS (SELECT real, pred, count(*) AS n FROM p GROUP BY 1, 2),
cm AS (SELECT g.real, g.pred, CAST(coalesce(n.n, 0) AS BIGINT) AS n FROM g LEFT JOIN n USING (real, pred)),
r AS (SELECT real, pred, n, CASE WHEN real = pred THEN 0.0
                    ELSE coalesce(n / nullif(sum(n) OVER (PARTITION BY real), 0), 0.0) END AS rate FROM cm)"""


@register("eval_confusion_norm", f"WITH {CONF_NORM_SQL} SELECT real, pred, n, round(rate, 6) AS rate FROM r")
def q_e10(spark, sf):
    r = CV.eval_confusion_norm(CV.eval_confusion(_conf_input(spark, sf), "real", "pred"))
    return r.withColumn("rate", F.round("rate", 6))


@register("win_share_of_row", f"""WITH {CONF_NORM_SQL}
SELECT real, pred, n, round(n / sum(n) OVER (PARTITION BY real), 6) AS share FROM cm""")
def q_f5(spark, sf):
    from pyspark.sql import Window
    c = CV.eval_confusion(_conf_input(spark, sf), "real", "pred")
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("real")), 6))


@register("top_confusions", f"""WITH {CONF_NORM_SQL}
SELECT real, pred, round(rate, 6) AS rate FROM r WHERE real <> pred
ORDER BY rate DESC, real DESC, pred DESC LIMIT 5""")
def q_g2(spark, sf):
    r = CV.eval_confusion_norm(CV.eval_confusion(_conf_input(spark, sf), "real", "pred")).where("real <> pred")
    return r.orderBy(F.desc("rate"), F.desc("real"), F.desc("pred")).limit(5).select("real", "pred", F.round("rate", 6).alias("rate"))


@register("win_running_counts", f"""WITH {SCORES_SQL}
SELECT score, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(P AS BIGINT) AS P, CAST(N AS BIGINT) AS N FROM c""")
def q_f4(spark, sf):
    st = CV.score_table(_scored(spark, sf), "score", "label")
    return CV.suffix_counts(st).select("score", "pos", "neg", "tp", "fp", "P", "N")


@register("eval_pr_curve", f"""WITH {SCORES_SQL}
SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(coalesce(tp / nullif(P, 0), 0.0), 6) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_e12(spark, sf):
    c = CV.eval_pr_curve(_scored(spark, sf), "score", "label")
    return c.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@register("eval_threshold_at_precision", f"""WITH {SCORES_SQL},
pr AS (SELECT score AS threshold, tp / (tp + fp) AS precision, coalesce(tp / nullif(P, 0), 0.0) AS recall FROM c),
t AS (SELECT CAST(target AS DOUBLE) AS target FROM (VALUES (0.2), (0.25), (0.5), (0.99)) v(target))
SELECT t.target, b.threshold, round(b.precision, 6) AS precision, round(b.recall, 6) AS recall
FROM t LEFT JOIN LATERAL (SELECT * FROM pr WHERE pr.precision >= t.target ORDER BY threshold LIMIT 1) b ON TRUE""")
def q_e13(spark, sf):
    curve = CV.eval_pr_curve(_scored(spark, sf), "score", "label").cache()
    out = None
    for t in (0.2, 0.25, 0.5, 0.99):
        r = CV.eval_threshold_at_precision(curve, t)
        out = r if out is None else out.unionByName(r)
    return out.select("target", "threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@register("eval_roc_auc", f"""WITH {SCORES_SQL}
SELECT round(sum(neg * ((tp - pos) + pos / 2.0)) / (max(P) * max(N)), 9) AS auc, CAST(max(P) AS BIGINT) AS n_pos, CAST(max(N) AS BIGINT) AS n_neg FROM c""")
def q_e14(spark, sf):
    a = CV.eval_roc_auc(_scored(spark, sf), "score", "label")
    return a.select(F.round("auc", 9).alias("auc"), "n_pos", "n_neg")


@register("eval_roc_points", f"""WITH {SCORES_SQL}
SELECT score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM c""")
def q_e14b(spark, sf):
    r = CV.eval_roc(_scored(spark, sf), "score", "label")
    return r.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))
