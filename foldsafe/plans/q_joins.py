"""Registered queries: joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.operators import joins as J
from foldsafe.operators.metrics import eval_rmse_ci, t_quantile_sql
from foldsafe.operators.splits import fold_kfold_shuffled, split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, SQL_RUNS, districts, runs
from foldsafe.plans.sqlutil import kfold_sql, random_split_sql
from foldsafe.session import read_table


@register("join_semi_index", f"""WITH {SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)}
SELECT row_id, doy, priority FROM districts WHERE row_id IN (SELECT row_id FROM districts_rsplit WHERE is_test = 1)""")
def q_d1(spark, sf):
    d = districts(spark, sf)
    test_keys = split_random(d.select("row_id"), "row_id", 0.2, 42).where("is_test = 1")
    return J.semi_by_key(d, test_keys, "row_id").select("row_id", "doy", "priority")


@register("join_run_model", """
SELECT l.doc_id, d.lang, d.source, CAST(l.quality AS INTEGER) AS quality, CAST(l.toxic AS INTEGER) AS toxic,
       (SELECT count(*) FROM labels x WHERE x.doc_id NOT IN (SELECT doc_id FROM documents)) AS n_orphans
FROM labels l JOIN documents d USING (doc_id)""")
def q_d2(spark, sf):
    lab = read_table(spark, sf, "labels")
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    orphans = J.missing_required(lab, docs, "doc_id").count()      # must be 0: a label without its record
    j = J.inner_required(lab, docs, "doc_id")
    return j.select("doc_id", "lang", "source", F.col("quality").cast("int").alias("quality"),
                    F.col("toxic").cast("int").alias("toxic"), F.lit(orphans).cast("bigint").alias("n_orphans"))


CAND_SQL = f"""{SQL_RUNS},
cands AS (SELECT DISTINCT kernel || '|' || CAST(CAST(c AS BIGINT) AS VARCHAR) AS cand_key FROM runs),
done AS (SELECT DISTINCT kernel || '|' || CAST(CAST(c AS BIGINT) AS VARCHAR) AS cand_key FROM runs
         WHERE status = 'FINISHED' AND ts < TIMESTAMP '2024-01-03 00:00:00')"""


def _cands(spark, sf):
    r = runs(spark, sf).withColumn("cand_key", F.concat_ws("|", "kernel", F.col("c").cast("bigint").cast("string")))
    cands = r.select("cand_key").distinct()
    done = r.where((F.col("status") == "FINISHED") & (F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))).select("cand_key").distinct()
    return cands, done


@register("join_anti_resume", f"WITH {CAND_SQL} SELECT cand_key FROM cands WHERE cand_key NOT IN (SELECT cand_key FROM done)")
def q_d3(spark, sf):
    cands, done = _cands(spark, sf)
    return J.anti_resume(cands, done)


RBF_SQL = """g AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon, CAST(label AS INTEGER) AS label FROM embeddings),
c AS (SELECT label AS j, avg(lat) AS clat, avg(lon) AS clon FROM g GROUP BY label)"""


@register("join_cross_rbf", f"""WITH {RBF_SQL}
SELECT g.vec_id, {', '.join(f"round(max(CASE WHEN c.j = {j} THEN exp(-4.0 * ((g.lat - c.clat) ^ 2 + (g.lon - c.clon) ^ 2)) END), 6) AS sim_{j}" for j in range(10))}
FROM g, c GROUP BY g.vec_id""")
def q_d7(spark, sf):
    e = read_table(spark, sf, "embeddings")
    g = e.select("vec_id", F.element_at("embedding", 1).cast("double").alias("lat"),
                 F.element_at("embedding", 2).cast("double").alias("lon"), F.col("label").cast("int").alias("label"))
    centres = g.groupBy("label").agg(F.avg("lat").alias("a"), F.avg("lon").alias("b")).collect()  # <= #labels rows
    by_label = {r["label"]: (r["a"], r["b"]) for r in centres}
    cs = [by_label[j] for j in range(10)]
    out = J.rbf_features(g, ["lat", "lon"], cs, 4.0)
    return out.select("vec_id", *[F.round(f"sim_{j}", 6).alias(f"sim_{j}") for j in range(10)])


@register("join_parity", f"""WITH {SQL_DISTRICTS},
f AS (SELECT regr_slope(target, doy) AS s, regr_intercept(target, doy) AS i FROM districts),
e AS (SELECT row_id, f.i + f.s * doy AS v FROM districts, f),
a AS (SELECT row_id, CAST(CAST(f.i AS FLOAT) + CAST(f.s AS FLOAT) * CAST(doy AS FLOAT) AS DOUBLE) AS v FROM districts, f),
j AS (SELECT e.v AS ev, a.v AS av FROM e FULL OUTER JOIN a USING (row_id))
SELECT count(*) AS n, round(max(abs(ev - av)), 6) AS max_dev, round(avg(abs(ev - av)), 6) AS mean_dev,
       CAST(count_if(abs(ev - av) > 0.0001) AS BIGINT) AS n_fail, CAST(count_if(ev IS NULL OR av IS NULL) AS BIGINT) AS n_unmatched FROM j""")
def q_d8(spark, sf):
    """Parity of a float64 scorer against a float32 re-implementation of the
    same line over every row (full outer join: rows missing on either side
    would be counted as unmatched)."""
    d = districts(spark, sf)
    fit = d.agg(F.regr_slope("target", "doy").alias("s"), F.regr_intercept("target", "doy").alias("i")).first()
    exp_ = d.select("row_id", (F.lit(fit["i"]) + F.lit(fit["s"]) * F.col("doy")).alias("v"))
    act = d.select(
        "row_id", (F.lit(fit["i"]).cast("float") + F.lit(fit["s"]).cast("float") * F.col("doy").cast("float")).cast("double").alias("v"))
    p = J.parity(exp_, act, "row_id", "v", 1e-4)
    return p.select("n", F.round("max_dev", 6).alias("max_dev"), F.round("mean_dev", 6).alias("mean_dev"), "n_fail", "n_unmatched")


@register("join_interval_overlap", f"""WITH {SQL_DISTRICTS},
m AS (SELECT segment, avg(target) AS pred FROM districts GROUP BY segment),
s AS (SELECT d.priority, (m.pred - d.target) ^ 2 AS se FROM districts d JOIN m USING (segment)),
a AS (SELECT priority, avg(se) AS mm, stddev_samp(se) AS ss, count(se) AS n FROM s GROUP BY priority),
ci AS (SELECT priority, sqrt(mm) AS rmse, sqrt(greatest(0.0, mm - {t_quantile_sql('n - 1')} * ss / sqrt(n))) AS lo,
              sqrt(mm + {t_quantile_sql('n - 1')} * ss / sqrt(n)) AS hi FROM a),
b AS (SELECT arg_min(lo, rmse) AS blo, arg_min(hi, rmse) AS bhi FROM ci)
SELECT priority, round(rmse, 6) AS rmse, CAST(NOT (lo > bhi OR hi < blo) AS INTEGER) AS overlaps_best FROM ci, b""")
def q_d9(spark, sf):
    d = districts(spark, sf)
    m = d.groupBy("segment").agg(F.avg("target").alias("pred"))
    ci = eval_rmse_ci(d.join(bounded(m), "segment"), "pred", "target", by=["priority"])
    o = J.interval_overlap(ci, "rmse_lo", "rmse_hi", "rmse")
    return o.select("priority", F.round("rmse", 6).alias("rmse"), "overlaps_best")


@register("join_paired_delta", f"""WITH {SQL_RUNS},
g AS (SELECT search_id, CAST(c AS BIGINT) AS c, max(CASE WHEN kernel = 'click' THEN cv_rmse END) AS score_a,
             max(CASE WHEN kernel = 'view' THEN cv_rmse END) AS score_b FROM runs GROUP BY 1, 2)
SELECT search_id, c, round(score_a, 6) AS score_a, round(score_b, 6) AS score_b, round(score_b - score_a, 6) AS delta,
       CAST(score_b - score_a < 0 AS INTEGER) AS improves
FROM g WHERE score_a IS NOT NULL AND score_b IS NOT NULL""")
def q_d10(spark, sf):
    r = runs(spark, sf).withColumn("c", F.col("c").cast("bigint"))
    p = J.paired_delta(r, ["search_id", "c"], "kernel", "click", "view", "cv_rmse")
    return p.select("search_id", "c", F.round("score_a", 6).alias("score_a"), F.round("score_b", 6).alias("score_b"),
                    F.round("delta", 6).alias("delta"), (F.col("delta") < 0).cast("int").alias("improves"))


@register("join_feature_target", f"""WITH {SQL_DISTRICTS}
SELECT d.row_id, d.doy, d.segment, round(o.o_totalprice / 100000.0, 9) AS target
FROM districts d JOIN orders o ON o.o_orderkey = d.row_id""")
def q_d11(spark, sf):
    feats = districts(spark, sf).select("row_id", "doy", "segment")
    tgt = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"),
                                                F.round(F.col("o_totalprice") / 100000.0, 9).alias("target"))
    return feats.join(tgt, "row_id", "inner")


SH = 8


def _shift_sql(dy, dx):
    return (f"list_transform(range(0, {SH * SH}), lambda i: CASE WHEN i // {SH} - {dy} >= 0 AND i // {SH} - {dy} < {SH} AND "
            f"i % {SH} - {dx} >= 0 AND i % {SH} - {dx} < {SH} THEN round(CAST(embedding[((i // {SH} - {dy}) * {SH} + (i % {SH} - {dx})) + 1] AS DOUBLE), 6) ELSE 0.0 END)")


@register("set_union_augment", " UNION ALL ".join(
    f"SELECT vec_id, CAST(label AS INTEGER) AS label, {dy} AS dy, {dx} AS dx, {_shift_sql(dy, dx)} AS embedding FROM embeddings"
    for dy, dx in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))))
def q_h1(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("int").alias("label"), "embedding")
    a = J.augment_shifts(e, "embedding", SH, SH)
    return a.select("vec_id", "label", "dy", "dx", F.transform("embedding", lambda x: F.round(x.cast("double"), 6)).alias("embedding"))


@register("set_stack_labels", """
SELECT vec_id, [CAST(label >= 7 AS INTEGER), CAST(label % 2 = 1 AS INTEGER)] AS labels FROM embeddings""")
def q_h2(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", F.array((F.col("label") >= 7).cast("int"), (F.col("label") % 2 == 1).cast("int")).alias("labels"))


@register("set_union_oof", f"""WITH {SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)},
fm AS (SELECT f.fold, d.segment, avg(d.target) AS pred FROM (SELECT DISTINCT fold FROM districts_kf) f
       JOIN districts_kf d ON d.fold <> f.fold GROUP BY f.fold, d.segment)
SELECT d.row_id, d.fold, round(fm.pred, 9) AS pred FROM districts_kf d JOIN fm ON fm.fold = d.fold AND fm.segment = d.segment""")
def q_h3(spark, sf):
    """Out-of-fold segment means: fold i is scored by means fitted on the other
    folds (per-fold sums once, complement = total - part), then the per-fold
    outputs are one bag union."""
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42).cache()
    parts = d.groupBy("fold", "segment").agg(F.sum("target").alias("s"), F.count("target").alias("n"))
    tot = parts.groupBy("segment").agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    comp = parts.join(bounded(tot), "segment").select("fold", "segment", ((F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n"))).alias("pred"))
    outs = [d.where(F.col("fold") == i).join(bounded(comp.where(F.col("fold") == i).drop("fold")), "segment")
             .select("row_id", "fold", F.round("pred", 9).alias("pred")) for i in range(5)]
    return J.union_folds(outs)
