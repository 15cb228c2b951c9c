"""Registered queries: filters, windows, sort/top-k."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.operators import filters as FL
from foldsafe.operators.stats import agg_corr_matrix
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, SQL_RUNS, districts, runs
from foldsafe.session import read_table


@register("flt_confusion_cell", """
WITH p AS (SELECT vec_id, CAST(label AS INTEGER) AS real,
                  CAST(floor((embedding[1] + 1.0) * 5) AS INTEGER) % 10 AS pred FROM embeddings),
f AS (SELECT *, row_number() OVER (PARTITION BY real, pred ORDER BY vec_id) AS rn FROM p
      WHERE (real = 3 AND pred = 3) OR (real = 3 AND pred = 5) OR (real = 5 AND pred = 3) OR (real = 5 AND pred = 5))
SELECT vec_id, real, pred, rn FROM f WHERE rn <= 5""")
def q_c1(spark, sf):
    e = read_table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("int").alias("real"),
        (F.floor((F.element_at("embedding", 1).cast("double") + 1.0) * 5).cast("int") % 10).alias("pred"))
    r = FL.first_n_per_cell(e, [(3, 3), (3, 5), (5, 3), (5, 5)], "real", "pred", "vec_id", 5)
    return r.select("vec_id", "real", "pred", F.col("rn").cast("bigint").alias("rn"))


@register("flt_facets", f"""WITH {SQL_DISTRICTS}
SELECT segment, priority, count(*) AS n, round(avg(target), 9) AS mean_target FROM districts
WHERE segment IN ('BUILDING', 'MACHINERY') GROUP BY 1, 2""")
def q_c2(spark, sf):
    d = FL.facet_filter(districts(spark, sf), {"segment": ["BUILDING", "MACHINERY"], "priority": []})
    return d.groupBy("segment", "priority").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("target"), 9).alias("mean_target"))


@register("flt_best_runs", f"""WITH {SQL_RUNS},
f AS (SELECT * FROM runs WHERE status = 'FINISHED' AND cv_rmse IS NOT NULL AND kernel LIKE 'p%')
SELECT search_id, count(*) AS n_runs, round(min(cv_rmse), 6) AS cv_rmse, arg_min(run_id, (cv_rmse, run_id)) AS run_id
FROM f GROUP BY search_id""")
def q_c3(spark, sf):
    b = FL.best_runs(runs(spark, sf), "cv_rmse", name_prefix="p")
    return b.select("search_id", "n_runs", F.round("cv_rmse", 6).alias("cv_rmse"), "run_id")


@register("flt_first_n", f"""WITH {SQL_DISTRICTS}
SELECT row_id, round(target, 9) AS target FROM districts ORDER BY row_id LIMIT 100""")
def q_c4(spark, sf):
    return FL.first_n(districts(spark, sf), "row_id", 100).select("row_id", F.round("target", 9).alias("target"))


@register("flt_budget", f"""WITH {SQL_RUNS}
SELECT run_id, CAST(seconds > 400 AS INTEGER) AS skipped,
       CASE WHEN seconds > 400 THEN printf('projected %.1f > cap %.1f', seconds, 400.0) END AS reason FROM runs""")
def q_c6(spark, sf):
    return FL.flag_budget(runs(spark, sf), "seconds", 400.0).select("run_id", "skipped", "reason")


@register("win_rank_candidates", f"""WITH {SQL_RUNS}
SELECT search_id, run_id, round(cv_rmse, 6) AS cv_rmse,
       CAST(rank() OVER (PARTITION BY search_id ORDER BY round(cv_rmse, 6)) AS INTEGER) AS rank FROM runs""")
def q_f1(spark, sf):
    r = runs(spark, sf).withColumn("cv_rmse", F.round("cv_rmse", 6))
    return FL.rank_candidates(r, "cv_rmse").select("search_id", "run_id", "cv_rmse", F.col("rank").cast("int").alias("rank"))


@register("win_topk_per_query", """
SELECT user_id, event_id, round(value, 6) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 3""")
def q_f2(spark, sf):
    e = read_table(spark, sf, "events")
    t = FL.topk_per_group(e, ["user_id"], [F.desc("value"), F.asc("event_id")], 3)
    return t.select("user_id", "event_id", F.round("value", 6).alias("value"), F.col("rank").cast("int").alias("rank"))


@register("win_budget_cutoff", f"""WITH {SQL_RUNS},
w AS (SELECT search_id, run_id, seconds,
             sum(seconds) OVER (PARTITION BY search_id ORDER BY seconds, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS clock,
             row_number() OVER (PARTITION BY search_id ORDER BY seconds DESC, run_id) AS dear_rank FROM runs)
SELECT search_id, run_id, round(clock, 6) AS clock, CAST(clock <= 5000 AS INTEGER) AS inside_cap,
       CAST(dear_rank <= 5 AS INTEGER) AS is_dearest FROM w""")
def q_f6(spark, sf):
    b = FL.budget_cutoff(runs(spark, sf), "seconds", 5000.0)
    return b.select("search_id", "run_id", F.round("clock", 6).alias("clock"), "inside_cap", "is_dearest")


@register("top_errors", f"""WITH {SQL_DISTRICTS},
m AS (SELECT segment, avg(target) AS pred FROM districts GROUP BY segment)
SELECT row_id, round(abs(m.pred - target), 9) AS abs_err FROM districts JOIN m USING (segment)
WHERE priority IN ('1-URGENT', '2-HIGH') ORDER BY abs(m.pred - target) DESC, row_id LIMIT 12""")
def q_g1(spark, sf):
    d = districts(spark, sf)
    m = d.groupBy("segment").agg(F.avg("target").alias("pred"))
    s = FL.facet_filter(d.join(bounded(m), "segment"), {"priority": ["1-URGENT", "2-HIGH"]})
    s = s.withColumn("e", F.abs(F.col("pred") - F.col("target")))
    return FL.top_k(s, [F.desc("e"), F.asc("row_id")], 12).select("row_id", F.round("e", 9).alias("abs_err"))


@register("best_candidate", f"""WITH {SQL_RUNS},
f AS (SELECT * FROM runs WHERE status = 'FINISHED')
SELECT kernel, arg_min(run_id, (cv_rmse, run_id)) AS best_by_rmse, arg_max(run_id, (seconds, -run_id)) AS dearest
FROM f GROUP BY kernel""")
def q_g3(spark, sf):
    r = runs(spark, sf).where("status = 'FINISHED'")
    return r.groupBy("kernel").agg(F.min_by("run_id", F.struct("cv_rmse", "run_id")).alias("best_by_rmse"),
                                   F.max_by("run_id", F.struct("seconds", -F.col("run_id"))).alias("dearest"))


@register("head_sample", """
SELECT o_orderkey AS row_id, round(o_totalprice / 100000.0, 9) AS target FROM orders ORDER BY o_orderkey LIMIT 5""")
def q_g4(spark, sf):
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"),
                                              F.round(F.col("o_totalprice") / 100000.0, 9).alias("target"))
    return FL.first_n(o, "row_id", 5)


@register("order_cheap_first", f"""WITH {SQL_RUNS}
SELECT search_id, run_id, CAST(row_number() OVER (PARTITION BY search_id ORDER BY c, kernel, run_id) AS INTEGER) AS exec_order FROM runs""")
def q_g5(spark, sf):
    """Execution order cheapest first inside each search: exact positions,
    in ranges of the whole order, so a hot search is not one task."""
    from foldsafe.operators.positions import ordered_positions
    p = ordered_positions(runs(spark, sf), ["c", "kernel", "run_id"], ["search_id"], out="pos")
    return p.select("search_id", "run_id", (F.col("pos") + 1).cast("int").alias("exec_order"))


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("top_correlated", " UNION ALL ".join(
    f"SELECT '{c}' AS col_a, round(corr({c}, l_extendedprice), 6) AS corr FROM lineitem" for c in LI_COLS if c != "l_extendedprice")
    .join(["SELECT * FROM (", ") ORDER BY abs(corr) DESC LIMIT 4"]))
def q_g6(spark, sf):
    cm = agg_corr_matrix(read_table(spark, sf, "lineitem"), LI_COLS)
    cm = cm.where((F.col("col_b") == "l_extendedprice") & (F.col("col_a") != "l_extendedprice"))
    return FL.top_k(cm, [F.desc(F.abs("corr"))], 4).select("col_a", F.round("corr", 6).alias("corr"))


@register("order_importance", """
WITH s AS (SELECT 'l_quantity' AS feature, abs(corr(l_quantity, l_extendedprice)) AS importance FROM lineitem
           UNION ALL SELECT 'l_discount', abs(corr(l_discount, l_extendedprice)) FROM lineitem
           UNION ALL SELECT 'l_tax', abs(corr(l_tax, l_extendedprice)) FROM lineitem)
SELECT feature, round(importance, 6) AS importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS position FROM s""")
def q_g7(spark, sf):
    cm = agg_corr_matrix(read_table(spark, sf, "lineitem"), LI_COLS)
    imp = cm.where((F.col("col_b") == "l_extendedprice") & (F.col("col_a") != "l_extendedprice")).select(
        F.col("col_a").alias("feature"), F.abs("corr").alias("importance"))
    w = Window.orderBy(F.desc("importance"), "feature")   # one row per feature: bounded
    return imp.select("feature", F.round("importance", 6).alias("importance"), F.row_number().over(w).cast("int").alias("position"))
