"""Registered queries: search bookkeeping and comparison."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.functions.keys import sql_seeded_hash
from foldsafe.operators import search as SR
from foldsafe.operators import tree_search as TS
from foldsafe.operators.joins import anti_resume, interval_overlap, paired_delta
from foldsafe.operators.metrics import t_quantile_expr, t_quantile_sql
from foldsafe.operators.splits import fold_kfold_shuffled, split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, SQL_RUNS, districts, runs
from foldsafe.plans.sqlutil import kfold_sql, random_split_sql
from foldsafe.session import scratch_path

# The search space of the shrunk group-mean model.
GROUP_COLS = ["segment", "priority"]
ALPHAS = [0.0, 10.0, 100.0]
CUTOFF = "2024-01-10 00:00:00"
CAP = 400.0


def _cands(spark):
    g = SR.grid(spark, {"group_col": GROUP_COLS, "alpha": ALPHAS})
    return g.withColumn("cand_key", F.concat("group_col", F.lit(":"), F.format_string("%.1f", "alpha")))


def _folded(spark, sf):
    """The folded base table of a search, persisted once: every candidate's
    fold statistics and scoring read it."""
    from pyspark import StorageLevel
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42)
    return d.select("row_id", "fold", "target", *GROUP_COLS).persist(StorageLevel.MEMORY_AND_DISK)


def _fold_scores(spark, sf, cands=None):
    return SR.eval_shrunk_means(_folded(spark, sf), cands if cands is not None else _cands(spark), "fold", "target", 5)


def cand_values_sql(cands):
    return "(VALUES " + ", ".join(f"('{g}', CAST({a!r} AS DOUBLE))" for g, a in cands) + ") v(group_col, alpha)"


def eval_sql(cand_table_sql: str, key_sql: str = "group_col || ':' || printf('%.1f', alpha)",
             head: str | None = None, src: str = "districts") -> str:
    head = head if head is not None else SQL_DISTRICTS
    return f"""{head}, {kfold_sql(src, 'row_id', 5, 42)},
c AS (SELECT *, {key_sql} AS cand_key FROM {cand_table_sql}),
rws AS ({' UNION ALL '.join(f"SELECT fold, target, '{g}' AS group_col, CAST({g} AS VARCHAR) AS g FROM {src}_kf" for g in GROUP_COLS)}),
st AS (SELECT group_col, fold, g, sum(target) AS s, count(target) AS n FROM rws GROUP BY ALL),
comp AS (SELECT st.*, sum(s) OVER (PARTITION BY group_col, g) - s AS cs, sum(n) OVER (PARTITION BY group_col, g) - n AS cn,
                sum(s) OVER (PARTITION BY group_col) AS gs, sum(n) OVER (PARTITION BY group_col) AS gn FROM st),
ft AS (SELECT group_col, fold, sum(s) AS fs, sum(n) AS fn FROM st GROUP BY ALL),
k AS (SELECT comp.group_col, comp.fold, comp.g, cs, cn, (gs - fs) / (gn - fn) AS gmean FROM comp JOIN ft USING (group_col, fold)),
consts AS (SELECT c.cand_key, c.group_col, k.fold, k.g,
                  (cs + coalesce(alpha, 0.0) * gmean) / nullif(cn + coalesce(alpha, 0.0), 0) AS pred, gmean
           FROM c JOIN k USING (group_col)),
sc AS (SELECT consts.cand_key, r.fold, (coalesce(pred, gmean) - r.target) ^ 2 AS se
       FROM rws r JOIN consts ON r.group_col = consts.group_col AND r.fold = consts.fold AND r.g = consts.g),
fs AS (SELECT cand_key, fold, sqrt(avg(se)) AS rmse, count(*) AS n FROM sc GROUP BY ALL),
lg AS (SELECT cand_key, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_std, count(*) AS n_folds FROM fs GROUP BY cand_key)"""


GRID = [(g, a) for g in GROUP_COLS for a in ALPHAS]
GRID_SQL = eval_sql(cand_values_sql(GRID))


@register("search_grid", f"WITH {GRID_SQL} SELECT cand_key, CAST(fold AS INTEGER) AS fold, round(rmse, 6) AS rmse, n FROM fs")
def q_m1(spark, sf):
    fs = _fold_scores(spark, sf)
    return fs.select("cand_key", F.col("fold").cast("int").alias("fold"), F.round("rmse", 6).alias("rmse"), "n")


# The search space of the ridge regression.
RIDGE_FEATURES = ["doy", "nation"]
RIDGE_SPACE = [(f"{'+'.join(fs)}:{a}", fs, a) for fs in (["doy"], ["nation"], ["doy", "nation"]) for a in (0.0, 10.0, 1000.0)]
RIDGE_CANDS_SQL = ", ".join(f"('{key}', {int('doy' in fs)}, {int('nation' in fs)}, CAST({a!r} AS DOUBLE))" for key, fs, a in RIDGE_SPACE)
RIDGE_SQL = f"""{SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)},
d AS (SELECT fold, CAST(doy AS DOUBLE) AS x1, CAST(nation AS DOUBLE) AS x2, target AS y FROM districts_kf),
c(cand_key, u1, u2, alpha) AS (VALUES {RIDGE_CANDS_SQL}),
t AS (SELECT f.i, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2,
             covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y
      FROM (SELECT unnest(range(5)) AS i) f JOIN d ON d.fold <> f.i GROUP BY f.i),
z AS (SELECT cand_key, i, m1, m2, my, s1, s2, n + alpha AS g, n * c12 / (s1 * s2) * u1 * u2 AS a12,
             n * c1y / s1 * u1 AS a1y, n * c2y / s2 * u2 AS a2y FROM t CROSS JOIN c),
b AS (SELECT *, (a1y * g - a12 * a2y) / (g * g - a12 * a12) / s1 AS b1, (a2y * g - a12 * a1y) / (g * g - a12 * a12) / s2 AS b2 FROM z),
fs AS (SELECT cand_key, CAST(i AS INTEGER) AS fold, sqrt(avg((y - my - b1 * (x1 - m1) - b2 * (x2 - m2)) ^ 2)) AS rmse, count(*) AS n
       FROM b JOIN d ON d.fold = b.i GROUP BY cand_key, i)"""


@register("search_ridge", f"""WITH {RIDGE_SQL},
lg AS (SELECT cand_key, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_std, count(*) AS n_folds FROM fs GROUP BY cand_key)
SELECT cand_key, round(cv_rmse, 6) AS cv_rmse, round(cv_std, 6) AS cv_std, n_folds FROM lg""")
def q_search_ridge(spark, sf):
    """M1 over a fitted learner: ridge regressions on two feature columns, standardised per training part."""
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42).select("fold", "target", *RIDGE_FEATURES)
    log = SR.log_candidates(SR.eval_ridge(d, RIDGE_SPACE, "fold", "target"))
    return log.select("cand_key", F.round("cv_rmse", 6).alias("cv_rmse"), F.round("cv_std", 6).alias("cv_std"), "n_folds")


# The search spaces of the tree learners; targets are counted in hundredths of the price.
TREE_FEATURES = ["acctbal", "doy", "year", "nation"]
TREE_UNIT, TREE_BINS = 1e-7, 16
TREE_SPACE = [(depth, leaf) for leaf in (5, 100) for depth in (1, 2, 3)]
ENSEMBLES = [TS.Candidate("forest:depth 3", "forest", 3, 5, trees=8, max_features=0.5), TS.Candidate("forest:depth 5", "forest", 5, 20, trees=8, max_features=0.5),
             *[TS.Candidate(f"boosted:{rate}:{share}", "boosted", 3, 20, trees=6, rate=rate, subsample=share) for rate in (0.05, 0.2) for share in (0.7, 1.0)]]


def _tree_level_sql(level: int) -> str:
    """CTEs: the nodes' values ``v`` at this level, their best cuts, and the rows' nodes at the next level."""
    return f"""
h{level} AS (SELECT f, leaf, node, feature, bins[feature] AS bin, count(*) AS n, CAST(sum(q) AS BIGINT) AS s
       FROM n{level}, (SELECT unnest(range(1, {len(TREE_FEATURES) + 1})) AS feature) WHERE fold <> f GROUP BY ALL),
v{level} AS (SELECT f, leaf, node, sum(s) / sum(n) AS value FROM h{level} WHERE feature = 1 GROUP BY ALL),
c{level} AS (SELECT f, leaf, node, feature, bin, CAST(sum(n) OVER w AS DOUBLE) AS nl, CAST(sum(s) OVER w AS DOUBLE) AS sl,
              CAST(sum(n) OVER t AS DOUBLE) AS nt, CAST(sum(s) OVER t AS DOUBLE) AS st FROM h{level}
       WINDOW t AS (PARTITION BY f, leaf, node, feature), w AS (PARTITION BY f, leaf, node, feature ORDER BY bin)),
g{level} AS (SELECT *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) AS gain FROM c{level} WHERE nl >= leaf AND nt - nl >= leaf),
s{level} AS (SELECT f, leaf, node, arg_max((feature, bin), (gain, -feature, -bin)) AS best FROM g{level}
       WHERE gain > st * st / nt * (1 + 1e-12) GROUP BY ALL),
n{level + 1} AS (SELECT n.* REPLACE (CASE WHEN best IS NULL THEN node ELSE 2 * node + CAST(bins[best[1]] > best[2] AS INTEGER) END AS node)
       FROM n{level} n LEFT JOIN s{level} USING (f, leaf, node))"""


def _tree_bin_sql(feature: str) -> str:
    cuts = ", ".join(f"quantile_disc(CAST({feature} AS DOUBLE), {i / TREE_BINS!r})" for i in range(1, TREE_BINS))
    return f"(SELECT list_distinct([{cuts}]) FROM districts) AS e_{feature}"


TREE_SQL = f"""{SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)},
e AS (SELECT {', '.join(map(_tree_bin_sql, TREE_FEATURES))}),
b AS (SELECT fold, CAST(round_even(target / {TREE_UNIT!r}, 0) AS BIGINT) AS q,
             [{', '.join(f"CASE WHEN {f} IS NULL THEN 0 ELSE 1 + len(list_filter(e_{f}, lambda x: CAST({f} AS DOUBLE) > x)) END" for f in TREE_FEATURES)}] AS bins FROM districts_kf, e),
n0 AS (SELECT f, leaf, fold, q, bins, 1 AS node FROM b, (SELECT unnest(range(5)) AS f), (VALUES {', '.join(f'({leaf})' for leaf in sorted({leaf for _, leaf in TREE_SPACE}))}) l(leaf)),
{','.join(_tree_level_sql(i) for i in range(4)).strip()},
fs AS ({' UNION ALL '.join(f"""SELECT 'tree:{d}:' || leaf AS cand_key, CAST(f AS INTEGER) AS fold, sqrt(avg(((q - value) * {TREE_UNIT!r}) ^ 2)) AS rmse, count(*) AS n
       FROM n{d} JOIN v{d} USING (f, leaf, node) WHERE fold = f GROUP BY ALL""" for d in (1, 2, 3))})"""


def _tree_scores(spark, sf, cands):
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42)
    return TS.search_trees(d, cands, TREE_FEATURES, "row_id", "fold", "target", TREE_UNIT, TREE_BINS)


@register("search_trees", f"WITH {TREE_SQL} SELECT cand_key, fold, round(rmse, 6) AS rmse, n FROM fs")
def q_search_trees(spark, sf):
    """M1 over fitted trees: every candidate on every fold from one histogram table a level."""
    cands = [TS.Candidate(f"tree:{depth}:{leaf}", "tree", depth, leaf) for depth, leaf in TREE_SPACE]
    return _tree_scores(spark, sf, cands).select("cand_key", "fold", F.round("rmse", 6).alias("rmse"), "n")


@register("search_ensembles")
def q_search_ensembles(spark, sf):
    """M1, M4 over forests and boosting: mean and spread of every candidate's folds, with its rank."""
    log = SR.log_candidates(_tree_scores(spark, sf, ENSEMBLES))
    return log.select("cand_key", F.round("cv_rmse", 6).alias("cv_rmse"), F.round("cv_std", 6).alias("cv_std"), "n_folds", "rank")


@register("search_log_candidates", f"""WITH {GRID_SQL}
SELECT cand_key, round(cv_rmse, 6) AS cv_rmse, round(cv_std, 6) AS cv_std, n_folds,
       CAST(rank() OVER (ORDER BY round(cv_rmse, 9)) AS INTEGER) AS rank FROM lg""")
def q_m4(spark, sf):
    from pyspark.sql import Window
    g = SR.log_candidates(_fold_scores(spark, sf)).withColumn("r9", F.round("cv_rmse", 9))
    g = g.withColumn("rank", F.rank().over(Window.orderBy("r9")).cast("int"))   # one row per candidate
    return g.select("cand_key", F.round("cv_rmse", 6).alias("cv_rmse"), F.round("cv_std", 6).alias("cv_std"), "n_folds", "rank")


# random search: 12 draws, group column uniform from the list, alpha log-uniform in [0.1, 1000]
N_DRAWS, DRAW_SEED, A_LO, A_HI = 12, 7, 0.1, 1000.0


MODES = ["shrunk", "plain"]


def _draws(spark):
    """group column and mode uniform from lists, alpha log-uniform; alpha is
    dropped (NULL) for the 'plain' mode, where it does not apply."""
    d = SR.random_draws(spark, N_DRAWS, DRAW_SEED, lists={"group_col": GROUP_COLS, "mode": MODES},
                        log_uniform={"alpha": (A_LO, A_HI)}, drop_when={"alpha": ("mode", ["plain"])})
    return d.withColumn("cand_key", F.concat(F.lit("d"), F.col("draw").cast("string")))


DRAWS_SQL = f"""(SELECT draw, group_col, mode, CASE WHEN mode = 'plain' THEN NULL ELSE alpha END AS alpha FROM (
  SELECT draw, {GROUP_COLS!r}[CAST(floor(({sql_seeded_hash('draw', DRAW_SEED, 'group_col')} / 4294967296.0) * {len(GROUP_COLS)}) AS INTEGER) + 1] AS group_col,
         ['shrunk', 'plain'][CAST(floor(({sql_seeded_hash('draw', DRAW_SEED, 'mode')} / 4294967296.0) * 2) AS INTEGER) + 1] AS mode,
         exp({math.log(A_LO)!r} + ({sql_seeded_hash('draw', DRAW_SEED, 'alpha')} / 4294967296.0) * {math.log(A_HI / A_LO)!r}) AS alpha
  FROM range(0, {N_DRAWS}) t(draw)))"""


@register("search_random", f"""WITH {eval_sql(DRAWS_SQL, "'d' || CAST(draw AS VARCHAR)")}
SELECT c.draw, c.group_col, c.mode, round(c.alpha, 6) AS alpha, round(lg.cv_rmse, 6) AS cv_rmse FROM c JOIN lg USING (cand_key)""")
def q_m2(spark, sf):
    d = _draws(spark)
    lg = SR.log_candidates(_fold_scores(spark, sf, d))
    return d.join(lg, "cand_key").select("draw", "group_col", "mode", F.round("alpha", 6).alias("alpha"),
                                         F.round("cv_rmse", 6).alias("cv_rmse"))


@register("search_resume", f"""WITH {GRID_SQL}
SELECT cand_key, CAST(fold AS INTEGER) AS fold, round(rmse, 6) AS rmse FROM fs""")
def q_m5(spark, sf):
    """Resume: a first session writes the log of the alpha = 0 candidates; the
    next one reads it, evaluates only the anti-join remainder and appends."""
    log = scratch_path(spark, f"search-log-{uuid.uuid4().hex}")
    cands = _cands(spark)
    _fold_scores(spark, sf, cands.where(F.col("alpha") == 0.0)).write.parquet(log)
    todo = anti_resume(cands, spark.read.parquet(log).select("cand_key").distinct())
    _fold_scores(spark, sf, todo).write.mode("append").parquet(log)
    out = spark.read.parquet(log)
    return out.select("cand_key", F.col("fold").cast("int").alias("fold"), F.round("rmse", 6).alias("rmse"))


PROJ_SQL = f"""{SQL_RUNS},
m AS (SELECT * FROM runs WHERE status = 'FINISHED' AND ts < TIMESTAMP '{CUTOFF}'),
td AS (SELECT * FROM runs WHERE ts >= TIMESTAMP '{CUTOFF}'),
t AS (SELECT kernel, ln(c) AS u, ln(gamma) AS v, ln(seconds) AS w FROM m WHERE c > 0 AND gamma > 0 AND seconds > 0),
g AS (SELECT kernel, var_pop(u) AS suu, var_pop(v) AS svv, covar_pop(u, v) AS suv, covar_pop(u, w) AS suw,
             covar_pop(v, w) AS svw, avg(u) AS mu, avg(v) AS mv, avg(w) AS mw FROM t GROUP BY 1),
pl AS (SELECT kernel, a, b, mw - a * mu - b * mv AS c0 FROM (
        SELECT *, (suw * svv - svw * suv) / (suu * svv - suv * suv) AS a, (svw * suu - suw * suv) / (suu * svv - suv * suv) AS b FROM g)),
p AS (SELECT td.search_id, td.run_id, CASE WHEN td.c > 0 AND td.gamma > 0 THEN exp(pl.a * ln(td.c) + pl.b * ln(td.gamma) + pl.c0) END AS projected FROM td JOIN pl USING (kernel)),
pc AS (SELECT *, CAST(projected > {CAP} AS INTEGER) AS skipped,
              sum(CASE WHEN projected > {CAP} THEN 0.0 ELSE projected END) OVER (PARTITION BY search_id ORDER BY projected NULLS LAST, run_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS clock FROM p)"""


def _projected(spark, sf):
    r = runs(spark, sf)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    measured = r.where((F.col("status") == "FINISHED") & (F.col("ts") < cut))
    todo = r.where(F.col("ts") >= cut)
    return measured, SR.project_costs(measured, todo, CAP)


@register("search_project_cost", f"""WITH {PROJ_SQL}
SELECT search_id, run_id, round(projected, 6) AS projected, skipped, round(clock, 4) AS clock FROM pc""")
def q_m6(spark, sf):
    _, p = _projected(spark, sf)
    return p.select("search_id", "run_id", F.round("projected", 6).alias("projected"), "skipped", F.round("clock", 4).alias("clock"))


@register("search_close_partial", f"""WITH {PROJ_SQL},
mm AS (SELECT search_id, count(*) AS n_run, sum(seconds) / 3600.0 AS hours_run FROM m GROUP BY 1),
uu AS (SELECT search_id, count(*) AS n_unrun, sum(projected) / 3600.0 AS hours_unrun FROM pc GROUP BY 1)
SELECT coalesce(mm.search_id, uu.search_id) AS search_id, coalesce(n_run, 0) AS n_run, round(coalesce(hours_run, 0.0), 6) AS hours_run,
       coalesce(n_unrun, 0) AS n_unrun, round(coalesce(hours_unrun, 0.0), 6) AS hours_unrun
FROM mm FULL OUTER JOIN uu ON mm.search_id = uu.search_id""")
def q_m7(spark, sf):
    measured, p = _projected(spark, sf)
    c = SR.close_partial(measured, p)
    return c.select("search_id", "n_run", F.round("hours_run", 6).alias("hours_run"), "n_unrun", F.round("hours_unrun", 6).alias("hours_unrun"))


@register("compare_ablation", f"""WITH {GRID_SQL},
a AS (SELECT c.alpha, max(CASE WHEN c.group_col = 'priority' THEN lg.cv_rmse END) AS score_a,
             max(CASE WHEN c.group_col = 'segment' THEN lg.cv_rmse END) AS score_b FROM lg JOIN c USING (cand_key) GROUP BY c.alpha)
SELECT alpha, round(score_a, 6) AS score_a, round(score_b, 6) AS score_b, round(score_b - score_a, 6) AS delta,
       CASE WHEN score_b - score_a < 0 THEN 'improves' ELSE 'worsens' END AS verdict FROM a""")
def q_m11(spark, sf):
    lg = SR.log_candidates(_fold_scores(spark, sf)).join(_cands(spark), "cand_key")
    d = paired_delta(lg, ["alpha"], "group_col", "priority", "segment", "cv_rmse")
    return d.select("alpha", F.round("score_a", 6).alias("score_a"), F.round("score_b", 6).alias("score_b"),
                    F.round("delta", 6).alias("delta"), F.when(F.col("delta") < 0, "improves").otherwise("worsens").alias("verdict"))


TEST_SQL = f"""{SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)},
c AS (SELECT *, group_col || ':' || printf('%.1f', alpha) AS cand_key FROM {cand_values_sql(GRID)}),
rws AS ({' UNION ALL '.join(f"SELECT row_id, is_test, target, '{g}' AS group_col, CAST({g} AS VARCHAR) AS g FROM districts_rsplit" for g in GROUP_COLS)}),
gm AS (SELECT avg(target) AS gmean, min(target) AS lo, max(target) AS hi FROM districts_rsplit WHERE is_test = 0),
st AS (SELECT group_col, g, sum(target) AS s, count(*) AS n FROM rws WHERE is_test = 0 GROUP BY ALL),
k AS (SELECT c.cand_key, st.group_col, st.g, (s + alpha * gmean) / nullif(n + alpha, 0) AS pred FROM c JOIN st USING (group_col), gm),
sc AS (SELECT k.cand_key, coalesce(k.pred, gm.gmean) AS pred, r.target, gm.lo, gm.hi FROM rws r JOIN k USING (group_col, g), gm WHERE r.is_test = 1),
te AS (SELECT cand_key, avg((pred - target) ^ 2) AS mm, stddev_samp((pred - target) ^ 2) AS ss, count(*) AS n,
              1 - sum((pred - target) ^ 2) / (var_pop(target) * count(*)) AS r2 FROM sc GROUP BY cand_key)"""


def _test_scores(spark, sf):
    d = split_random(districts(spark, sf), "row_id", 0.2, 42)
    tr = d.where("is_test = 0")
    gm = tr.agg(F.avg("target").alias("m"), F.min("target").alias("lo"), F.max("target").alias("hi")).first()
    outs = []
    for g, a in GRID:
        key = f"{g}:{a:.1f}"
        st = tr.groupBy(F.col(g).cast("string").alias("g")).agg(F.sum("target").alias("s"), F.count(F.lit(1)).alias("n"))
        k = st.select("g", F.try_divide(F.col("s") + F.lit(a) * F.lit(gm["m"]), F.col("n") + F.lit(a)).alias("pred"))
        te = d.where("is_test = 1").withColumn("g", F.col(g).cast("string")).join(bounded(k), "g")
        outs.append(te.select(F.lit(key).alias("cand_key"), F.coalesce("pred", F.lit(gm["m"])).alias("pred"), "target"))
    u = outs[0]
    for o in outs[1:]:
        u = u.unionByName(o)
    return u, gm


@register("compare_models_table", f"""WITH {TEST_SQL},
ci AS (SELECT cand_key, sqrt(mm) AS test_rmse, r2, sqrt(greatest(0.0, mm - {t_quantile_sql('n - 1')} * ss / sqrt(n))) AS lo,
              sqrt(mm + {t_quantile_sql('n - 1')} * ss / sqrt(n)) AS hi FROM te),
b AS (SELECT arg_min(lo, test_rmse) AS blo, arg_min(hi, test_rmse) AS bhi FROM ci)
SELECT cand_key, round(test_rmse, 6) AS test_rmse, round(r2, 6) AS r2, CAST(NOT (lo > bhi OR hi < blo) AS INTEGER) AS overlaps_best FROM ci, b""")
def q_m12(spark, sf):
    u, _ = _test_scores(spark, sf)
    e = F.col("pred") - F.col("target")
    a = u.groupBy("cand_key").agg(F.avg(e * e).alias("mm"), F.stddev_samp(e * e).alias("ss"), F.count(F.lit(1)).alias("n"),
                                  (F.lit(1.0) - F.sum(e * e) / (F.var_pop("target") * F.count(F.lit(1)))).alias("r2"))
    half = t_quantile_expr(F.col("n") - 1) * F.col("ss") / F.sqrt("n")
    ci = a.select("cand_key", F.sqrt("mm").alias("test_rmse"), "r2", F.sqrt(F.greatest(F.lit(0.0), F.col("mm") - half)).alias("lo"),
                  F.sqrt(F.col("mm") + half).alias("hi"))
    o = interval_overlap(ci, "lo", "hi", "test_rmse")
    return o.select("cand_key", F.round("test_rmse", 6).alias("test_rmse"), F.round("r2", 6).alias("r2"), "overlaps_best")


REFIT_HEAD = f"""{SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)},
tr AS (SELECT * FROM districts_rsplit WHERE is_test = 0)"""


@register("search_refit_best", f"""WITH {eval_sql(cand_values_sql(GRID), head=REFIT_HEAD, src='tr')},
best AS (SELECT arg_min(cand_key, (cv_rmse, cand_key)) AS cand_key FROM lg),
bc AS (SELECT c.* FROM c JOIN best USING (cand_key)),
gm AS (SELECT avg(target) AS gmean, min(target) AS lo, max(target) AS hi FROM tr),
trr AS ({' UNION ALL '.join(f"SELECT target, '{g}' AS group_col, CAST({g} AS VARCHAR) AS g FROM tr" for g in GROUP_COLS)}),
ter AS ({' UNION ALL '.join(f"SELECT target, '{g}' AS group_col, CAST({g} AS VARCHAR) AS g FROM districts_rsplit WHERE is_test = 1" for g in GROUP_COLS)}),
fit AS (SELECT trr.g, (sum(target) + max(bc.alpha) * max(gm.gmean)) / nullif(count(*) + max(bc.alpha), 0) AS pred
        FROM trr JOIN bc USING (group_col), gm GROUP BY trr.g),
scb AS (SELECT coalesce(fit.pred, gm.gmean) AS pred, ter.target, gm.lo, gm.hi FROM ter JOIN bc USING (group_col) LEFT JOIN fit USING (g), gm)
SELECT (SELECT cand_key FROM best) AS cand_key, round(sqrt(avg((pred - target) ^ 2)), 6) AS rmse_raw,
       round(sqrt(avg((greatest(lo, least(hi, pred)) - target) ^ 2)), 6) AS rmse_clipped,
       CAST(count_if(pred < lo OR pred > hi) AS BIGINT) AS n_out FROM scb""")
def q_m8(spark, sf):
    """Pick the winner by CV on the training split only, refit it on all
    training rows, score the test split raw and clipped to the training range."""
    from foldsafe.operators.metrics import eval_out_of_range
    d = split_random(districts(spark, sf), "row_id", 0.2, 42)
    tr = d.where("is_test = 0")
    lg = SR.log_candidates(SR.eval_shrunk_means(fold_kfold_shuffled(tr, "row_id", 5, 42), _cands(spark), "fold", "target", 5))
    best = lg.agg(F.min_by("cand_key", F.struct("cv_rmse", "cand_key")).alias("k")).first()["k"]     # one scalar
    g, a = best.split(":")[0], float(best.split(":")[1])
    gm = tr.agg(F.avg("target").alias("m"), F.min("target").alias("lo"), F.max("target").alias("hi")).first()
    fit = tr.groupBy(F.col(g).cast("string").alias("g")).agg(
        F.try_divide(F.sum("target") + F.lit(a) * F.lit(gm["m"]), F.count(F.lit(1)) + F.lit(a)).alias("pred"))
    te = d.where("is_test = 1").withColumn("g", F.col(g).cast("string")).join(bounded(fit), "g", "left")
    te = te.withColumn("pred", F.coalesce("pred", F.lit(gm["m"])))
    r = eval_out_of_range(te, "pred", "target", gm["lo"], gm["hi"])
    return r.select(F.lit(best).alias("cand_key"), F.round("rmse_raw", 6).alias("rmse_raw"),
                    F.round("rmse_clipped", 6).alias("rmse_clipped"), "n_out")


@register("study_timing", f"""WITH {SQL_RUNS},
t AS (SELECT kernel, CASE WHEN c > 0 AND seconds > 0 THEN ln(c) END AS lx, CASE WHEN c > 0 AND seconds > 0 THEN ln(seconds) END AS ly, seconds FROM runs)
SELECT kernel, round(regr_slope(ly, lx), 6) AS exponent, round(max(seconds), 6) AS slowest, round(min(seconds), 6) AS fastest,
       round(max(seconds) / nullif(min(seconds), 0), 6) AS ratio FROM t GROUP BY kernel""")
def q_m13(spark, sf):
    t = SR.timing_study(runs(spark, sf), "kernel", "c")
    return t.select("kernel", F.round("exponent", 6).alias("exponent"), F.round("slowest", 6).alias("slowest"),
                    F.round("fastest", 6).alias("fastest"), F.round("ratio", 6).alias("ratio"))
