"""Registered queries: preprocessing fit/apply (K1-K4, K7, K8, C5) and
single-pass fold statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foldsafe.operators import geo as G
from foldsafe.operators import prep as P
from foldsafe.operators.splits import fold_kfold_shuffled, split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, districts
from foldsafe.plans.sqlutil import kfold_sql, random_split_sql
from foldsafe.functions.keys import sql_seeded_hash
from foldsafe.session import read_table, scratch_path

SPLIT = f"WITH {SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)}"


def _split(spark, sf):
    return split_random(districts(spark, sf), "row_id", 0.2, 42)


@register("prep_impute_numeric", f"""{SPLIT},
f AS (SELECT median(acctbal) AS med, avg(acctbal) AS mean FROM districts_rsplit WHERE is_test = 0)
SELECT row_id, is_test, round(coalesce(acctbal, f.med), 6) AS acctbal_median, round(coalesce(acctbal, f.mean), 6) AS acctbal_mean
FROM districts_rsplit, f""")
def q_k1(spark, sf):
    d = _split(spark, sf)
    tr = d.where("is_test = 0")
    med = P.fit_impute_numeric(tr, ["acctbal"], "median")["acctbal"]
    mean = P.fit_impute_numeric(tr, ["acctbal"], "mean")["acctbal"]
    return d.select("row_id", "is_test", F.round(F.coalesce("acctbal", F.lit(med)), 6).alias("acctbal_median"),
                    F.round(F.coalesce("acctbal", F.lit(mean)), 6).alias("acctbal_mean"))


@register("prep_impute_mode", f"""{SPLIT},
c AS (SELECT priority, count(*) AS n FROM districts_rsplit WHERE is_test = 0 AND row_id % 3 <> 0 GROUP BY priority),
m AS (SELECT arg_min(priority, (-n, priority)) AS mode FROM c)
SELECT row_id, coalesce(CASE WHEN row_id % 3 = 0 THEN NULL ELSE priority END, m.mode) AS priority FROM districts_rsplit, m""")
def q_k2(spark, sf):
    d = _split(spark, sf).withColumn("priority", F.when(F.col("row_id") % 3 == 0, F.lit(None)).otherwise(F.col("priority")))
    mode = P.fit_impute_mode(d.where("is_test = 0"), ["priority"])
    return P.apply_impute(d, mode).select("row_id", "priority")


@register("prep_standardize", f"""{SPLIT},
f AS (SELECT avg(doy) AS m, CASE WHEN stddev_pop(doy) = 0 THEN 1.0 ELSE stddev_pop(doy) END AS s,
             avg(target) AS mt, CASE WHEN stddev_pop(target) = 0 THEN 1.0 ELSE stddev_pop(target) END AS st FROM districts_rsplit WHERE is_test = 0)
SELECT row_id, round((doy - f.m) / f.s, 6) AS doy_z, round((target - f.mt) / f.st, 6) AS target_z,
       round(((target - f.mt) / f.st) * f.st + f.mt, 9) AS target_back, round(doy / f.s, 6) AS doy_scaled FROM districts_rsplit, f""")
def q_k3(spark, sf):
    d = _split(spark, sf)
    prm = P.fit_standardize(d.where("is_test = 0"), ["doy", "target"])
    z = P.apply_standardize(d, prm, suffix="_z")
    back = P.inverse_standardize(z.drop("doy", "target"), {"target": prm["target"]}, suffix="_z")
    sc = P.apply_standardize(d, {"doy": prm["doy"]}, center=False, suffix="_scaled").select("row_id", "doy_scaled")
    return back.join(sc, "row_id").select("row_id", F.round("doy_z", 6).alias("doy_z"), F.round("target_z", 6).alias("target_z"),
                                         F.round("target", 9).alias("target_back"), F.round("doy_scaled", 6).alias("doy_scaled"))


LEVELS_SQL = "['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW']"


@register("prep_one_hot", f"""{SPLIT}
SELECT row_id, """ + ", ".join(
    f"CAST(coalesce(priority = '{lv}', false) AS INTEGER) AS priority_{lv.replace('-', '_').replace(' ', '_')}"
    for lv in ['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW']) + """,
    """ + ", ".join(f"CAST(coalesce(segment = '{lv}', false) AS INTEGER) AS segment_{lv}"
                    for lv in ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) + """
FROM districts_rsplit""")
def q_k4(spark, sf):
    """Levels fitted on training rows that never saw '4-NOT SPECIFIED': that
    level is unseen at apply time and maps to all zeros."""
    d = _split(spark, sf)
    tr = d.where("is_test = 0 AND priority <> '4-NOT SPECIFIED'")
    lv = P.fit_one_hot(tr, "priority")
    out = P.apply_one_hot(d, "priority", lv)
    seg = P.fit_one_hot(tr, "segment")
    out = P.apply_one_hot(out, "segment", seg)
    return out.select("row_id", *[P.one_hot_name("priority", v) for v in lv], *[P.one_hot_name("segment", v) for v in seg])


SKEW_COLS = ["acctbal", "doy", "target", "spread"]


def _skew_input(spark, sf):
    return _split(spark, sf).withColumn("spread", F.exp(F.col("target")))


@register("flt_skewed_columns", f"""{SPLIT},
b AS (SELECT *, exp(target) AS spread FROM districts_rsplit WHERE is_test = 0),
s AS ({' UNION ALL '.join(f"SELECT '{c}' AS column, skewness({c}) AS skew, min({c}) AS min FROM b" for c in SKEW_COLS)})
SELECT "column", round(skew, 6) AS skew, round(min, 6) AS min FROM s WHERE abs(skew) > 1 AND min > 0""")
def q_c5(spark, sf):
    tr = _skew_input(spark, sf).where("is_test = 0")
    s = P.skewed_columns(tr, SKEW_COLS)
    return s.select("column", F.round("skew", 6).alias("skew"), F.round("min", 6).alias("min"))


@register("prep_log_branch", f"""{SPLIT},
b AS (SELECT *, exp(target) AS spread FROM districts_rsplit),
med AS (SELECT median(spread) AS md FROM b WHERE is_test = 0),
lg AS (SELECT b.*, CASE WHEN coalesce(spread, md) > 0 THEN ln(coalesce(spread, md)) END AS ls FROM b, med),
st AS (SELECT avg(ls) AS m, CASE WHEN stddev_pop(ls) = 0 THEN 1.0 ELSE stddev_pop(ls) END AS s FROM lg WHERE is_test = 0)
SELECT row_id, round((ls - st.m) / st.s, 6) AS spread_log FROM lg, st""")
def q_k7(spark, sf):
    d = _skew_input(spark, sf)
    lb = P.fit_log_branch(d.where("is_test = 0"), ["spread"])
    return P.apply_log_branch(d, lb).select("row_id", F.round("spread_log", 6).alias("spread_log"))


@register("prep_branches", f"""{SPLIT},
b AS (SELECT *, exp(target) AS spread FROM districts_rsplit),
f AS (SELECT median(acctbal) AS mda, median(doy) AS mdd, median(spread) AS mds FROM b WHERE is_test = 0),
i AS (SELECT b.*, coalesce(acctbal, mda) AS a, CAST(coalesce(doy, mdd) AS DOUBLE) AS dd,
             CASE WHEN coalesce(spread, mds) > 0 THEN ln(coalesce(spread, mds)) END AS ls FROM b, f),
st AS (SELECT avg(a) AS ma, CASE WHEN stddev_pop(a) = 0 THEN 1.0 ELSE stddev_pop(a) END AS sa,
              avg(dd) AS md, CASE WHEN stddev_pop(dd) = 0 THEN 1.0 ELSE stddev_pop(dd) END AS sd,
              avg(ls) AS ml, CASE WHEN stddev_pop(ls) = 0 THEN 1.0 ELSE stddev_pop(ls) END AS sl FROM i WHERE is_test = 0)
SELECT row_id, round((a - ma) / sa, 6) AS num__acctbal, round((dd - md) / sd, 6) AS num__doy, round((ls - ml) / sl, 6) AS log__spread,
       """ + ", ".join(f"CAST(coalesce(segment = '{s}', false) AS INTEGER) AS cat__segment_{s}"
                       for s in ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) + """
FROM i, st""")
def q_k8(spark, sf):
    d = _skew_input(spark, sf)
    br = P.fit_branches(d.where("is_test = 0"), numeric=["acctbal", "doy"], log=["spread"], categorical=["segment"],
                        passthrough=["row_id"])
    out = P.apply_branches(d, br)
    num = [c for c in out.columns if c.startswith(("num__", "log__"))]
    return out.select("row_id", *[F.round(c, 6).alias(c) for c in num], *[c for c in out.columns if c.startswith("cat__")])


@register("prep_fold_moments", f"""WITH {SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)}
SELECT f.fold, 'target' AS column, count(d.target) AS n, round(avg(d.target), 6) AS mean,
       round(CASE WHEN stddev_pop(d.target) = 0 THEN 1.0 ELSE stddev_pop(d.target) END, 6) AS std
FROM (SELECT DISTINCT fold FROM districts_kf) f JOIN districts_kf d ON d.fold <> f.fold GROUP BY f.fold""")
def q_fold_moments(spark, sf):
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42)
    m = P.fold_moments(d, ["target"], "fold")
    return m.select("fold", "column", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@register("prep_fold_medians", f"""WITH {SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)}
SELECT f.fold, 'acctbal' AS column, round(median(d.acctbal), 6) AS median
FROM (SELECT DISTINCT fold FROM districts_kf) f JOIN districts_kf d ON d.fold <> f.fold GROUP BY f.fold""")
def q_fold_medians(spark, sf):
    d = fold_kfold_shuffled(districts(spark, sf), "row_id", 5, 42)
    return P.fold_medians(d, ["acctbal"], "fold", 5).select("fold", "column", F.round("median", 6).alias("median"))


# The geographic branch over the first two components, weighted by label + 1.
GEO_K, GEO_GAMMA, GEO_STEPS, GEO_UNIT = 4, 50.0, 6, 1e-6


def _geo_step_sql(i: int) -> str:
    return f"""
a{i} AS (SELECT f, vec_id, w, u0, u1, arg_min(centre, ((u0 - c0) * (u0 - c0) + (u1 - c1) * (u1 - c1), centre)) AS centre FROM u JOIN c{i} ON fold <> f GROUP BY ALL),
s{i} AS (SELECT f, centre, sum(w) AS sw, CAST(sum(w * u0) AS DOUBLE) / CAST(sum(w) AS DOUBLE) AS m0, CAST(sum(w * u1) AS DOUBLE) / CAST(sum(w) AS DOUBLE) AS m1
       FROM a{i} GROUP BY ALL),
c{i + 1} AS (SELECT f, centre, coalesce(m0, c0) AS c0, coalesce(m1, c1) AS c1, CAST(coalesce(s{i}.sw, 0) AS BIGINT) AS sw FROM c{i} LEFT JOIN s{i} USING (f, centre))"""


GEO_SQL = f"""g AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon, CAST(label + 1 AS BIGINT) AS w FROM embeddings),
{kfold_sql('g', 'vec_id', 5, 42)},
u AS (SELECT vec_id, fold, w, CAST(round_even(lat / {GEO_UNIT!r}, 0) AS BIGINT) AS u0, CAST(round_even(lon / {GEO_UNIT!r}, 0) AS BIGINT) AS u1 FROM g_kf),
i0 AS (SELECT f, u0, u1, min(row({sql_seeded_hash('vec_id', 42)}, vec_id)) AS h FROM u JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS f) ON fold <> f GROUP BY ALL),
c0 AS (SELECT f, CAST(row_number() OVER (PARTITION BY f ORDER BY h) - 1 AS INTEGER) AS centre, CAST(u0 AS DOUBLE) AS c0, CAST(u1 AS DOUBLE) AS c1
       FROM i0 QUALIFY centre < {GEO_K}),
{','.join(map(_geo_step_sql, range(GEO_STEPS))).strip()}"""


def _geo(spark, sf):
    e = read_table(spark, sf, "embeddings")
    d = e.select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("lat"), F.get("embedding", F.lit(1)).cast("double").alias("lon"),
                 (F.col("label") + 1).cast("long").alias("w"))
    d = fold_kfold_shuffled(d, "vec_id", 5, 42)
    return d, G.fit_geo(d, ["lat", "lon"], "vec_id", GEO_K, GEO_GAMMA, "w", "fold", GEO_UNIT, GEO_STEPS)


@register("export_geo_spec", f"""WITH {GEO_SQL}
SELECT f AS fold, centre, 'cluster_' || centre || '_similarity' AS name, c0 * {GEO_UNIT!r} AS lat, c1 * {GEO_UNIT!r} AS lon, sw AS weight,
       CAST({GEO_GAMMA!r} AS DOUBLE) AS gamma FROM c{GEO_STEPS}""")
def q_geo_spec(spark, sf):
    """N4, the geographic branch: centres in full precision, weights, gamma and output names of every training part."""
    s = _geo(spark, sf)[1]
    return s.select("fold", "centre", "name", F.col("place")[0].alias("lat"), F.col("place")[1].alias("lon"), "weight", "gamma")


@register("prep_geo_similarity", f"""WITH {GEO_SQL}
SELECT vec_id, g_kf.fold, name, round(exp(-CAST({GEO_GAMMA!r} AS DOUBLE) * ((lat - x) * (lat - x) + (lon - y) * (lon - y))), 6) AS similarity
FROM g_kf JOIN (SELECT f, 'cluster_' || centre || '_similarity' AS name, c0 * {GEO_UNIT!r} AS x, c1 * {GEO_UNIT!r} AS y FROM c{GEO_STEPS}) c ON c.f = g_kf.fold""")
def q_geo_similarity(spark, sf):
    """Every row's similarity to centres fitted without its fold, by the spec as written and read back."""
    d, spec = _geo(spark, sf)
    path = scratch_path(spark, f"geo-spec-{uuid.uuid4().hex}")
    spec.write.parquet(path)
    out = G.geo_similarity(d, ["lat", "lon"], spark.read.schema(G.SPEC_SCHEMA).parquet(path), "fold")
    out = out.select("vec_id", "fold", F.posexplode("similarity").alias("i", "similarity"))
    return out.select("vec_id", "fold", F.concat(F.lit("cluster_"), "i", F.lit("_similarity")).alias("name"), F.round("similarity", 6).alias("similarity"))
