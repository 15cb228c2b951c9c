"""Registered queries: scoring, export and serving checks."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from foldsafe.functions.keys import sql_seeded_hash
from foldsafe.operators import learners as LR
from foldsafe.operators import scoring as SC
from foldsafe.operators.joins import parity
from foldsafe.operators.prep import fit_branches
from foldsafe.operators.quantiles import exact_median
from foldsafe.operators.splits import split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, districts, districts_split
from foldsafe.plans.q_learners import OLS_SQL, _split_imputed
from foldsafe.plans.sqlutil import random_split_sql
from foldsafe.session import scratch_path

DEPTH = 4


def _raw_split(spark, sf):
    d = districts_split(spark, sf).withColumn("doy", F.col("doy").cast("double"))
    # the training rows never see one priority level: it is unseen at scoring time
    return d


def _pipeline_model(spark, sf):
    d = _raw_split(spark, sf)
    tr = d.where("is_test = 0 AND priority <> '4-NOT SPECIFIED'")
    pipe = Pipeline(stages=[
        Imputer(inputCols=["acctbal"], outputCols=["acctbal_i"], strategy="median"),
        StringIndexer(inputCol="priority", outputCol="priority_ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["priority_ix"], outputCols=["priority_oh"], handleInvalid="keep", dropLast=True),
        VectorAssembler(inputCols=["acctbal_i", "doy", "priority_oh"], outputCol="features", handleInvalid="keep"),
    ])
    prep = pipe.fit(tr)
    # made once: the booster reads its input for its counts, its split points and its trees
    rows = prep.transform(tr).select("features", "target").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gbt = GBTRegressor(featuresCol="features", labelCol="target", maxIter=10, maxDepth=DEPTH, seed=42).fit(rows)
    finally:
        rows.unpersist()
    return d, PipelineModel([*prep.stages, gbt])


@register("score_batch")
def q_n1(spark, sf):
    """Raw rows (NULL balances, an unseen priority) -> prediction in USD."""
    d, m = _pipeline_model(spark, sf)
    sc = m.transform(d.where("is_test = 1"))
    return sc.select("row_id", F.round(F.col("prediction") * 100000.0, 2).alias("pred_usd"))


def _export(spark, sf):
    d, m = _pipeline_model(spark, sf)
    path = scratch_path(spark, f"gbt-{uuid.uuid4().hex}")
    nodes = SC.export_tree_table(spark, m.stages[-1], path)
    return d, m, nodes


@register("export_tree_table")
def q_n3(spark, sf):
    _, _, nodes = _export(spark, sf)
    return nodes.select("tree_id", "node_id", "feature", F.try_element_at("split_values", F.lit(1)).alias("threshold"), "left", "right",
                        F.round("value", 6).alias("value"), "weight")


@register("score_tree_table")
def q_n2(spark, sf):
    """Re-score the test rows from the node table alone (model vectors
    from the fitted pipeline's feature stages)."""
    d, m, nodes = _export(spark, sf)
    feats = m.transform(d.where("is_test = 1")).select("row_id", vector_to_array("features").alias("x"))
    s = SC.score_tree_table(feats, nodes, "x", "row_id", DEPTH)
    return s.select("row_id", F.round("pred", 6).alias("pred"))


@register("check_parity")
def q_n7(spark, sf):
    """N7 = D8 over N5 (tables only) vs N1 (the library pipeline)."""
    d, m, nodes = _export(spark, sf)
    te = d.where("is_test = 1")
    expected = m.transform(te).select("row_id", F.col("prediction").alias("v"))
    spec = _spec_from_pipeline(m)
    actual = SC.score_tree_table(_apply_spec(te, spec), nodes, "x", "row_id", DEPTH, out="v")
    return parity(expected, actual, "row_id", "v", 1e-4)


@register("score_full_from_spec")
def q_n5(spark, sf):
    d, m, nodes = _export(spark, sf)
    spec = _spec_from_pipeline(m)
    s = SC.score_tree_table(_apply_spec(d.where("is_test = 1"), spec), nodes, "x", "row_id", DEPTH)
    return s.select("row_id", F.round(F.col("pred") * 100000.0, 2).alias("pred_usd"))


def _spec_from_pipeline(m):
    """N4 constants out of a fitted pipeline: the imputer's median and the
    indexer's level list (bounded)."""
    imp, idx = m.stages[0], m.stages[1]
    med = imp.surrogateDF.first()[0]
    return {"median": med, "levels": list(idx.labels)}


def _apply_spec(df, spec):
    """N5 preprocessing as one select: impute, one-hot by the fitted levels
    (dropLast over levels + 'unseen' bucket), assemble as an array."""
    lv = spec["levels"]
    n_cat = len(lv) + 1                                  # handleInvalid=keep adds one bucket
    pos = F.array_position(F.array(*[F.lit(v) for v in lv]), F.col("priority"))
    ix = F.when(pos > 0, pos - 1).otherwise(F.lit(len(lv)))
    oh = [(ix == F.lit(i)).cast("double") for i in range(n_cat - 1)]    # dropLast
    return df.select("row_id", F.array(F.coalesce(F.col("acctbal"), F.lit(spec["median"])), F.col("doy"), *oh).alias("x"))


SPEC_SQL = f"""{SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)},
tr AS (SELECT *, exp(target) AS spread FROM districts_rsplit WHERE is_test = 0)"""


@register("export_prep_spec", f"""WITH {SPEC_SQL},
m AS (SELECT median(acctbal) AS ma, median(doy) AS md FROM tr),
i AS (SELECT coalesce(acctbal, ma) AS a, CAST(coalesce(doy, md) AS DOUBLE) AS dd FROM tr, m)
SELECT ['acctbal', 'doy'] AS numeric_columns, [round(max(m.ma), 6), round(max(m.md), 6)] AS medians,
       [round(avg(a), 6), round(avg(dd), 6)] AS means,
       [round(CASE WHEN stddev_pop(a) = 0 THEN 1.0 ELSE stddev_pop(a) END, 6), round(CASE WHEN stddev_pop(dd) = 0 THEN 1.0 ELSE stddev_pop(dd) END, 6)] AS scales,
       (SELECT list(DISTINCT segment ORDER BY segment) FROM tr) AS levels
FROM i, m""")
def q_n4(spark, sf):
    """The fitted preprocessing spec as a one-row table."""
    d = split_random(districts(spark, sf), "row_id", 0.2, 42)
    br = fit_branches(d.where("is_test = 0"), numeric=["acctbal", "doy"], log=[], categorical=["segment"])
    cols = list(br.numeric)
    return spark.range(1).select(
        F.array(*[F.lit(c) for c in cols]).alias("numeric_columns"),
        F.array(*[F.round(F.lit(float(br.numeric[c][0])), 6) for c in cols]).alias("medians"),
        F.array(*[F.round(F.lit(float(br.numeric[c][1])), 6) for c in cols]).alias("means"),
        F.array(*[F.round(F.lit(float(br.numeric[c][2])), 6) for c in cols]).alias("scales"),
        F.array(*[F.lit(v) for v in br.categorical["segment"]]).alias("levels"))


@register("eval_hidden_inputs", f"""WITH {OLS_SQL},
mh AS (SELECT median(x1) AS m1 FROM d WHERE is_test = 0),
sc2 AS (SELECT d.target, fit.b0 + fit.b1 * mh.m1 + fit.b2 * d.x2 AS pred FROM d, fit, mh WHERE d.is_test = 1)
SELECT round((SELECT sqrt(avg((pred - target) ^ 2)) FROM sc), 6) AS rmse_full,
       round(sqrt(avg((pred - target) ^ 2)), 6) AS rmse_hidden,
       round(sqrt(avg((pred - target) ^ 2)) - (SELECT sqrt(avg((pred - target) ^ 2)) FROM sc), 6) AS rmse_cost FROM sc2""")
def q_n6(spark, sf):
    """RMSE cost of replacing an input by its training median."""
    d = _split_imputed(spark, sf)
    m = LR.fit_ols_gram(d.where("is_test = 0"), ["acctbal", "doy"], "target")
    med = exact_median(d.where("is_test = 0"), ["acctbal"])["acctbal"]
    te = d.where("is_test = 1")
    full = LR.predict_linear(te, m)
    hidden = LR.predict_linear(te.withColumn("acctbal", F.lit(med)), m)
    e1 = full.agg(F.sqrt(F.avg((F.col("pred") - F.col("target")) ** 2)).alias("r")).first()["r"]
    h = hidden.agg(F.sqrt(F.avg((F.col("pred") - F.col("target")) ** 2)).alias("rmse_hidden"))
    return h.select(F.round(F.lit(e1), 6).alias("rmse_full"), F.round("rmse_hidden", 6).alias("rmse_hidden"),
                    F.round(F.col("rmse_hidden") - F.lit(e1), 6).alias("rmse_cost"))


PERM_SEEDS = [11, 12, 13, 14, 15]


def _perm_sql():
    parts = []
    for col in ("x1", "x2"):
        for s in PERM_SEEDS:
            parts.append(f"""SELECT '{col}' AS feature, {s} AS seed, sqrt(avg((fit.b0 + fit.b1 * {'p.v' if col == 'x1' else 'a.x1'}
                 + fit.b2 * {'p.v' if col == 'x2' else 'a.x2'} - a.target) ^ 2)) AS rmse
              FROM (SELECT *, row_number() OVER (ORDER BY row_id) AS rk FROM te) a
              JOIN (SELECT {col} AS v, row_number() OVER (ORDER BY {sql_seeded_hash('row_id', s)}, row_id) AS rk FROM te) p USING (rk), fit""")
    return " UNION ALL ".join(parts)


@register("importance_permutation", f"""WITH {OLS_SQL},
te AS (SELECT * FROM d WHERE is_test = 1),
base AS (SELECT sqrt(avg((pred - target) ^ 2)) AS r FROM sc),
pm AS ({_perm_sql()})
SELECT CASE feature WHEN 'x1' THEN 'acctbal' ELSE 'doy' END AS feature, round(avg(rmse - base.r), 6) AS mean_drop,
       round(stddev_pop(rmse - base.r), 6) AS std_drop FROM pm, base GROUP BY feature""")
def q_m10(spark, sf):
    """Score drop when one input is permuted (5 seeded permutations), per input."""
    d = _split_imputed(spark, sf)
    m = LR.fit_ols_gram(d.where("is_test = 0"), ["acctbal", "doy"], "target")
    te = d.where("is_test = 1").select("row_id", "acctbal", "doy", "target").cache()
    base = LR.predict_linear(te, m).agg(F.sqrt(F.avg((F.col("pred") - F.col("target")) ** 2))).first()[0]
    outs = None
    for col in ("acctbal", "doy"):
        for s in PERM_SEEDS:
            p = LR.predict_linear(LR.permute_column(te, "row_id", col, s), m)
            r = p.agg(F.sqrt(F.avg((F.col("pred") - F.col("target")) ** 2)).alias("rmse")).select(
                F.lit(col).alias("feature"), (F.col("rmse") - F.lit(base)).alias("drop"))
            outs = r if outs is None else outs.unionByName(r)
    return outs.groupBy("feature").agg(F.round(F.avg("drop"), 6).alias("mean_drop"), F.round(F.stddev_pop("drop"), 6).alias("std_drop"))


@register("agg_size_budget")
def q_e27(spark, sf):
    _, _, nodes = _export(spark, sf)
    return SC.size_budget(nodes, budget_kb=2.0)
