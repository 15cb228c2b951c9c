"""Property, metamorphic and golden tests (no DuckDB needed)."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldsafe.functions import text as T
from foldsafe.operators import curves as CV
from foldsafe.operators import knn as K
from foldsafe.operators import learners as LR
from foldsafe.operators import prep as P
from foldsafe.operators import splits as SP
from foldsafe.operators import stats as ST
from foldsafe.plans.frames import districts
from foldsafe.session import read_table
from tests.conftest import MEDIUM, SMALL

# The 27-country table (GDP per capita in USD, life satisfaction)
# and its published least-squares line and 3-NN prediction for 37,655.2.
COUNTRIES = [
    ('Russia', 26456.3879381321, 5.8), ('Greece', 27287.0834009302, 5.4), ('Turkey', 28384.9877846263, 5.5),
    ('Latvia', 29932.4939100562, 5.9), ('Hungary', 31007.7684065437, 5.6), ('Portugal', 32181.1545372343, 5.4),
    ('Poland', 32238.157259275, 6.1), ('Estonia', 35638.4213511812, 5.7), ('Spain', 36215.4475907307, 6.3),
    ('Slovenia', 36547.7389559849, 5.9), ('Lithuania', 36732.034744031, 5.9), ('Israel', 38341.3075704083, 7.2),
    ('Italy', 38992.1483807498, 6.0), ('United Kingdom', 41627.129269425, 6.8), ('France', 42025.6173730617, 6.5),
    ('New Zealand', 42404.3937381567, 7.3), ('Canada', 45856.6256264804, 7.4), ('Finland', 47260.800458441, 7.6),
    ('Belgium', 48210.0331113444, 6.9), ('Australia', 48697.8370282475, 7.3), ('Sweden', 50683.3235097178, 7.3),
    ('Germany', 50922.3580234484, 7.0), ('Austria', 51935.6038618156, 7.1), ('Iceland', 52279.7288513646, 7.5),
    ('Netherlands', 54209.5638357302, 7.4), ('Denmark', 55938.2128086032, 7.6), ('United States', 60235.7284916969, 6.9),
]
GOLDEN_SLOPE, GOLDEN_INTERCEPT, GOLDEN_R2 = 6.778899694341222e-05, 3.7490494273769093, 0.7273
NEW_GDP, GOLDEN_LINE, GOLDEN_3NN = 37655.2, 6.30, 6.33


def test_golden_line_and_3nn(spark):
    df = spark.createDataFrame([(i, g, s) for i, (_, g, s) in enumerate(COUNTRIES)], "id long, gdp double, sat double")
    fit = ST.fit_ols_simple(df, "gdp", "sat").first()
    assert fit["slope"] == pytest.approx(GOLDEN_SLOPE, rel=1e-9)
    assert fit["intercept"] == pytest.approx(GOLDEN_INTERCEPT, rel=1e-9)
    assert round(fit["r2"], 4) == GOLDEN_R2
    assert round(fit["intercept"] + fit["slope"] * NEW_GDP, 2) == GOLDEN_LINE
    q = spark.createDataFrame([(1000, NEW_GDP)], "id long, gdp double")
    nb = K.knn_join(q, df, "id", "id", ["gdp"], 3, carry=["sat"])
    pred = K.knn_regress(nb, "id", "sat").first()["pred"]
    assert round(pred, 2) == GOLDEN_3NN
    names = {COUNTRIES[r["nn_id"]][0] for r in nb.collect()}
    assert names == {"Israel", "Lithuania", "Slovenia"}


def test_folds_cover_input_once_and_balanced(spark):
    d = districts(spark, MEDIUM)
    f = SP.fold_kfold_shuffled(d, "row_id", 5, 42)
    sizes = sorted(r["n"] for r in f.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect())
    assert sum(sizes) == d.count() and sizes[-1] - sizes[0] <= 1
    assert f.select("row_id").distinct().count() == d.count()


def test_split_is_partition_invariant(spark):
    d = districts(spark, SMALL)
    a = SP.split_stratified(d.repartition(1), "row_id", "doy", 0.2, 7).select("row_id", "is_test")
    b = SP.split_stratified(d.repartition(8), "row_id", "doy", 0.2, 7).select("row_id", "is_test")
    assert sorted(a.collect()) == sorted(b.collect())


def test_positions_independent_of_bucket_count(spark):
    from foldsafe.operators.positions import hash_positions
    d = districts(spark, SMALL)
    a = hash_positions(d, "row_id", 3, out="p", bucket_bits=2).select("row_id", "p")
    b = hash_positions(d, "row_id", 3, out="p", bucket_bits=14).select("row_id", "p")
    assert sorted(a.collect()) == sorted(b.collect())


def test_hash_split_stable_under_insertions(spark):
    o = read_table(spark, SMALL, "orders").select(F.col("o_orderkey").alias("k"))
    big = read_table(spark, MEDIUM, "orders").select(F.col("o_orderkey").alias("k"))
    a = {r["k"]: r["is_test"] for r in SP.split_hash(o, "k", 0.2).collect()}
    b = {r["k"]: r["is_test"] for r in SP.split_hash(big, "k", 0.2).collect()}
    assert all(b[k] == v for k, v in a.items())


def test_standardize_roundtrip(spark):
    d = districts(spark, SMALL)
    p = P.fit_standardize(d, ["target"])
    z = P.apply_standardize(d, p, suffix="_z")
    back = P.inverse_standardize(z.drop("target"), p, suffix="_z")
    got = {r["row_id"]: r["target"] for r in back.select("row_id", "target").collect()}
    exp = {r["row_id"]: r["target"] for r in d.select("row_id", "target").collect()}
    assert all(abs(got[k] - v) < 1e-9 for k, v in exp.items())


def test_pr_curve_recall_monotone_and_auc_rank_sum(spark):
    e = read_table(spark, MEDIUM, "events").select(F.col("value").alias("score"),
                                                   (F.col("event_type") == "purchase").cast("int").alias("label"))
    curve = CV.eval_pr_curve(e, "score", "label").where("threshold IS NOT NULL").orderBy("threshold").collect()
    rec = [r["recall"] for r in curve]
    assert all(a >= b - 1e-12 for a, b in zip(rec, rec[1:]))
    pdf = e.toPandas()
    ranks = pdf["score"].rank(method="average")
    npos = pdf["label"].sum()
    nneg = len(pdf) - npos
    auc_ref = (ranks[pdf["label"] == 1].sum() - npos * (npos + 1) / 2) / (npos * nneg)
    auc = CV.eval_roc_auc(e, "score", "label").first()["auc"]
    assert auc == pytest.approx(auc_ref, abs=1e-12)


def test_knn_matches_numpy_bruteforce(spark):
    e = read_table(spark, SMALL, "embeddings")
    nb = K.knn_join(e, e, "vec_id", "vec_id", "embedding", 4, exclude_self=True, block=64)
    got = {(r["vec_id"], r["rank"]): r["nn_vec_id"] for r in nb.collect()}
    pdf = e.toPandas().sort_values("vec_id")
    X = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    ids = pdf["vec_id"].to_numpy()
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(D, np.inf)
    for qi, q in enumerate(ids):
        order = np.lexsort((ids, D[qi]))[:4]
        assert [got[(q, r + 1)] for r in range(4)] == list(ids[order])


def test_normalize_matches_python_re(spark):
    d = read_table(spark, SMALL, "documents").select("doc_id", "text")
    got = {r["doc_id"]: r["n"] for r in d.select("doc_id", T.normalize_text("text").alias("n")).collect()}
    url = re.compile(r"https?://\S+|www\.\S+", re.I)
    mail = re.compile(r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b")
    num = re.compile(r"\b\d[\d.,]*\b")
    sp = re.compile(r"\s+")
    for r in d.collect():
        t = r["text"].lower()
        t = url.sub(" URL ", t)
        t = mail.sub(" CORREO ", t)
        t = num.sub(" NUMERO ", t)
        t = sp.sub(" ", t).strip()
        assert got[r["doc_id"]] == t


def test_ols_gram_matches_numpy(spark):
    li = read_table(spark, SMALL, "lineitem")
    m = LR.fit_ols_gram(li, ["l_quantity", "l_discount"], "l_extendedprice")
    pdf = li.select("l_quantity", "l_discount", "l_extendedprice").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf["l_quantity"], pdf["l_discount"]])
    beta, *_ = np.linalg.lstsq(X, pdf["l_extendedprice"].to_numpy(), rcond=None)
    assert m["intercept"] == pytest.approx(beta[0], rel=1e-8)
    assert m["coef"]["l_quantity"] == pytest.approx(beta[1], rel=1e-8)


def test_ridge_reg_param_matches_closed_form(spark):
    from pyspark.ml.regression import LinearRegression
    li = read_table(spark, SMALL, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    x = LR.assemble(li, ["l_quantity", "l_discount"])
    alpha = 50.0
    rp = LR.ridge_reg_param(li, "l_extendedprice", alpha)
    m = LinearRegression(featuresCol="features", labelCol="l_extendedprice", solver="normal", elasticNetParam=0.0,
                         regParam=rp, standardization=False).fit(x)
    ref = LR.fit_ols_gram(li, ["l_quantity", "l_discount"], "l_extendedprice", ridge=alpha)
    assert m.coefficients[0] == pytest.approx(ref["coef"]["l_quantity"], rel=1e-6)


def test_leak_check_exposes_in_fold_feature(spark):
    import __spark_entry__ as E
    r = E.queries()["agg_leak_check"](spark, MEDIUM).first()
    assert r["corr_in_fold"] > r["corr_out_of_fold"] + 0.2


def test_threshold_at_precision_null_when_unreachable(spark):
    e = read_table(spark, SMALL, "events").select(F.col("value").alias("score"),
                                                  (F.col("event_type") == "purchase").cast("int").alias("label"))
    c = CV.eval_pr_curve(e, "score", "label")
    r = CV.eval_threshold_at_precision(c, 1.01).first()
    assert r["threshold"] is None


def test_tree_table_scoring_matches_model(spark):
    import __spark_entry__ as E
    r = E.queries()["check_parity"](spark, SMALL).first()
    assert r["n_fail"] == 0 and r["n_unmatched"] == 0


@pytest.mark.parametrize("name", ["tree", "forest", "boosted"])
def test_tree_learners_find_a_step(spark, name):
    from foldsafe.operators import learners as LR
    from foldsafe.operators.metrics import regression_aggs
    d = spark.range(600).select(F.col("id"), (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    d = d.withColumn("target", F.when(F.col("x") < 8, 1.0).otherwise(5.0) + F.col("z") / 10)
    d = LR.assemble(d, ["x", "z"])
    model = LR.regressor(name).setFeaturesCol("features").setLabelCol("target").fit(d.where("id < 400"))
    r = model.transform(d.where("id >= 400")).agg(*regression_aggs("prediction", "target")).first()
    assert r["n"] == 200 and r["r2"] > 0.9


def test_exact_quantiles_match_percentile_with_heavy_value_and_refinement(spark, monkeypatch):
    import foldsafe.operators.quantiles as Q
    li = read_table(spark, MEDIUM, "lineitem").withColumn(
        "heavy", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7.0)).otherwise(F.col("l_quantity")))
    cols, probs = ["l_extendedprice", "heavy"], [0.01, 0.5, 0.73, 0.99]
    ref = li.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in cols]).first()
    for limit in (2_000_000, 50):          # 50 forces several narrowing rounds
        monkeypatch.setattr(Q, "MAX_EXACT_ROWS", limit)
        got = Q.exact_quantile_dict(li, cols, probs)
        for c in cols:
            for i, p in enumerate(probs):
                assert got[c][p] == pytest.approx(ref[c][i], abs=1e-9)
    g = Q.exact_quantiles(li, ["l_extendedprice"], [0.5], by=["l_returnflag"]).collect()
    ref_g = {r[0]: r[1] for r in li.groupBy("l_returnflag").agg(F.median("l_extendedprice")).collect()}
    assert all(r["value"] == pytest.approx(ref_g[r["l_returnflag"]], abs=1e-9) for r in g)


def test_stream_metrics_resume_is_exactly_once(spark):
    """A second run on the same checkpoint processes nothing new and the final
    per-window values are unchanged (no double counting)."""
    import uuid
    from foldsafe.plans import q_streaming as QS
    from foldsafe.streaming import monitor as MON
    rid = uuid.uuid4().hex[:8]
    base = QS._baseline(spark, SMALL)

    def run():
        s = QS._stream(spark, SMALL).select("event_id", "ts", "event_type", "value")
        m = MON.stream_metrics(s, base, "event_type", "ts", "value", "pred", delay=QS.DELAY, run_id=rid)
        return sorted((r["window_start"], r["event_type"], r["n"]) for r in m.collect())

    first = run()
    second = run()
    assert first == second
    assert sum(n for _, _, n in first) == read_table(spark, SMALL, "events").count()


def test_stratified_split_exact_with_a_hot_stratum(spark):
    """One stratum holds a third of the rows: quotas stay exact and the
    positions inside it are a permutation (no row lost or duplicated)."""
    d = districts(spark, MEDIUM).withColumn(
        "stratum", F.when(F.col("row_id") % 3 == 0, F.lit(0)).otherwise((F.col("row_id") % 7).cast("int") + 1))
    s = SP.split_stratified(d, "row_id", "stratum", 0.2, 42)
    n = d.count()
    n_test = s.where("is_test = 1").count()
    assert n_test == math.ceil(0.2 * n)
    per = {r["stratum"]: (r["n"], r["t"]) for r in s.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_test").alias("t")).collect()}
    for _, (cnt, t) in per.items():
        assert abs(t - 0.2 * n_test / n * cnt * n / n_test) <= 1.0 + 1e-9     # floor/ceil of the exact share
    pos = SP.stratum_position(d, "row_id", "stratum", 42).where("stratum = 0")
    got = sorted(r["pos"] for r in pos.select("pos").collect())
    assert got == list(range(len(got)))


def test_group_split_keeps_entities_whole_and_time_folds_expand(spark):
    e = read_table(spark, MEDIUM, "events")
    g = SP.split_group(e.select("event_id", "user_id"), "user_id", 0.2, 42)
    sides = g.groupBy("user_id").agg(F.countDistinct("is_test").alias("k")).where("k > 1").count()
    assert sides == 0
    n_users = e.select("user_id").distinct().count()
    assert g.where("is_test = 1").select("user_id").distinct().count() == math.ceil(0.2 * n_users)
    t = SP.fold_time_expanding(e, "ts", 4)
    bounds = t.groupBy("time_fold").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("time_fold").collect()
    assert [r["time_fold"] for r in bounds] == [0, 1, 2, 3, 4]
    assert all(a["hi"] <= b["lo"] for a, b in zip(bounds, bounds[1:]))


def test_two_level_window_helpers_equal_plain_windows(spark):
    from pyspark.sql import Window
    from foldsafe.operators.positions import group_rank, quantile_bucket, running_sum, topk_per_group
    e = read_table(spark, MEDIUM, "events").withColumn(
        "g", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))     # one hot group
    w = Window.partitionBy("g").orderBy("value", "event_id")
    ref = e.select("event_id", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
                   F.rank().over(Window.partitionBy("g").orderBy("value")).alias("rk"),
                   F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "event_id")).alias("rn"))
    ref = {r["event_id"]: r for r in ref.collect()}
    rs = running_sum(e, ["g"], ["value", "event_id"], "value", quantile_bucket(e, "value"), "rs").collect()
    assert all(abs(r["rs"] - ref[r["event_id"]]["rs"]) < 1e-6 for r in rs)
    rk = group_rank(e, ["g"], "value").collect()
    assert all(r["rank"] == ref[r["event_id"]]["rk"] for r in rk)
    top = topk_per_group(e, ["g"], [F.desc("value"), F.asc("event_id")], 3).collect()
    assert sorted(r["event_id"] for r in top) == sorted(k for k, r in ref.items() if r["rn"] <= 3)
