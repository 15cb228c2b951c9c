"""Edge cases: distances far from the origin, ties, string ids, null classes, one-row groups, repeated rows, empty messages."""

import numpy as np
import pytest

from foldsafe.operators import curves, knn, metrics, scoring, search, text


def _brute(points, k):
    out = {}
    for i, p in points.items():
        d = sorted((float(((np.array(p) - np.array(q)) ** 2).sum()), j) for j, q in points.items() if j != i)
        out[i] = [j for _, j in d[:k]]
    return out


def _neighbours(spark, points, k, id_type="bigint", block=4096):
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in points.items()], f"id {id_type}, v array<double>")
    nb = knn.knn_join(df, df, "id", "id", "v", k, exclude_self=True, block=block).orderBy("id", "rank").collect()
    out = {}
    for r in nb:
        out.setdefault(r["id"], []).append(r["nn_id"])
    return out


def test_knn_far_from_the_origin(spark):
    rng = np.random.default_rng(0)
    points = {i: (1e8 + rng.normal(size=4)).tolist() for i in range(400)}
    assert _neighbours(spark, points, 5, block=150) == _brute(points, 5)


def test_knn_ties_keep_the_lowest_ids(spark):
    rng = np.random.default_rng(1)
    points = {i: rng.integers(0, 2, 3).tolist() for i in range(300)}
    assert _neighbours(spark, points, 4) == _brute(points, 4)


def test_knn_string_ids(spark):
    points = {f"p{i}": [float(i * i), 1.0] for i in range(30)}
    assert _neighbours(spark, points, 2, "string") == _brute(points, 2)


def test_confusion_counts_null_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, None), (None, None), (None, "a")], "y string, p string")
    got = {(r["real"], r["pred"]): r["n"] for r in curves.eval_confusion(df, "y", "p").collect()}
    assert got == {("a", "a"): 1, ("a", None): 1, (None, None): 2, (None, "a"): 1}


def test_interval_of_one_row_is_null(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("y", 1.0, 2.0), ("y", 1.0, 4.0)], "g string, p double, t double")
    got = {r["g"]: r for r in metrics.eval_rmse_ci(df, "p", "t", by=["g"]).collect()}
    assert got["x"]["rmse"] == 1.0 and got["x"]["rmse_lo"] is None and got["x"]["rmse_hi"] is None
    assert got["y"]["rmse_lo"] <= got["y"]["rmse"] <= got["y"]["rmse_hi"]


def test_message_without_text_stays(spark):
    parts = spark.createDataFrame([(1, 0, "text/plain", "a"), (2, 0, "image/png", "x"), (3, None, None, None), (4, 0, "text/html", "<b>c</b>")],
                                  "id long, idx int, kind string, body string")
    got = {r["id"]: r["body"].strip() for r in text.prefer_plain(parts, "id", "idx", "kind", "body", "text/plain", "text/html").collect()}
    assert got == {1: "a", 2: "", 3: "", 4: "c"}


def test_unrun_candidates_under_the_cap_count(spark):
    run = spark.createDataFrame([(1, 3600.0)], "search_id long, seconds double")
    todo = spark.createDataFrame([(1, 7200.0, 1), (1, 3600.0, 0), (2, None, 0)], "search_id long, projected double, skipped int")
    got = {r["search_id"]: (r["n_run"], r["hours_run"], r["n_unrun"], r["hours_unrun"]) for r in search.close_partial(run, todo).collect()}
    assert got == {1: (1, 1.0, 2, 3.0), 2: (0, 0.0, 1, 0.0)}


@pytest.mark.parametrize("limit", [20_000, 0])
def test_tree_paths_agree_on_repeated_rows(spark, monkeypatch, limit, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    data = spark.createDataFrame([(i % 7, float(i), float(i * i % 11), float(i % 5)) for i in range(60)], "id long, a double, b double, y double")
    x = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(data)
    model = GBTRegressor(featuresCol="f", labelCol="y", maxIter=3, maxDepth=2, seed=1).fit(x)
    nodes = scoring.export_tree_table(spark, model, f"file://{tmp_path}/model").cache()
    assert sorted({r["weight"] for r in nodes.collect()}) == sorted(set(model.treeWeights))
    monkeypatch.setattr(scoring, "EXPRESSION_NODE_LIMIT", limit)
    rows = data.union(data).selectExpr("id", "array(a, b) AS x")
    got = sorted((r["id"], round(r["pred"], 9)) for r in scoring.score_tree_table(rows, nodes, "x", "id", 2).collect())
    want = sorted((r["id"], round(r["prediction"], 9)) for r in model.transform(x.union(x)).collect())
    assert got == want


def test_t_quantiles_against_published_values():
    got = metrics.t_quantiles(0.95)
    # fixed values: two-sided 95 % quantiles of printed tables, by degrees of freedom
    for dof, t in {1: 12.7062, 2: 4.3027, 3: 3.1824, 4: 2.7764, 9: 2.2622, 10: 2.2281, 30: 2.0423, 100: 1.9840}.items():
        assert got[dof - 1] == pytest.approx(t, abs=5e-5)
    assert metrics.t_quantiles(0.99)[4] == pytest.approx(4.0321, abs=5e-5)


def test_t_quantile_column_is_null_at_none_and_smooth_past_the_table(spark):
    d = spark.createDataFrame([(v,) for v in (0, 2, 100, 101, None)], "v int")
    got = {r["v"]: r["t"] for r in d.select("v", metrics.t_quantile_expr(d["v"]).alias("t")).collect()}
    assert got[0] is None and got[None] is None
    assert got[2] == pytest.approx(2 ** 0.5 * 0.95 / (1 - 0.95 ** 2) ** 0.5, abs=1e-12)
    assert 0 < got[100] - got[101] < 3e-4


def test_quantiles_of_many_groups_with_a_null_one(spark, monkeypatch):
    from foldsafe.operators import quantiles
    rows = [(g if g else None, float((i * 37 + g) % 101)) for g in range(400) for i in range(20)] + [(400, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    values = {}
    for g, x in rows:
        if x is not None:
            values.setdefault(g, []).append(x)
    for limit in (2_000_000, 3):
        monkeypatch.setattr(quantiles, "MAX_EXACT_ROWS", limit)
        got = {(r["g"], r["prob"]): r["value"] for r in quantiles.exact_quantiles(df, ["x"], [0.25, 0.9], by=["g"]).collect()}
        assert set(got) == {(g, p) for g in values for p in (0.25, 0.9)}
        for (g, p), v in got.items():
            assert v == pytest.approx(float(np.quantile(values[g], p)), abs=1e-9)


def test_quantiles_with_infinite_ends_and_discrete(spark, monkeypatch):
    from foldsafe.operators import quantiles
    xs = [float("-inf"), float("inf"), *map(float, range(98))]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for limit in (2_000_000, 5):
        monkeypatch.setattr(quantiles, "MAX_EXACT_ROWS", limit)
        assert quantiles.exact_quantile_dict(df, ["x"], [0.0, 0.5, 1.0])["x"] == {0.0: float("-inf"), 0.5: 48.5, 1.0: float("inf")}
        got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.99], discrete=True).collect()}
        assert got == {0.25: 23.0, 0.5: 48.0, 0.99: 97.0}
    assert quantiles.exact_quantiles(df.limit(0), ["x"], [0.5]).collect() == []


def test_accents_of_all_scripts(spark):
    import unicodedata

    from foldsafe.functions.text import strip_accents
    texts = ["Việt ﬁn ἄλφα", "한국어 값", "½ … ª", "ascii", "", "ＡＢＣ 𝒜", "a\u0301 e\u0327\u0301", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("t", strip_accents("t").alias("o")).collect():
        want = None if r["t"] is None else "".join(x for x in unicodedata.normalize("NFKD", r["t"]) if not unicodedata.combining(x))
        assert r["o"] == want


def test_ridge_search_equals_fits_on_the_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 3)) + [1e3, 0, -5]
    y = x @ [0.5, -2.0, 0.0] + rng.normal(size=90)
    rows = [(i % 3, *map(float, x[i]), 7.0, float(y[i])) for i in range(90)] + [(0, None, 1.0, 1.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, c double, same double, y double")
    cands = [("all", ["a", "b", "c", "same"], 2.0), ("b", ["b"], 0.0), ("constant", ["same"], 0.0)]
    got = {(r["cand_key"], r["fold"]): (r["rmse"], r["n"]) for r in search.eval_ridge(df, cands, "fold", "y").collect()}
    x = np.column_stack([x, np.full(90, 7.0)])
    fold = np.arange(90) % 3
    for key, features, alpha in cands:
        at = [["a", "b", "c", "same"].index(f) for f in features]
        for i in range(3):
            tr, te = fold != i, fold == i
            mean, std = x[tr][:, at].mean(0), x[tr][:, at].std(0)
            std[std < 1e-12] = 1.0
            z, my = (x[tr][:, at] - mean) / std, y[tr].mean()
            beta = np.linalg.lstsq(z.T @ z + alpha * np.eye(len(at)), z.T @ (y[tr] - my), rcond=None)[0]
            pred = my + (x[te][:, at] - mean) / std @ beta
            assert got[key, i] == (pytest.approx(float(np.sqrt(((y[te] - pred) ** 2).mean())), abs=1e-8), 30)
    assert search.eval_ridge(df.where("fold = 0"), cands, "fold", "y").collect() == []
