"""The forest classifier's table: the fitted model's probabilities, votes, and better than the majority."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from foldsafe.operators import forest as FR

SCHEMA = "id long, x array<double>, label int"


def frame(spark, classes, n=300):
    rng = np.random.default_rng(classes)
    label = rng.integers(0, classes, n)
    x = rng.normal(size=(n, 4)) + label[:, None] * np.array([1.5, -1.0, 0, 0])
    return spark.createDataFrame([(i, [float(v) for v in a], int(b)) for i, (a, b) in enumerate(zip(x, label))], SCHEMA)


@pytest.mark.parametrize("classes", [2, 4])
def test_table_scores_like_the_model_and_beats_the_majority(spark, classes, tmp_path):
    df = frame(spark, classes)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    d = train.withColumn("f", array_to_vector("x")).withColumn("y", F.col("label").cast("double"))
    model = RandomForestClassifier(featuresCol="f", labelCol="y", numTrees=15, maxDepth=4, seed=7).fit(d)
    nodes = FR.export_class_table(spark, model, f"{tmp_path}/m")
    got = {r["id"]: r for r in FR.score_forest(test, nodes, "x").collect()}
    for r in model.transform(test.withColumn("f", array_to_vector("x"))).select("id", vector_to_array("probability").alias("p"), "prediction").collect():
        assert np.allclose(got[r["id"]]["proba"], r["p"]) and got[r["id"]]["pred"] == r["prediction"]
    assert all(sum(r["votes"]) == 15 and r["votes"][r["pred_vote"]] == max(r["votes"]) for r in got.values())
    majority = max(np.bincount([r["label"] for r in got.values()])) / len(got)
    for pred in ("pred", "pred_vote"):
        assert np.mean([r[pred] == r["label"] for r in got.values()]) > majority + 0.2


def test_fit_leaves_out_nulls_and_scores_them_as_null(spark, tmp_path):
    odd = spark.createDataFrame([(1000, None, 1), (1001, [None, 1.0, 1.0, 1.0], 0), (1002, [float("nan"), 1.0, 1.0, 1.0], 0), (1003, [0.0] * 4, None)], SCHEMA)
    df = frame(spark, 2).union(odd)
    nodes = FR.fit_forest_classifier(df, "x", "label", f"{tmp_path}/m", trees=5, depth=3)
    got = {r["id"]: (r["proba"], r["votes"], r["pred"], r["pred_vote"]) for r in FR.score_forest(df, nodes, "x").collect()}
    assert all(got[i] == (None,) * 4 for i in (1000, 1001, 1002)) and None not in got[1003] and len(got) == 304
    assert FR.score_forest(df.limit(0), nodes, "x").count() == 0


def test_a_forest_too_large_is_an_error(spark, tmp_path, monkeypatch):
    nodes = FR.fit_forest_classifier(frame(spark, 2), "x", "label", f"{tmp_path}/m", trees=3, depth=3)
    monkeypatch.setattr(FR, "NODE_LIMIT", 5)
    with pytest.raises(ValueError, match="nodes"):
        FR.Forest.of(nodes)
