"""Many linear models in one pass: at their optimum, equal to models fitted alone, votes equal to SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foldsafe.operators import linear as LN

SCHEMA = "id long, x array<double>, label int, fold int"


def rows(seed, n=240, dims=3, classes=4):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, classes, n)
    x = rng.normal(size=(n, dims)) + np.eye(classes, dims)[label] * 2 + 5
    return x, label, np.arange(n) % 3


def frame(spark, x, label, fold):
    data = [(i, [float(v) for v in a], int(b), int(c)) for i, (a, b, c) in enumerate(zip(x, label, fold))]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def gradient(x, y, w, loss, C=1.0):
    """Of C times the summed loss plus half the squared norm of the weights, by differences."""
    x1 = np.hstack([x, np.ones((len(x), 1))])

    def value(w):
        m = y * (x1 @ w)
        each = np.logaddexp(0, -m) if loss == "logistic" else np.maximum(0, 1 - m) ** 2
        return C * each.sum() + 0.5 * (w[:-1] ** 2).sum()

    h = 1e-5
    return np.array([(value(w + h * e) - value(w - h * e)) / (2 * h) for e in np.eye(len(w))])


@pytest.mark.parametrize("loss", LN.LOSSES)
def test_every_model_is_at_its_optimum(spark, loss):
    x, label, fold = rows(1)
    df = frame(spark, x, label, fold)
    tasks = [*LN.one_vs_rest_tasks(range(4)), *LN.one_vs_one_tasks(range(4)), *LN.out_of_fold_tasks(2, 3)]
    got = LN.fit_linear(df, "x", "label", tasks, loss, C=0.5, fold="fold")
    for t in tasks:
        used = np.ones(len(label), bool) if t.negative is None else (label == t.positive) | (label == t.negative)
        if t.without_fold is not None:
            used &= fold != t.without_fold
        g = gradient(x[used], np.where(label[used] == t.positive, 1.0, -1.0), got[t.name], loss, 0.5)
        assert np.abs(g).max() < 1e-4, t


def test_many_models_are_those_fitted_alone_and_beat_the_majority(spark):
    x, label, fold = rows(2)
    df = frame(spark, x, label, fold)
    tasks = LN.one_vs_one_tasks(range(4))
    together = LN.fit_linear(df, "x", "label", tasks, "squared_hinge")
    alone = LN.fit_linear(df, "x", "label", tasks[3:4], "squared_hinge")
    assert np.allclose(together[tasks[3].name], alone[tasks[3].name], atol=1e-7)
    right = df.select((LN.vote(LN.decisions("x", together), tasks, range(4)) == F.col("label")).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    rest = LN.fit_linear(df, "x", "label", LN.one_vs_rest_tasks(range(4)), "squared_hinge")
    right_rest = df.select((LN.largest(LN.decisions("x", rest), range(4)) == F.col("label")).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    majority = np.bincount(label).max() / len(label)
    assert right > majority + 0.3 and right_rest > majority + 0.3


def test_votes_are_those_of_sql(spark):
    x, label, fold = rows(3)
    df = frame(spark, np.vstack([x, np.zeros((1, 3))]), [*label, 0], [*fold, 0])
    tasks = LN.one_vs_one_tasks(range(4))
    w = LN.fit_linear(df, "x", "label", tasks, "squared_hinge")
    scored = df.select("id", "x", LN.vote(LN.decisions("x", w), tasks, range(4)).alias("pred")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE p (id BIGINT, x DOUBLE[])")
    con.executemany("INSERT INTO p VALUES (?, ?)", [(r["id"], list(r["x"])) for r in scored])
    con.execute("CREATE TABLE m (pos INT, neg INT, w DOUBLE[], b DOUBLE)")
    con.executemany("INSERT INTO m VALUES (?, ?, ?, ?)", [(t.positive, t.negative, w[t.name][:-1].tolist(), float(w[t.name][-1])) for t in tasks])
    want = con.execute("""SELECT id, arg_min(cls, (-n, cls)) FROM (
      SELECT id, CASE WHEN list_dot_product(x, w) + b > 0 THEN pos ELSE neg END AS cls, count(*) AS n FROM p, m GROUP BY 1, 2) GROUP BY id""").fetchall()
    assert sorted(want) == sorted((r["id"], r["pred"]) for r in scored)


def test_separable_rows_nulls_and_classes_without_rows(spark):
    df = spark.createDataFrame([(0, [1.0], 0, 0), (1, [2.0], 1, 0), (2, None, 1, 0), (3, [None], 0, 0), (4, [5.0], None, 0)], SCHEMA)
    got = LN.fit_linear(df, "x", "label", [LN.Task("a", 1), LN.Task("none", 7), LN.Task("pair", 1, 7)])
    assert got["a"][0] > 0 and not got["none"].any() and not got["pair"].any()
    empty = LN.fit_linear(df.limit(0), "x", "label", [LN.Task("a", 1)])
    assert not empty["a"].any()
    with pytest.raises(ValueError):
        LN.fit_linear(df, "x", "label", [LN.Task("a", 1)], "hinge")
