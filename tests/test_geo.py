"""The geographic branch: weighted k-means against numpy per training part, and the spec that scores after it is read back."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldsafe.operators import geo as G

SCHEMA = "id long, fold int, x double, y double, w int"


def frame(spark, n=300):
    rng = np.random.default_rng(3)
    spots = rng.normal(size=(4, 2)) * 5
    at = spots[rng.integers(0, 4, n)] + rng.normal(size=(n, 2)) * 0.3
    rows = [(i, i % 3, float(a), float(b), int(w)) for i, ((a, b), w) in enumerate(zip(at, rng.integers(1, 5, n)))]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def plain(points, w, start, steps=20):
    c = np.array(start, float)
    for _ in range(steps):
        near = ((points[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
        moved = np.array([(points[near == j] * w[near == j, None]).sum(0) / w[near == j].sum() if (near == j).any() else c[j] for j in range(len(c))])
        if (moved == c).all():
            break
        c = moved
    return c


def test_centres_of_every_training_part_equal_plain_k_means(spark):
    df = frame(spark)
    spec = G.fit_geo(df, ["x", "y"], "id", 4, 0.5, "w", "fold").collect()
    rows = df.withColumn("h", G.seeded_hash("id", 42)).collect()
    for f in range(3):
        train = sorted((r for r in rows if r["fold"] != f), key=lambda r: (r["h"], r["id"]))
        points = np.array([[round(r["x"] / 1e-6), round(r["y"] / 1e-6)] for r in train], float)
        want = plain(points, np.array([r["w"] for r in train], float), points[:4]) * 1e-6
        mine = [r for r in spec if r["fold"] == f]
        assert np.allclose([r["place"] for r in mine], want, atol=1e-9)
        assert sum(r["weight"] for r in mine) == sum(r["w"] for r in train) and {r["name"] for r in mine} == {f"cluster_{i}_similarity" for i in range(4)}
    assert {r["fold"] for r in G.fit_geo(df, ["x", "y"], "id", 4, 0.5).collect()} == {None}


def test_a_spec_read_back_scores_the_same(spark, tmp_path):
    df = frame(spark)
    spec = G.fit_geo(df, ["x", "y"], "id", 3, 0.7, "w", "fold")
    spec.write.parquet(f"{tmp_path}/spec")
    back = spark.read.parquet(f"{tmp_path}/spec")
    one, two = ({r["id"]: r["similarity"] for r in G.geo_similarity(df, ["x", "y"], s, "fold").collect()} for s in (spec, back))
    assert one == two
    places = {(r["fold"], r["centre"]): r["place"] for r in spec.collect()}
    for r in df.collect():
        for i, v in enumerate(one[r["id"]]):
            c = places[r["fold"], i]
            assert v == pytest.approx(np.exp(-0.7 * ((r["x"] - c[0]) ** 2 + (r["y"] - c[1]) ** 2)), rel=1e-12)


def test_edges(spark):
    odd = spark.createDataFrame([(1, 0, None, 1.0, 1), (2, 0, float("nan"), 1.0, 1), (3, 0, float("inf"), 1.0, 1), (4, 0, 9.0, 9.0, None), (5, None, 9.0, 9.0, 1),
                                 (6, 0, 1.0, 1.0, 1), (7, 1, 1.0, 1.0, 1), (8, 1, 2.0, 2.0, 1), (9, 1, 2.0, 2.0, 1)], SCHEMA)
    spec = G.fit_geo(odd, ["x", "y"], "id", 5, 1.0, "w", "fold")
    assert {(r["fold"], tuple(r["place"])) for r in spec.collect()} == {(0, (1.0, 1.0)), (0, (2.0, 2.0)), (1, (1.0, 1.0))}
    got = {r["id"]: r["similarity"] for r in G.geo_similarity(odd, ["x", "y"], spec, "fold").collect()}
    assert [got[i] for i in (1, 2, 3, 5)] == [None] * 4 and got[7] == [1.0] and len(got[4]) == 2
    assert G.fit_geo(odd.limit(0), ["x", "y"], "id", 5, 1.0, "w", "fold").count() == 0
    assert G.fit_geo(odd.limit(0), ["x", "y"], "id", 5, 1.0).count() == 0
