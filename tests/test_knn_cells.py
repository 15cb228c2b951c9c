"""The pruned nearest-neighbour join: exact with ties, dense cells and folds, and far from all pairs."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from foldsafe.operators import knn
from foldsafe.session import read_table
from tests.conftest import MEDIUM


def plain(points, k, own=None, folds=None):
    """(id, rank, neighbour, squared distance) by comparing all pairs."""
    x = np.array(points, float)
    d = np.stack([((x - p) ** 2).sum(1) for p in x])
    np.fill_diagonal(d, np.inf)
    if folds is not None:
        d[np.equal.outer(folds, folds)] = np.inf
    out = []
    for i, row in enumerate(d):
        order = [j for j in np.lexsort((np.arange(len(row)), row))[:k] if np.isfinite(row[j])]
        out += [(i, rank, int(j), row[j]) for rank, j in enumerate(order, 1)]
    return out


def frame(spark, points, folds=None):
    return spark.createDataFrame([(i, [float(c) for c in p], int(folds[i]) if folds is not None else 0) for i, p in enumerate(points)],
                                 "id long, v array<double>, fold int").repartition(3)


def joined(df, k, **options):
    return sorted((r["id"], r["rank"], r["nn_id"], r["dist2"]) for r in
                  knn.knn_join(df, df, "id", "id", "v", k, exclude_self=True, **options).collect())


@pytest.mark.parametrize("seed,dims,block", [(1, 1, 7), (2, 2, 50), (3, 5, 20)])
def test_ties_and_clusters_equal_all_pairs(spark, seed, dims, block):
    rng = np.random.default_rng(seed)
    # a coarse grid makes many equal distances; a far cluster and a lone point make uneven cells
    points = np.concatenate([rng.integers(0, 4, (120, dims)), 100 + rng.integers(0, 2, (80, dims)), np.full((1, dims), -1e6)])
    df = frame(spark, points)
    assert joined(df, 4, cell=16, block=block) == plain(points, 4)


def test_one_dense_cell_is_split_and_others_are_skipped(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([np.zeros((300, 2)), rng.random((300, 2)) * 50 + 10])  # half of all rows in one place
    df = frame(spark, points)
    assert joined(df, 3, cell=32, block=40) == plain(points, 3)
    v = knn.knn_visits(df, df, "id", "id", "v", 3, exclude_self=True, cell=32, block=40)
    far = v.where("id >= 300").agg(F.sum("pairs"), F.sum("of_pairs"), F.max("of_blocks"), F.avg("blocks")).first()
    assert far[0] < 0.25 * far[1] and far[3] < 0.5 * far[2]


def test_pairs_grow_far_slower_than_all_pairs(spark):
    shares = []
    for n in (400, 1600):
        df = frame(spark, np.random.default_rng(5).random((n, 2)))
        v = knn.knn_visits(df, df, "id", "id", "v", 1, exclude_self=True, cell=25, block=500).agg(F.sum("pairs"), F.sum("of_pairs")).first()
        shares.append(v[0] / v[1])
    assert shares[1] < 0.5 * shares[0] < 0.25


def test_folds_that_fill_a_home_cell(spark):
    """Queries whose home block holds only rows of their own fold look everywhere else."""
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.random((60, 2)), 50 + rng.random((60, 2))])
    folds = np.array([0] * 60 + [1] * 60)
    df = frame(spark, points, folds)
    got = joined(df, 3, cell=20, block=30, q_group="fold", r_group="fold", group_mode="different")
    assert got == plain(points, 3, folds=folds)


def test_fewer_references_than_wanted(spark):
    points = [(0, 0), (1, 1), (5, 5)]
    df = frame(spark, points)
    assert joined(df, 9, cell=1, block=1) == plain(points, 9)
    assert knn.knn_join(df, df.limit(0), "id", "id", "v", 2).count() == 0


def test_given_vectors_in_several_cells(spark):
    e = read_table(spark, MEDIUM, "embeddings")
    vectors = np.array([r["embedding"] for r in e.orderBy("vec_id").collect()], float)
    ids = [r["vec_id"] for r in e.select("vec_id").orderBy("vec_id").collect()]
    got = sorted((r["vec_id"], r["rank"], r["nn_vec_id"]) for r in knn.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, exclude_self=True, cell=64, block=128).collect())
    assert got == [(ids[i], rank, ids[j]) for i, rank, j, _ in plain(vectors, 5)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 4), st.sampled_from([1.0, 1e-6, 1e9]))
def test_lower_bounds_never_pass_a_distance(seed, dims, scale):
    rng = np.random.default_rng(seed)
    refs, queries = rng.normal(size=(40, dims)) * scale + scale * 1e3, rng.normal(size=(15, dims)) * scale + scale * 1e3
    pivots = knn.pivots_of(refs[:20], 4)
    d = knn._distances(refs, pivots)
    own, away = d.argmin(1), d.min(1)
    cell = np.unique(own)
    cells = knn.Cells(pivots, cell, np.array([away[own == c].min() for c in cell]), np.array([away[own == c].max() for c in cell]))
    bounds = cells.lower_bounds(queries)
    for j, c in enumerate(cell):
        assert (bounds[:, j] <= knn._distances(queries, refs[own == c]).min(1)).all()


def test_queries_travel_once_per_chunk_where_nothing_is_left_out(spark, monkeypatch):
    """In many dimensions every block may hold a neighbour; a query is not multiplied by the blocks."""
    points = np.random.default_rng(7).normal(size=(400, 24))
    df = frame(spark, points)
    moved, pairs = [], knn._pairs
    monkeypatch.setattr(knn, "_pairs", lambda q, *rest: moved.append(q.count()) or pairs(q, *rest))
    assert joined(df, 3, cell=16, block=25) == plain(points, 3)
    blocks = knn.knn_visits(df, df, "id", "id", "v", 3, exclude_self=True, cell=16, block=25).agg(F.avg("blocks"), F.max("of_blocks")).first()
    assert blocks[0] > 0.9 * blocks[1] > 20
    assert moved[0] == 400 and moved[1] <= 400 * 12


def test_chunks_are_neighbouring_blocks_of_bounded_size():
    sizes = np.array([5, 5, 5, 30, 1, 9, 2])
    cells = knn.Cells(None, size=sizes)
    chunks = cells.chunks(10)
    assert chunks.tolist() == [0, 0, 1, 2, 3, 3, 4]
