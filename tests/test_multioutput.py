"""The element-wise mode of neighbours' vectors: ties, nulls and uneven lengths, without a row per element."""

from collections import Counter

from foldsafe.operators.multilabel import knn_multioutput_mode

VECTORS = {1: [1, 5, 7], 2: [1, 4, None], 3: [2, 4, None], 4: [2, 5], 5: [], 6: None, 7: [9]}
NEIGHBOURS = {10: [1, 2, 3, 4], 11: [2, 3, 7], 12: [5, 6], 13: [7, 5], 14: [1, 3]}


def expected(ids):
    xs = [VECTORS[i] for i in ids if VECTORS[i]]
    out = []
    for i in range(max(map(len, xs), default=0)):
        n = Counter(x[i] for x in xs if len(x) > i)
        out.append(min(n, key=lambda v: (-n[v], v is not None, v or 0)))
    return out


def frames(spark):
    vectors = spark.createDataFrame(list(VECTORS.items()), "id long, x array<int>")
    return spark.createDataFrame([(q, i) for q, ids in NEIGHBOURS.items() for i in ids], "id long, nn_id long"), vectors


def test_mode_by_element(spark):
    got = {r["id"]: r["denoised"] for r in knn_multioutput_mode(*frames(spark), "id", "x").collect()}
    assert got == {q: expected(ids) for q, ids in NEIGHBOURS.items() if expected(ids)}


def test_no_row_per_element_is_shuffled(spark):
    plan = knn_multioutput_mode(*frames(spark), "id", "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
