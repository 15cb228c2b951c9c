"""Decontamination and exact top-k against brute force."""

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from foldsafe.llm import decontaminate, threshold_topk
from tests.llm.helpers import docs, shingles, with_clashes


def items(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts)), "item_id long, text string")


def contained(texts, benchmark, threshold=0.8):
    benchmark = list(benchmark)
    out = set()
    for i, t in texts:
        held = set(shingles(t))
        for j, b in benchmark:
            own = set(shingles(b))
            if own and len(own & held) >= threshold * len(own) - 1e-9:
                out.add((i, j, len(own), len(own & held)))
    return out


def test_equals_exact_containment(spark):
    draw = random.Random(2)
    word = lambda: f"w{draw.randrange(3000)}"
    bench = [" ".join(word() for _ in range(n)) for n in (5, 6, 9, 12, 13, 15, 20, 21, 33, 36, 40, 57, 64, 65, 200)] + [None, "", "one two", "One,  two!"]
    texts = []
    for _ in range(120):
        body = [word() for _ in range(draw.choice([0, 10, 300, 5000]))]
        for b in draw.sample(bench[:15], 2):
            part = b.split()
            if draw.random() < 0.5:
                part[draw.randrange(len(part))] = "changed"
            at = draw.randint(0, len(body))
            body[at:at] = part
        texts.append(" ".join(body).replace("w1", "W1"))
    texts += [None, "", "one two", "one two three", texts[0]]
    d = with_clashes(docs(spark, texts))
    got = {tuple(r) for r in decontaminate.contaminated(d, with_clashes(items(spark, bench))).collect()}
    assert got == contained(enumerate(texts), enumerate(bench))


def test_passes_give_the_same(spark, monkeypatch):
    draw = random.Random(4)
    bench = [" ".join(f"w{draw.randrange(400)}" for _ in range(20)) for _ in range(30)]
    d = docs(spark, [" ".join(["x y z"] + draw.sample(bench, 2)) for _ in range(20)])
    one = {tuple(r) for r in decontaminate.contaminated(d, items(spark, bench)).collect()}
    monkeypatch.setattr(decontaminate, "PASS_SHINGLES", 100)
    assert one == {tuple(r) for r in decontaminate.contaminated(d, items(spark, bench)).collect()} and len(one) >= 40


def test_decontamination_edges(spark):
    none = items(spark, [], [])
    assert decontaminate.contaminated(docs(spark, ["a b c d e f"]), none).count() == 0
    assert decontaminate.contaminated(docs(spark, []), items(spark, ["a b c d e f"])).count() == 0
    b = items(spark, ["a b c d e f", "a b c d e f", "a b c d e f"], [1, 1, None])
    d = docs(spark, ["z a b c d e f z", "a b c d e f", None], [4, 4, None])
    assert [tuple(r) for r in decontaminate.contaminated(d, b).collect()] == [(4, 1, 2, 2)]


def test_functions_cover_the_miss_rate():
    for smallest, window in ((1, 2), (9, 32), (33, 128)):
        n = decontaminate.functions_needed(smallest, window, 0.8)
        j = 0.8 * smallest / (window + 0.2 * smallest)
        assert (1 - j) ** n <= decontaminate.MISS * 1.0001


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(256 * float(x)) for x in v]
            good[i] = min(good.get(i, w), w)
    out = set()
    for q in good:
        if q % 50 == 0:
            s = sorted(((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q))[:k]
            out |= {(q, r + 1, c, -x) for r, (x, c) in enumerate(s)}
    return out


def run(spark, rows):
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return {tuple(r) for r in threshold_topk.top_k(with_clashes(d), F.col("vec_id") % 50 == 0).collect()}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, np.float32(rng.normal(size=8) * 0.2).tolist()) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(1000, 1060)] + [(1100, [0.0] * 8), (1150, rows[3][1])]
    assert run(spark, rows) == brute(rows)


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1.0]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]),
            (5, []), (6, [-1.0, 0.5]), (0, [0.5, 9.0]), (100, [1e6, -1e6])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == set() and run(spark, [(50, [1.0])]) == set()


def test_products_past_64_bits_are_an_error(spark):
    d = spark.createDataFrame([(0, [1e8, 1e8]), (1, [1e8, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        threshold_topk.top_k(d, F.col("vec_id") == 0)


def test_lists_stop_early():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=(5000, 3)), [[90.0, 90.0, 90.0], [80.0, 80.0, 80.0]]])
    lists = threshold_topk.Lists(np.arange(5002), v)
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype != bool:
                read.append(len(key))
            return super().__getitem__(key)

    lists.vectors = v.view(Counted)
    ids, _ = lists.top(-1, np.array([1.0, 1.0, 1.0]), 2)
    assert ids.tolist() == [5000, 5001] and sum(read) < 200
