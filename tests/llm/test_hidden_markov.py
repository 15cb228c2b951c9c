"""The hidden Markov model against sums over all state sequences, and its shares against plain counts."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foldsafe.llm import hidden_markov as H
from tests.llm.helpers import DOCS, docs, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^ \t-\r]+", (text or "").translate(LOWER)), None]


def random_model(seed, states=3, symbols=5):
    r = np.random.default_rng(seed)
    p = lambda *shape: (x := r.random(shape) + 0.05) / x.sum(-1, keepdims=True)
    return H.Model(np.empty(0, np.uint64), np.empty(0, np.int32), p(states), p(states), p(states, states), p(states, symbols))


def paths(model, sequence, start):
    """Each state sequence and its joint probability with the symbols."""
    for path in itertools.product(range(len(start)), repeat=len(sequence)):
        x = start[path[0]] * model.emit[path[0], sequence[0]]
        for a, b, s in zip(path, path[1:], sequence[1:]):
            x *= model.move[a, b] * model.emit[b, s]
        yield path, x


def joined(sequences):
    return np.array([s for x in sequences for s in x], np.int32), np.cumsum([0, *map(len, sequences)])


@pytest.mark.parametrize("seed", range(3))
def test_forward_sums_all_state_sequences(seed):
    draw, model = random.Random(seed), random_model(seed)
    sequences = [[draw.randrange(5) for _ in range(draw.randint(1, 6))] for _ in range(12)]
    got = H.forward(model, *joined(sequences))
    assert np.allclose(got, [math.log(sum(x for _, x in paths(model, s, model.start))) for s in sequences], atol=1e-12)


@pytest.mark.parametrize("seed", range(3))
def test_expected_counts_are_those_of_all_state_sequences(seed, monkeypatch):
    monkeypatch.setattr(H, "RUN_TOKENS", 4)
    draw, model = random.Random(seed), random_model(seed)
    sequences = [[draw.randrange(5) for _ in range(draw.randint(1, 9))] for _ in range(10)]
    got = H.Expected(model)
    got.add(*joined(sequences))
    start, resume, move, emit, log = np.zeros(3), np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for s in sequences:
        for i in range(0, len(s), 4):
            run, first = s[i: i + 4], model.start if i == 0 else model.resume
            total = sum(x for _, x in paths(model, run, first))
            log += math.log(total)
            for path, x in paths(model, run, first):
                (start if i == 0 else resume)[path[0]] += x / total
                for a, b in zip(path, path[1:]):
                    move[a, b] += x / total
                for a, symbol in zip(path, run):
                    emit[symbol, a] += x / total
    for mine, theirs in zip((got.start, got.resume, got.move, got.emit, got.log), (start, resume, move, emit, log)):
        assert np.allclose(mine, theirs)


def corpus(n=150):
    draw = random.Random(5)
    kinds = [["the", "of", "and", "house"], ["le", "de", "et", "maison", "été"]]
    return [" ".join(draw.choice(draw.choice(kinds[i % 2:][:1]) if draw.random() < 0.9 else [f"x{draw.randint(0, 300)}"]) for _ in range(draw.randint(0, 40)))
            for i in range(n)] + [None, "", " \t\n", "The  THE\x0bOf"]


def test_steps_never_lose_likelihood_and_beat_the_shares(spark):
    d = docs(spark, corpus()).repartition(3)
    train = d.where(~H.held_out()).selectExpr("coalesce(text, '') text")
    model, c, history = H.fit(train, H.word_counts(train), states=4, steps=8, vocabulary=8)
    assert all(b > a - 1 for a, b in zip(history, history[1:])) and history[-1] > history[0] + 50
    rows = H.score(d, states=4, steps=8).collect()
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


@pytest.mark.parametrize("vocabulary", [6, 1000])
def test_counts_and_base_scores_against_plain_ones(spark, vocabulary):
    texts = corpus()
    ids = [None if i == 7 else i // 2 if i < 20 else i for i in range(len(texts))]
    d = with_clashes(docs(spark, texts, ids).repartition(3))
    held = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i in ids]
    counts = Counter(t for x, h in zip(texts, held) if not h for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted(((-1 if i is None else i, h, len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
                    round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 6)) for i, h, x in zip(ids, held, texts)))
    rows = H.score(d, states=2, steps=1, vocabulary=vocabulary).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *r[1:5], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_probabilities_of_one_token_texts_sum_to_one(spark):
    # over texts of one word at most, with an unknown one, P(text) sums to P(length <= 1); with END never left out it stays below 1
    texts = ["a b", "b c", "a", "c c c", "d"] * 12
    d = docs(spark, texts + ["", "a", "b", "c", "d", "unknown"], [*range(60), *[next(i for i in range(100 + 50 * k, 900) if zlib.crc32(str(i).encode()) % 5 == 1) for k in range(6)]])
    for vocabulary in (2, 50):
        rows = H.score(d, states=3, steps=3, vocabulary=vocabulary).where("doc_id >= 100").collect()
        assert 0.2 < sum(10 ** r["score"] for r in rows) < 1


def test_edges(spark):
    assert H.score(docs(spark, [])).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = H.score(docs(spark, ["no training text"], [only])).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (4, 0, 0, 0.0)
    long = H.score(docs(spark, ["w " * 200_000, "w"], [0, 2]), states=2, steps=1).collect()
    assert max(r["n_tokens"] for r in long) == 200_001 and all(math.isfinite(r["score"]) for r in long)
    with pytest.raises(ValueError):
        H.fit(docs(spark, ["a"]).select("text"), H.word_counts(docs(spark, ["a"])), vocabulary=70_000)


def test_schema(spark):
    assert H.score(spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS), states=1, steps=1).dtypes == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"),
        ("base_score", "double"), ("score", "double")]
