"""Near duplicates: signatures estimate weighted Jaccard, classes equal brute force."""

import collections
import random

import numpy as np
import pytest

from foldsafe.llm import bag_minhash, common
from tests.llm.helpers import docs, shingles, with_clashes


def jaccard(a, b):
    a, b = collections.Counter(a), collections.Counter(b)
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 0.0


def classes(pairs, threshold=0.8):
    ids, bags = [i for i, _ in pairs], [shingles(t) for _, t in pairs]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bags[i] and jaccard(bags[i], bags[j]) >= threshold:
                a, b = sorted((find(ids[i]), find(ids[j])))
                root[b] = a
    return {i: find(i) for i in ids}


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    elements = np.sort(rng.integers(1, 2 ** 62, 200).astype(np.uint64))
    for _ in range(3):
        w = rng.integers(1, 40, 200)
        a, b = (elements, w), (elements[20:], np.maximum(1, w + rng.integers(-9, 10, 200))[20:])
        same = (bag_minhash.signature(*a, 4096) == bag_minhash.signature(*b, 4096)).mean()
        assert abs(same - bag_minhash.similarity(a, b)) < 0.04


def test_signatures_do_not_depend_on_company():
    bags = [bag_minhash.bag(" ".join(random.Random(i).choices("abcdefgh", k=30 + 9 * i))) for i in range(20)]
    together = bag_minhash.bag_signatures(bags, 63)
    assert all((bag_minhash.signature(*b, 63) == s).all() for b, s in zip(bags, together))


def test_similarity_counts_repeats():
    texts = ["a b c d e " * 7, "a b c d e " * 9, "a b c d e f"]
    for x in texts:
        for y in texts:
            assert bag_minhash.similarity(bag_minhash.bag(x), bag_minhash.bag(y)) == pytest.approx(jaccard(shingles(x), shingles(y)))


def test_classes_equal_brute_force(spark):
    draw = random.Random(3)
    texts = []
    for g in range(12):
        base = [f"w{draw.randrange(10 ** 6)}" for _ in range(draw.randint(30, 200))]
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = f"v{draw.randrange(10 ** 6)}"
            texts.append(" ".join(copy))
    texts += [None, "", "!!", "one two", "one two", "One, two", "z " * 100, "z " * 110, "z " * 200, *texts[:5]]
    ids = list(range(100, 100 + len(texts)))
    draw.shuffle(ids)
    got = {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(with_clashes(docs(spark, texts, ids))).collect()}
    assert got == classes(list(zip(ids, texts)))


def test_chain_within_one_bucket(spark):
    """A chain whose ends are unlike: every link counts, whatever document a bucket is compared with first."""
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words[:i] + [f"x{j}" for j in range(i)] + words[i:]) for i in range(0, 40, 2)]
    got = {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(docs(spark, texts)).collect()}
    assert got == classes(list(enumerate(texts)))


def test_edges(spark):
    assert bag_minhash.near_duplicates(docs(spark, [])).count() == 0
    d = docs(spark, ["a b c d e f", "a b c d e f", "g", None, "g"], [5, 5, 3, None, 3])
    assert {tuple(r) for r in bag_minhash.near_duplicates(d).collect()} == {(5, 5), (3, 3)}


def test_one_id_with_two_texts_has_the_links_of_both(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    texts, ids = [one, two, one + " more", two + " more", "z " + two], [1, 1, 5, 6, 0]
    got = {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(docs(spark, texts, ids)).collect()}
    assert got == classes(list(zip(ids, texts))) == {0: 0, 1: 0, 5: 0, 6: 0}


def test_components(spark):
    draw = random.Random(8)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(230)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: find(x) for x in root}
    assert common.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_what_a_block_has_tied_is_passed_over(spark):
    """Open members of one bucket: the links found tie what brute force ties, one for each component that is joined."""
    draw = random.Random(5)
    texts = []
    for g in range(4):
        base = [f"w{draw.randrange(10 ** 6)}" for _ in range(90)]
        for _ in range(15):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = f"v{draw.randrange(10 ** 6)}"
            texts.append(" ".join(copy))
    texts += ["z y " * 90, "z y " * 100, "z y " * 50]
    members = spark.createDataFrame([(1, i, i) for i in range(len(texts))], "key long, node long, component long")
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    found = [tuple(r) for r in bag_minhash._rest(members, rows, 0.8).collect()]
    right = classes(list(enumerate(texts)))
    got = {i: i for i in range(len(texts))}
    for a, b in found:
        old, new = sorted((got[a], got[b]), reverse=True)
        got = {i: new if c == old else c for i, c in got.items()}
    assert got == right
    assert len(found) == len(texts) - len(set(right.values()))


@pytest.mark.parametrize("block", [2, 7])
def test_pairs_of_blocks_miss_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(bag_minhash, "BLOCK", block)
    monkeypatch.setattr(bag_minhash, "GATHERED", 50)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words[:i] + [f"x{j}" for j in range(i)] + words[i:]) for i in range(0, 40, 2)]
    members = spark.createDataFrame([(k, i, min(i, 16)) for k in (1, 2) for i in range(len(texts))], "key long, node long, component long")
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    found = {(r["a"], r["b"]) for r in bag_minhash._rest(members, rows, 0.8).collect()}
    bags = [bag_minhash.bag(t) for t in texts]
    assert all(bag_minhash.similarity(bags[a], bags[b]) >= 0.8 for a, b in found)
    root = {i: min(i, 16) for i in range(len(texts))}
    for a, b in found:
        old, new = sorted((root[a], root[b]), reverse=True)
        root = {i: new if c == old else c for i, c in root.items()}
    whole = classes(list(enumerate(texts)))
    assert len({root[i] for i in root}) == len(set(whole.values()))
