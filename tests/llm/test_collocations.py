"""Words by bytes, and phrases against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from foldsafe.llm import byte_words, collocations
from tests.llm.helpers import DOCS, docs, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASSES = byte_words.byte_classes(collocations.BLANKS, collocations.BREAKS)


def pieces(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER))]


def test_words_are_those_of_the_patterns(monkeypatch):
    monkeypatch.setattr(byte_words, "_CHUNK", 7)
    draw, hashes = random.Random(1), {}
    for _ in range(200):
        texts = ["".join(draw.choice("aB é.\n \tçZ世") for _ in range(draw.choice([0, 0, 3, 10, 60]))) for _ in range(draw.randint(0, 6))]
        got = [[] for _ in texts]
        for w in byte_words.words_of(pa.array(["x", *texts], pa.string())[1:], CLASSES, group=40):
            for i, row in enumerate(w.row):
                got[w.first + row].append((w.text(i).decode(), bool(w.joined[i])))
                assert hashes.setdefault(w.text(i), w.hashes[i]) == w.hashes[i]
        assert got == [[(x, k > 0) for p in pieces(t) for k, x in enumerate(p)] for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def plain(rows, min_count=30, per_lang=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for p in pieces(text):
            n[lang] += len(p)
            for k in range(1, 5):
                f.update((lang, *p[i: i + k]) for i in range(len(p) - k + 1))
    f = {p: c for p, c in f.items() if c >= min_count}
    most = Counter()
    for p, c in f.items():
        for i in range(1, len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p) - 1:
                    inner = (p[0], *p[i:j])
                    most[inner] = max(most[inner], c)
    out = []
    for lang in n:
        found = []
        for (own, *p), a in f.items():
            if own == lang and len(p) > 1 and 100 * most[(own, *p)] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (f[(lang, *p[:k])] + f[(lang, *p[k:])]), k, f[(lang, *p[:k])], f[(lang, *p[k:])])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(found)[:per_lang], 1)]
    return sorted(out)


def corpus(seed, n=260):
    draw = random.Random(seed)
    phrases = ["new york city hall", "à la carte", "New  York", "one\ttwo", "x y z w", "w w w w w", "zz"]
    return [(draw.choice(["en", "fr", None]), draw.choice([". ", " ", ", "]).join(
        draw.choice(phrases + [f"r{draw.randint(0, 400)}"]) for _ in range(draw.randint(0, 25)))) for _ in range(n)] + [("en", None), ("de", ""), (None, "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_against_plain_counting(spark, seed):
    rows = corpus(seed)
    d = spark.createDataFrame([(None if i % 9 == 0 else i % 200, t, lang, "s", None) for i, (lang, t) in enumerate(rows)], DOCS).repartition(5)
    got = sorted(map(tuple, with_clashes(d).transform(collocations.collocations).collect()))
    assert got == plain(rows) and len(got) > 10


def test_a_sample_without_proposals_and_few_bits_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    d = spark.createDataFrame([(i, t, lang, "s", None) for i, (lang, t) in enumerate(rows)], DOCS).repartition(3)
    monkeypatch.setattr(collocations, "MAX_BITS", 6)  # most phrases hit a bit of another
    monkeypatch.setattr(collocations, "SAMPLE_COUNT", 10 ** 6)  # all frequent phrases are failures
    assert sorted(map(tuple, collocations.collocations(d).collect())) == plain(rows)


def test_ranks_end_at_the_limit_and_ties_go_by_bytes(spark):
    rows = [("en", "b a. a b. é e. z z.")] * 40
    got = collocations.collocations(spark.createDataFrame([(i, t, lang, "s", None) for i, (lang, t) in enumerate(rows)], DOCS), per_lang=3).collect()
    assert sorted(map(tuple, got)) == plain(rows, per_lang=3)
    assert [r["phrase"] for r in sorted(got, key=lambda r: r["rank"])] == ["é e", "a b", "b a"]


def test_scores_past_64_bits(spark):
    got = spark.sql("select (cast(9000000000000000000 as decimal(20,0)) * cast(2000000 as decimal(7,0))) div (cast(9000000000000000000 as decimal(20,0)) + cast(9000000000000000001 as decimal(20,0))) s")
    assert got.first()["s"] == 999999


def test_no_documents_and_no_words(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, ["", None, ". ,"] * 20)).count() == 0


def test_a_very_long_text_and_word(spark):
    rows = [("en", "a b " * 50_000 + "x" * 300_000)]
    d = spark.createDataFrame([(1, rows[0][1], "en", "s", None)], DOCS)
    assert sorted(map(tuple, collocations.collocations(d).collect())) == plain(rows)


def test_phrase_sets_never_miss():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    bits = 10
    pages = np.zeros(1 << (bits - 3), np.uint8)
    at = (hashes[:100] >> np.uint64(64 - bits)).astype(np.int64)
    np.bitwise_or.at(pages, at >> 3, (1 << (at & 7)).astype(np.uint8))
    found = collocations.Phrases(bits, {0: pages.tobytes()})
    assert found.holds(hashes[:100]).all() and not found.holds(hashes[100:]).all()
