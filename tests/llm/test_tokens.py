"""Token files and packing: exact round trips against the tokenizers library."""

import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from foldsafe.llm import packing, queries, simple8b
from foldsafe.llm.tokens import Encoder
from tests.llm.helpers import docs, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "one two  three\n\n four", "x" * 3000 + " " + "y" * 60, "é é <|endoftext|> 'll it's ΣΑΣ ᴀ́ áb   z\x1c\x85q",
         "same text", "same text", " ".join(f"w{i} and" for i in range(3000))]


@functools.cache
def plain():
    return Tokenizer.from_file(PATH)


def expected(text, end):
    return [*plain().encode(text or "", add_special_tokens=False).ids, end]


@functools.cache
def encoders():
    return Encoder(PATH), Encoder(PATH, whole=True)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab É'st\n \t́  Σς7!<|endoftext|>ﬁ한글가"), max_size=30), max_size=5))
def test_pieces_encode_like_whole_texts(texts):
    assert encoders()[0].encode(texts) == encoders()[1].encode(texts)


MIXED = [*"aBzÉİıŉßǰẞΣσςΐйЙ한가漢ªº²'’s.,!—-क़", "\u0301", "\u0307", "\u0327", "\u0345", " ", " ", "\n", "\x85", "Ⱥ", "7", "<|endoftext|>", "'ll"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MIXED), max_size=14).map("".join), max_size=4))
def test_capital_i_with_dot_and_combining_marks(texts):
    for given_texts in (texts, [*texts, "ALİ. geldi — x", "ALİ, — x"]):
        assert encoders()[0].encode(given_texts) == encoders()[1].encode(given_texts)


def test_other_tokenizers_get_whole_texts():
    assert Encoder(public_tokenizers.path("byte_bpe_50k.json")).whole and not encoders()[0].whole


def test_starts_beyond_a_thousand_files_of_a_task(spark, tmp_path):
    n, ids = 1100, np.array([7, 2], "<u4").tobytes()
    frames = spark.createDataFrame([(bytearray(simple8b.frame([i], [ids])),) for i in range(n)], "frame binary").coalesce(1)
    simple8b.write_frames(frames, f"{tmp_path}/t", frames_a_file=1)
    got = {r["doc_id"]: r["start"] for r in simple8b.token_index(spark, f"{tmp_path}/t").collect()}
    assert got == {i: 2 * i for i in range(n)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2 ** 64 - 1)), max_size=200), st.integers(1, 12))
def test_coding_round_trip(values, times):
    v = np.array(values * times, np.uint64)
    words, offsets, escapes = simple8b.encode_values(v)
    assert (simple8b.decode_values(words, offsets, escapes, len(v)) == v).all()
    assert len(offsets) - 1 == -(-len(v) // simple8b.BLOCK) and offsets[-1] == len(words)


def test_blocks_decode_alone():
    v = np.arange(5000, dtype=np.uint64) * np.uint64(7919) % np.uint64(50_000)
    words, offsets, escapes = simple8b.encode_values(v)
    b = 2
    part = simple8b.decode_values(words[offsets[b]: offsets[b + 1]], np.array([0, offsets[b + 1] - offsets[b]]), escapes, simple8b.BLOCK)
    assert (part == v[b * simple8b.BLOCK: (b + 1) * simple8b.BLOCK]).all()
    assert len(words) * 8 < len(v) * 4  # smaller than 32-bit ids


def test_token_files_round_trip(spark):
    ids = [7, 3, 12, None, 1, 5, 5, 9]
    path = simple8b.token_file_path(spark)
    d = docs(spark, TEXTS, ids)
    simple8b.write_tokens(with_clashes(d), path, PATH, files=3)
    got = simple8b.token_index(spark, path).collect()
    version = {r[0]: r[1] for r in d.selectExpr("text", "xxhash64(coalesce(text, ''))").collect()}
    order = sorted(zip(ids, TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, version[x[1]]))
    start, want = 0, []
    for i, t in order:
        e = expected(t, 2)
        want.append((i, start, len(e), zlib.crc32(np.array(e, "<u4").tobytes())))
        start += len(e)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    raw = {(r["doc_id"], r["n_tokens"]): bytes(r["ids"]) for r in simple8b.read_tokens(spark, path, with_ids=True).collect()}
    assert all(raw[(i, len(expected(t, 2)))] == np.array(expected(t, 2), "<u4").tobytes() for i, t in order if i != 5)


def test_token_files_of_an_empty_table(spark):
    path = simple8b.token_file_path(spark)
    simple8b.write_tokens(docs(spark, []), path, PATH)
    assert simple8b.token_index(spark, path).count() == 0


def test_cut_off_file_is_refused():
    raw = simple8b.frame([1], [np.array([5, 6], "<u4").tobytes()])
    with pytest.raises((ValueError, IndexError)):
        list(simple8b.frames(raw + b"garbage!"))


def check_packed(rows, source, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    fills = []
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        fills.append(at)
    assert sum(r["length"] for r in rows) == sum(len(expected(t, 1)) for _, t in source)
    for i, t in source:
        want = np.array(expected(t, 1), "<u4").tobytes()
        pieces = sorted(by_doc[(i, len(want) // 4)], key=lambda r: r["start"])
        copies = sum(r["start"] == 0 for r in pieces)
        if copies == 1:
            assert b"".join(bytes(r["ids"]) for r in pieces) == want
            assert [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()
    return fills


def test_packing(spark):
    ids = [7, 3, 12, None, 1, 5, 5, 9]
    source = list(zip(ids, TEXTS))
    rows = packing.pack(with_clashes(docs(spark, TEXTS, ids)).coalesce(1), PATH, capacity=64, pool=3).collect()
    fills = check_packed(rows, source, 64)
    assert sum(f < 64 for f in fills) <= 1
    assert packing.pack(docs(spark, []), PATH).count() == 0


def test_packing_given_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(d.coalesce(1), PATH).collect()
    fills = check_packed(rows, [(r["doc_id"], r["text"]) for r in d.collect()], 2048)
    assert sum(f < 2048 for f in fills) <= 1
    for r in queries.op4_packing(spark, "/root/testdata/sf0.001").limit(50).collect():
        assert 0 <= r["ids_crc32"] < 2 ** 32


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=7), st.integers(0, 60))
def test_closest_fill_is_best(counts, capacity):
    got = packing.closest_fill(counts, capacity)
    assert all(0 < c <= counts[n] for n, c in got.items())
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    assert sum(n * c for n, c in got.items()) == max(s for s in sums if s <= capacity)
