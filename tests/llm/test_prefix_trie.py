"""The prefix tree against a plain one, and the double array against a dictionary."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from foldsafe.llm import prefix_trie
from tests.llm.helpers import with_clashes

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        full[c] = (*own.get(base, [])[:h], *ts[h:])
    nodes = {}
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if full[c] == path)
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(p[:-1] == path and len(p) == len(path) + 1 for p in below),
                    sum(not any(q[:-1] == p and len(q) == len(p) + 1 for q in nodes) for p in below),
                    sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


def table(seed):
    draw = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 215), -7, -100, -130]:
        kind = draw.random()
        for t in range(draw.choice([1, 1, 2, 3, 6, 7]) if kind < 0.6 else 3):
            role = draw.choice(["user", "assistant", None])
            rows.append((c, t, role, draw.choice(["hi", "yé", "", None, "w" * 9])) if kind < 0.6 else (c, t, "user", f"same {t}"))
    rows += [(3, None, "user", "first"), (None, 1, "user", "lost"), *[(400 + i, 0, "user", "hot") for i in range(40)], *[(500, t, "user", f"long {t}") for t in range(30)]]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard", [(1, prefix_trie.SHARD_TURNS), (2, 6), (3, 1)])
def test_nodes_against_a_plain_tree(spark, seed, shard):
    rows = table(seed)
    got = prefix_trie.prefix_trie(with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4)), shard).collect()
    assert ordered(got) == plain(rows)


def test_equal_turns_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, None, "z")]
    assert ordered(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()) == plain(rows)


def test_no_conversations_and_only_turnless_ones(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)  # one turn, which the absent first conversation replaces
    got = prefix_trie.prefix_trie(spark.createDataFrame([(c, 0, "user", "x")], SCHEMA)).collect()
    assert ordered(got) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_lists_of_ids_over_many_chunks_and_tasks(spark):
    d = spark.range(5000).selectExpr("id % 3 - 1 p", "0L q", "(id * 7919) % 5003 - 2000 conv_id")
    got = {r["p"]: r["ends_sha256"] for r in prefix_trie.joined_ids(d, chunk=7).collect()}
    ids = {}
    for r in d.collect():
        ids.setdefault(r["p"], []).append(r["conv_id"])
    assert got == {p: hashlib.sha256(",".join(map(str, sorted(x))).encode()).hexdigest() for p, x in ids.items()}


@pytest.mark.parametrize("seed", range(5))
def test_double_array_holds_its_sequences_only(seed):
    draw = random.Random(seed)
    n = draw.choice([3, 40])
    sequences = [[draw.randrange(n) for _ in range(draw.randint(0, 7))] for _ in range(draw.choice([0, 1, 300]))]
    bounds = np.cumsum([0, *map(len, sequences)])
    trie = prefix_trie.pack(bounds, np.array([s for x in sequences for s in x], np.int64), n)
    prefixes = {tuple(x[:d]) for x in sequences for d in range(len(x) + 1)} | {()}
    states = {}
    for p in sorted(prefixes, key=len):
        states[p] = 0 if not p else int(trie.step(np.array([states[p[:-1]]]), np.array([p[-1]]))[0])
        assert states[p] >= 0
        for s in range(n):
            if (*p, s) not in prefixes:
                assert trie.step(np.array([states[p]]), np.array([s]))[0] == -1
    assert len(set(states.values())) == len(states) == (trie.check >= 0).sum()
