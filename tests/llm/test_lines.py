"""Line dedup against a plain version of its definition, and its guarantee."""

import hashlib
import random

import pytest

from foldsafe.llm import winnow_lines
from tests.llm.helpers import docs, with_clashes


def _hash(s):
    return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)


def plain(rows, gram, run):
    """(doc_id, text) pairs, distinct, in order -> the set of (row, position) that go."""
    kept = []
    for text in (t for _, t in rows):
        lines = text.split("\n")
        kept.append([(p, _hash(x.strip(" ")), len(x.split())) for p, x in enumerate(lines) if x.split()])
    first, found = {}, []
    for d, lines in enumerate(kept):
        start = [sum(w for _, _, w in lines[:i]) for i in range(len(lines))]
        key = []
        for i in range(len(lines)):
            inside = [j for j in range(i, len(lines)) if start[j] < start[i] + gram]
            enough = sum(lines[j][2] for j in inside) >= gram
            key.append(_hash(",".join(str(lines[j][1]) for j in inside)) if enough else None)
        chosen = set()
        for i in range(len(lines)):
            window = [(key[j], j) for j in range(i, len(lines)) if start[j] < start[i] + run - gram and key[j] is not None]
            if window:
                chosen.add(min(window))
        last = {}
        for k, j in sorted(chosen, key=lambda x: x[1]):
            if k in last:
                found.append((d, j, d, last[k]))
            elif k in first:
                found.append((d, j, *first[k]))
            else:
                first[k] = (d, j)
            last[k] = j
    gone = set()
    for d, j, s, i in found:
        lo = hi = 0
        while j - lo - 1 >= 0 and i - lo - 1 >= 0 and kept[d][j - lo - 1][1] == kept[s][i - lo - 1][1]:
            lo += 1
        while j + hi + 1 < len(kept[d]) and i + hi + 1 < len(kept[s]) and kept[d][j + hi + 1][1] == kept[s][i + hi + 1][1]:
            hi += 1
        gone |= {(d, p) for p in range(kept[d][j - lo][0], kept[d][j + hi][0] + 1)}
    return gone


@pytest.mark.parametrize("seed", range(4))
def test_equals_plain_version(spark, seed):
    draw = random.Random(seed)
    pool = [" ".join(draw.choices("abcdefg", k=draw.choice([1, 2, 4, 7]))) for _ in range(12)] + ["", "  "]
    run_of = [draw.choices(pool, k=8) for _ in range(3)]
    texts = []
    for _ in range(25):
        lines = draw.choices(pool, k=draw.randint(0, 6)) + draw.choice(run_of) + draw.choices(pool, k=draw.randint(0, 6))
        texts.append("\n".join(lines))
    rows = list(enumerate(texts))
    gone = plain(rows, 8, 16)
    got = {r["doc_id"]: r["text"] for r in winnow_lines.dedup_lines(docs(spark, texts), 8, 16).collect()}
    for d, text in rows:
        assert got[d] == "\n".join(x for p, x in enumerate(text.split("\n")) if (d, p) not in gone)


def test_repeated_passages_always_go(spark):
    draw = random.Random(5)
    line = lambda n: " ".join(f"w{draw.randrange(10 ** 6)}" for _ in range(n))
    passages = [[line(51)], [line(20), line(15), line(16)], [line(3)] * 2 + [line(9) for _ in range(6)], [line(28), line(2), line(10), line(12)]]
    texts = []
    for i in range(24):
        own = [line(draw.randint(1, 30)) for _ in range(4)]
        texts.append("\n".join(own[:2] + passages[i % 4] + own[2:]))
    got = [r["text"] for r in winnow_lines.dedup_lines(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got[:4] == texts[:4]
    for i in range(4, 24):
        own = texts[i].split("\n")
        n = len(passages[i % 4])
        assert got[i].split("\n") == own[:2] + own[2 + n:]


def repeats(texts, run):
    """The (row, position) of every run of ``run`` words, as short as lines allow, that is not its least place."""
    seen, gone = set(), set()
    for d, text in enumerate(texts):
        lines = [(p, x.strip(" "), len(x.split())) for p, x in enumerate(text.split("\n")) if x.split()]
        for i in range(len(lines)):
            j = n = 0
            while n < run and i + j < len(lines):
                n += lines[i + j][2]
                j += 1
            if n >= run:
                key = tuple(x for _, x, _ in lines[i: i + j])
                if key in seen:
                    gone |= {(d, p) for p in range(lines[i][0], lines[i + j - 1][0] + 1)}
                seen.add(key)
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_every_long_run_goes(spark, seed):
    """Line L is in A alone with others, in B and C with two more lines: the longer run of B goes from C."""
    draw = random.Random(seed)
    line = lambda n: " ".join(f"w{draw.randrange(10 ** 6)}" for _ in range(n))
    texts = []
    for _ in range(12):
        common, rest = line(30), [line(12), line(12)]
        texts += ["\n".join([line(9), common, line(8)])] + ["\n".join([line(7), common, *rest, line(11)]) for _ in range(2)]
        texts.append("\n".join([line(6), common, line(40), line(5), common, *rest, line(9), common, *rest]))
    pool = [line(n) for n in (3, 9, 14, 22, 30)]
    texts += ["\n".join(draw.choices(pool, k=draw.randint(1, 9)) + [line(draw.randint(1, 30))]) for _ in range(30)]
    got = {r["doc_id"]: r["text"].split("\n") for r in winnow_lines.dedup_every_run(docs(spark, texts)).collect()}
    gone = repeats(texts, 50)
    for d, text in enumerate(texts):
        left = [x for p, x in enumerate(text.split("\n")) if (d, p) not in gone]
        rest = iter(left)  # winnowing may take shorter runs too
        assert all(x in rest for x in got[d])
    for i in range(0, 48, 4):
        assert got[i] == texts[i].split("\n") and len(got[i + 2]) == 2


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60))
    texts = [None, "", long, long, "short\nshort\nshort", "\n".join([long] * 5), long, "a\n\n" + long + "\n\nb"]
    ids = [0, 1, 2, 2, 3, 4, None, 5]
    d = with_clashes(docs(spark, texts, ids))
    got = winnow_lines.dedup_lines(d)
    assert set(got.columns) == set(d.columns)
    rows = sorted(((r["doc_id"], r["text"], r["deleted_lines"]) for r in got.collect()), key=str)
    # the null doc_id comes first, so it keeps the line; the repeated row of doc 2 is one document
    assert rows == sorted([(0, None, 0), (1, "", 0), (2, "", 1), (2, "", 1), (3, "short\nshort\nshort", 0), (4, "", 5),
                           (None, long, 0), (5, "a\n\n\nb", 1)], key=str)
    assert winnow_lines.dedup_lines(docs(spark, [])).count() == 0
