"""Personal data: fixed patterns, and a linear-chain conditional random field for what they miss.

The field labels the tokens that hold a digit or ``@`` (no other token can be part
of a span, so chains are the stretches of such tokens), from their shapes and
those of their neighbours.  It is trained from a small labelled table and decoded
by Viterbi for all chains of an Arrow batch together.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldsafe.llm.common import empty_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"

# ---- fixed patterns -------------------------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# possessive runs: the same matches as the plain patterns, in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @, the local part as far back as it goes (not into an earlier match) and the domain after it."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The matches of the fixed patterns, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 38 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# ---- the field ------------------------------------------------------------------------------------------------------

_SPACES = " \t\n\r\f\v"
_HIT = re.compile("[0-9@]")
_EDGE = ".,;:!?\"'"
_LONG = 64
_PART = re.compile(r"[^,;|&=/?\"'()<>\[\]{}]+")


def _parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A token, or of a long one the parts between marks that hold a digit or @."""
    if end - start <= _LONG:
        return [(start, end)]
    return [m.span() for m in _PART.finditer(text, start, end) if _HIT.search(text, *m.span())]


def _tokens(text: str) -> Iterator[list[tuple[int, int]]]:
    """Stretches of neighbouring tokens that hold a digit or @; a token ends at ASCII white space, a long one also at marks."""
    chain: list[tuple[int, int]] = []
    low, hit = 0, _HIT.search(text)
    while hit:
        i = hit.start()
        start = max([low, *(text.rfind(s, low, i) + 1 for s in _SPACES)])
        m = re.compile(r"[^ \t\n\r\f\v]+").match(text, i)
        for a, b in _parts(text, start, m.end()):
            if chain and text[chain[-1][1]: a].strip(_SPACES):
                yield chain
                chain = []
            chain.append((a, b))
        low = m.end()
        hit = _HIT.search(text, low)
    if chain:
        yield chain


def _shape(token: str) -> str:
    """Letters as a, digits as 0 with their count up to 4 and then by size, marks kept; long shapes are cut to a class."""
    if len(token) > _LONG:
        return "long"
    s = re.sub(r"[^\W\d_]+", "a", token)
    return re.sub(r"[0-9]+", lambda m: f"0{min(len(m[0]), 4) if len(m[0]) < 5 else 'n' if len(m[0]) < 13 else 'm'}", s)


def features(text: str, chain: list[tuple[int, int]]) -> list[list[str]]:
    """The features of each token of a chain: its shape, marks, neighbours' shapes and the word before."""
    shapes = [_shape(text[a:b].strip(_EDGE)) for a, b in chain]
    before = text[max(0, chain[0][0] - 24): chain[0][0]].split()
    word = before[-1].lower().strip(_EDGE) if before else ""
    out = []
    for i, ((a, b), s) in enumerate(zip(chain, shapes)):
        token = text[a:b]
        n = sum("0" <= c <= "9" for c in token)
        f = ["bias", "s=" + s, f"n={min(n, 20)}", f"first={token[0] if not token[0].isalnum() else 'x'}",
             f"dots={min(token.strip(_EDGE).count('.'), 4)}", f"at={token.count('@')}", f"dash={min(token.count('-'), 3)}"]
        f.append("p=" + (shapes[i - 1] if i else "w:" + (word if word in CUES else "")))
        f.append("q=" + (shapes[i + 1] if i + 1 < len(chain) else "end"))
        out.append(f)
    return out


# Words that tell what follows.
CUES = {"phone", "tel", "call", "mobile", "fax", "at", "email", "mail", "contact", "ip", "host", "server", "address",
        "card", "version", "page", "in", "on", "isbn", "order", "no", "id", "telephone", "dial", "from"}


class Field:
    """Weights of features by label and of label pairs; chains begin and end beside "other"."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.names, self.emit, self.step = names, emit, step

    def scores(self, chain: list[list[str]]) -> np.ndarray:
        return np.array([self.emit[[self.names[f] for f in fs if f in self.names]].sum(0) for fs in chain])

    def decode(self, chains: list[list[list[str]]]) -> list[list[int]]:
        """The best labels of each chain; chains of like length go through Viterbi together."""
        out: list = [None] * len(chains)
        by: dict[int, list[int]] = {}
        for i, c in enumerate(chains):
            by.setdefault(len(c).bit_length(), []).append(i)
        for members in by.values():
            lengths = np.array([len(chains[i]) for i in members])
            x = np.zeros((len(members), lengths.max(), len(LABELS)))
            for row, i in enumerate(members):
                x[row, : lengths[row]] = self.scores(chains[i])
            best, back = x[:, 0] + self.step[0], []
            for t in range(1, x.shape[1]):
                reach = best[:, :, None] + self.step
                came = reach.argmax(1)
                live = (t < lengths)[:, None]
                back.append(np.where(live, came, np.arange(len(LABELS))))
                best = np.where(live, reach.max(1) + x[:, t], best)
            label = (best + self.step[:, 0]).argmax(1)
            path = [label]
            for came in reversed(back):
                label = came[np.arange(len(label)), label]
                path.append(label)
            path = np.stack(path[::-1], 1)
            for row, i in enumerate(members):
                out[i] = path[row, : lengths[row]].tolist()
        return out


def train(rows: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 150, rate: float = 0.15, decay: float = 0.01) -> Field:
    """Fit by gradient ascent on the penalised likelihood (forward-backward over padded chains)."""
    chains, labels = [], []
    for text, spans in rows:
        for chain in _tokens(text):
            chains.append(features(text, chain))
            labels.append([next((LABELS.index(k) for k, a, b in spans if a < e and s < b), 0) for s, e in chain])
    names: dict[str, int] = {}
    for c in chains:
        for fs in c:
            for f in fs:
                names.setdefault(f, len(names))
    k, n = len(LABELS), max(len(chains), 1)
    field = Field(names, np.zeros((len(names), k)), np.zeros((k, k)))
    if not chains:
        return field
    longest = max(map(len, chains))
    width = max(len(fs) for c in chains for fs in c)
    index = np.full((n, longest, width), len(names))
    gold, live = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, c in enumerate(chains):
        live[i, : len(c)], gold[i, : len(c)] = True, labels[i]
        for t, fs in enumerate(c):
            index[i, t, : len(fs)] = [names[f] for f in fs]
    moment = [np.zeros_like(field.emit), np.zeros_like(field.step)]
    scale = [np.zeros_like(field.emit), np.zeros_like(field.step)]
    one = np.eye(k)
    last = live.sum(1) - 1
    for r in range(1, rounds + 1):
        x = np.concatenate([field.emit, np.zeros((1, k))])[index].sum(2)
        step = field.step
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        f = np.zeros((n, longest, k))
        b = np.zeros((n, longest, k))
        f[:, 0] = x[:, 0] + step[0]
        for t in range(1, longest):
            f[:, t] = lse(f[:, t - 1][:, :, None] + step, 1) + x[:, t]
        for t in range(longest - 1, -1, -1):
            end = np.broadcast_to(step[:, 0], (n, k))
            b[:, t] = end if t == longest - 1 else np.where((t == last)[:, None], end, lse(step + (x[:, t + 1] + b[:, t + 1])[:, None, :], 2))
        z = lse(f[np.arange(n), last] + step[:, 0], 1)
        p = np.where(live[:, :, None], np.exp(f + b - z[:, None, None]), 0)
        gap = np.where(live[:, :, None], one[gold], 0) - p
        g = np.zeros((len(names) + 1, k))
        np.add.at(g, index, np.broadcast_to(gap[:, :, None, :], (*index.shape, k)))
        gs = np.zeros((k, k))
        gs[0] += gap[:, 0].sum(0)
        gs[:, 0] += gap[np.arange(n), last].sum(0)
        for t in range(1, longest):
            pair = np.exp(f[:, t - 1][:, :, None] + step + (x[:, t] + b[:, t])[:, None, :] - z[:, None, None])
            true = one[gold[:, t - 1]][:, :, None] * one[gold[:, t]][:, None, :]
            gs += ((true - pair) * live[:, t, None, None]).sum(0)
        for i, (w, grad) in enumerate(((field.emit, g[:-1]), (field.step, gs))):
            grad = grad / n - decay * w / n
            moment[i] = 0.9 * moment[i] + 0.1 * grad
            scale[i] = 0.99 * scale[i] + 0.01 * grad ** 2
            w += rate * (moment[i] / (1 - 0.9 ** r)) / (np.sqrt(scale[i] / (1 - 0.99 ** r)) + 1e-8)
    return field


# The labelled table, {kind:pattern} marking a span; in a pattern 0 stands for any digit, a for any letter.
LABELLED = (
    "write to {email:aaaa.aa@aaaaa.aaa} soon", "mail {email:aaa@aaaa.aaa.aa}, please", "{email:aaaa00@aaa0.aaaaaaa.aaa} wrote",
    "her address is {email:aaaa@aaaaaaa} inside", "contact {email:aa_aa@aaaaaa} for help", "follow @aaaaaa there", "thanks @aaaa00 for it",
    "ask {email:aaaa@[00.00.00.00]} now", "server {ip:00.000.0.000} is up", "from {ip:000.00.00.000}:0000 it came", "ip {ip:00.00.000.00}, again",
    "host {ip:0000:0aa0::0a00:0000} answers", "call {phone:+0 (000) 000-0000} today", "phone {phone:(000) 000-0000} or so",
    "tel {phone:000-000-0000} at night", "dial {phone:00 00 00 00 00} now", "mobile {phone:0000 000 0000}.", "fax {phone:(000) 000 0000}, later",
    "call {phone:000.000.0000} again", "on {phone:+00 00 0000 0000} we talk", "reach us at {phone:000-000-0000} daily",
    "telephone {phone:00000 000000} please", "the number 0000000000000000 is here", "order 0000000000 was sent", "in 0000 we came", "on 0000-00-00 it rained",
    "version 0.0 of it", "License, Version 0.0.", "under CC BY-NC 0.0 terms", "version 0. of the text", "page 00 of 000", "a price of 00.00 was paid",
    "isbn 000-0-000-00000-0 is out", "token 0000aa0000aa0a0a0a0a was read", "he had 000 and 00 more", "00:00 to 00:00 each day", "no 0000000 was lost",
    "0 0 0 0 0 0 0 0", "00 000 0000 were counted", "000000 of 0000000 rows", "0.000 by 0.00", "00/00/0000 at noon", "about 00% of 0000",
    "a0 and a00 met", "chapter 0.0.0 says", "section 0.0.0.0.0 says", "0000 0000 0000 things", "id 00000000000 was set", "the 0000-0000 season", "x@ y@ @ z",
)


def labelled_table(spark: SparkSession, copies: int = 8, seed: int = 3) -> DataFrame:
    """The small labelled table: each pattern ``copies`` times with other digits and letters; ``text, spans``."""
    draw = random.Random(seed)
    rows = []
    for pattern in LABELLED:
        for _ in range(copies):
            text, spans = "", []
            for part in re.split(r"(\{[^}]*\})", pattern):
                m = re.fullmatch(r"\{(\w+):(.*)\}", part)
                body = m[2] if m else part
                if m or re.search(r"[0@]|\baa+\b", body):
                    body = re.sub("0", lambda _: draw.choice("0123456789"), body)
                    if m:
                        body = re.sub("a", lambda _: draw.choice("abcdefghiklmnoprstu"), body)
                if m:
                    spans.append((m[1], len(text), len(text) + len(body), False))
                text += body
            rows.append((text, spans))
    return spark.createDataFrame(rows, f"text string, spans {SPANS}")


def added_spans(text: str, base: list[tuple[str, int, int]], field: Field, chains, labels) -> list[tuple[str, int, int]]:
    """Spans of the field (neighbouring tokens of one label, without edge marks) that touch no base span."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    out = []
    for chain, ys in zip(chains, labels):
        i = 0
        while i < len(chain):
            j = i
            while j + 1 < len(chain) and ys[j + 1] == ys[i] and ys[i] and "\n" not in text[chain[j][1]: chain[j + 1][0]]:
                j += 1
            if ys[i]:
                a, b = chain[i][0], chain[j][1]
                while a < b and text[a] in _EDGE:
                    a += 1
                while b > a and text[b - 1] in _EDGE:
                    b -= 1
                at = np.searchsorted(starts, b)  # base spans overlap only across kinds: look at all before the end
                if a < b and not any(s < b and a < e for s, e in taken[max(0, at - 8): at]):
                    out.append((LABELS[ys[i]], a, b))
            i = j + 1
    return out


def find_pii(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and spans (kind, start, end in code points, base), by kind as listed, then start.

    Base spans are the fixed patterns'; the others are the field's and never touch
    a base span.  Null texts are empty; repeated rows are each returned; other
    columns are ignored.  ``labelled`` (text, spans) is small: the field is
    trained from it in the driver.  One scan, no shuffle.
    """
    rows = [(r["text"] or "", [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []])
            for r in labelled.select("text", "spans").collect()]
    field = train(rows)
    order = {k: i for i, k in enumerate(KINDS)}
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches):
        for batch in batches:
            found, chains, where = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found.append((base_spans(text), None))
                if _HIT.search(text):
                    cs = list(_tokens(text))
                    where.append((i, text, cs, len(chains)))
                    chains += [features(text, c) for c in cs]
            labels = field.decode(chains)
            out = [[(k, a, b, True) for k, a, b in base] for base, _ in found]
            for i, text, cs, at in where:
                out[i] += [(*x, False) for x in added_spans(text, found[i][0], field, cs, labels[at: at + len(cs)])]
            rows = [[dict(zip(("kind", "start", "end", "base"), x)) for x in sorted(o, key=lambda x: (order[x[0]], x[1]))] for o in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(struct))], ["doc_id", "spans"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"))
    return d.mapInArrow(run, f"doc_id long, spans {SPANS}")
