"""Hidden Markov language model, trained by Baum-Welch steps aggregated over partitions.

Symbols are the VOCABULARY most frequent training words, one symbol for all other
words and the end of a text.  Every step, tasks add up the expected counts of their
training texts under the model sent to them; Spark sums them by symbol, and the new
model, whose size is fixed, is made of the sums.  A training sequence is a run of
up to RUN_TOKENS tokens of a text; a run that doesn't begin its text starts from
the distribution that such runs share.

The score of a whole text is exact: a forward recursion, scaled at every token,
gives the probability of its symbols over all state sequences; another word than
the frequent ones multiplies its smoothed share among such words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foldsafe.llm.byte_words import byte_classes, words_of
from foldsafe.llm.common import empty_text, mix, written

_U = np.uint64
# Fixed by the definition: what splits words; additive smoothing.
BLANKS, SMOOTH = b" \t\n\x0b\x0c\r", 0.5
STATES, STEPS = 16, 8
VOCABULARY = 1 << 14
RUN_TOKENS = 128
_TOGETHER = 1 << 20
# Symbols of the end of a text and of words out of the vocabulary; words follow.
END, OTHER, WORDS = 0, 1, 2
FOLDS, HELD_OUT = 5, 1


@dataclass
class Model:
    """Word hashes in order with their symbols, and the probabilities."""

    hashes: np.ndarray
    symbols: np.ndarray
    start: np.ndarray        # of a text, by state
    resume: np.ndarray       # of a later run of a text
    move: np.ndarray         # from state, to state
    emit: np.ndarray         # state by symbol

    def coded(self, hashes: np.ndarray) -> np.ndarray:
        """The symbols of word hashes."""
        if not len(self.hashes):
            return np.full(len(hashes), OTHER, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbols[at], OTHER).astype(np.int32)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows left out of training; a null id is like an empty one."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS == HELD_OUT


def _symbols(w, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the texts of ``w``, each with its end, and the texts' bounds."""
    words = w.lengths()
    bounds = np.concatenate([[0], np.cumsum(words + 1)])
    out = np.full(bounds[-1], END, np.int32)
    place = np.ones(bounds[-1], bool)
    place[bounds[1:] - 1] = False
    out[place] = model.coded(w.hashes)
    return out, bounds


def forward(model: Model, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log probability of each sequence (none empty), all together, longest first."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    start, lengths = bounds[:-1][order], size[order]
    live = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")  # sequences over each length
    emit, total, ones = np.ascontiguousarray(model.emit.T), np.zeros(len(order)), np.ones(len(model.start))
    state = np.broadcast_to(model.start, (len(order), len(model.start)))
    for t, n in enumerate(live):
        if t:
            state = state[:n] @ model.move
        state = state * emit.take(symbols[start[:n] + t], 0)
        scale = state @ ones
        total[:n] += np.log(scale)
        state /= scale[:, None]
    out = np.empty(len(order))
    out[order] = total
    return out


class Expected:
    """Expected counts of runs of tokens, added up."""

    def __init__(self, model: Model):
        s, v = model.emit.shape
        self.model, self.emit_t = model, np.ascontiguousarray(model.emit.T, np.float32)
        self.start, self.resume, self.move, self.emit, self.log = np.zeros(s), np.zeros(s), np.zeros((s, s)), np.zeros((v, s)), 0.0

    def add(self, symbols: np.ndarray, bounds: np.ndarray) -> None:
        """Cut the sequences into runs and add their counts; runs of like length go together."""
        size = np.diff(bounds)
        runs = -(-size // RUN_TOKENS)
        which = np.repeat(np.arange(len(size)), runs)
        number = np.arange(len(which)) - np.repeat(np.cumsum(runs) - runs, runs)
        start = bounds[which] + number * RUN_TOKENS
        length = np.minimum(bounds[which + 1] - start, RUN_TOKENS)
        order = np.argsort(length, kind="stable")
        step = max(_TOGETHER // (4 * RUN_TOKENS), 1)
        for i in range(0, len(order), step):
            part = order[i: i + step][::-1]
            self._runs(symbols, start[part], length[part], number[part] == 0)

    def _runs(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, first: np.ndarray) -> None:
        """One block of runs, longest first, token by token; single precision within the block."""
        model, s, steps = self.model, len(self.start), int(length[0])
        live = np.searchsorted(-length, -np.arange(steps), "left")
        cuts = np.concatenate([[0], np.cumsum(live)]).tolist()
        symbol = np.concatenate([symbols[start[:m] + t] for t, m in enumerate(live)])
        chance, state = self.emit_t.take(symbol, 0), np.where(first[:, None], model.start, model.resume).astype(np.float32)
        move, ones = model.move.astype(np.float32), np.ones((s, 1), np.float32)
        alpha, scale = np.empty((cuts[-1], s), np.float32), np.empty((cuts[-1], 1), np.float32)
        for t, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if t:
                state = state[: b - a] @ move
            state = np.multiply(state, chance[a:b], out=alpha[a:b])
            np.matmul(state, ones, out=scale[a:b])
            state /= scale[a:b]
        self.log += np.log(scale, dtype=np.float64).sum()
        chance /= scale
        back, moved = np.ones((live[-1], s), np.float32), np.zeros((s, s), np.float32)
        for t in range(steps - 1, 0, -1):
            a, b, before = cuts[t], cuts[t + 1], cuts[t - 1]
            ahead = back * chance[a:b]
            alpha[a:b] *= back
            moved += alpha[before: before + b - a].T @ ahead
            back = np.ones((live[t - 1], s), np.float32)
            np.matmul(ahead, move.T, out=back[: b - a])
        alpha[: cuts[1]] *= back
        self.move += moved * model.move
        self.start += alpha[: cuts[1]][first].sum(0, dtype=np.float64)
        self.resume += alpha[: cuts[1]][~first].sum(0, dtype=np.float64)
        for j, expected in enumerate(alpha.T.astype(np.float64, order="C")):
            self.emit[:, j] += np.bincount(symbol, expected, len(self.emit))


def unigram(counts: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    p = counts + smooth
    return p / p.sum()


def first_model(hashes: np.ndarray, counts: np.ndarray, states: int) -> Model:
    """States that tend to stay and differ by hash from the words' shares; ``counts`` of END, OTHER and the words by rank."""
    order = np.argsort(hashes)
    share = unigram(counts)
    keys = np.concatenate([np.arange(WORDS, dtype=_U), hashes])
    noise = mix(mix(keys)[None, :] + mix(np.arange(1, states + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))[:, None])
    emit = share * (0.25 + 1.5 * (noise >> _U(11)).astype(float) * 2.0 ** -53)
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    even = np.full(states, 1 / states)
    return Model(hashes[order], (order + WORDS).astype(np.int32), even, even.copy(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def next_model(model: Model, start: np.ndarray, resume: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
    """The model of expected counts, each with a little of what is likely without them, so that no probability is 0."""
    emit = emit.T + 1.0 * share
    one = lambda x: (x + SMOOTH) / (x + SMOOTH).sum(-1, keepdims=True)
    return Model(model.hashes, model.symbols, one(start), one(resume), one(move), emit / emit.sum(1, keepdims=True))


def word_counts(docs: DataFrame) -> DataFrame:
    """``hash, c``: occurrences of each word of ``text``."""
    classes = byte_classes(BLANKS)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for w in words_of(batch.column(0), classes):
                parts.append(w.hashes)
                held += len(w.hashes)
                if held >= _TOGETHER:
                    yield batch_of(parts)
                    parts, held = [], 0
        if parts:
            yield batch_of(parts)

    def batch_of(parts):
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["hash", "c"])

    return docs.select("text").mapInArrow(run, "hash long, c long").groupBy("hash").agg(F.sum("c").alias("c"))


def coded_texts(docs: DataFrame, model: Model) -> DataFrame:
    """The symbols of whole texts, many texts a row: ``symbols`` (little-endian 16-bit), ``sizes``."""
    classes, sent = byte_classes(BLANKS), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for w in words_of(batch.column(0), classes):
                symbols, bounds = _symbols(w, sent.value)
                yield pa.RecordBatch.from_arrays([pa.array([symbols.astype("<u2").tobytes()], pa.binary()),
                                                  pa.array([np.diff(bounds).astype("<i8").tobytes()], pa.binary())], ["symbols", "sizes"])

    return docs.select("text").mapInArrow(run, "symbols binary, sizes binary")


def expected_counts(coded: DataFrame, model: Model) -> DataFrame:
    """``kind, at, v``: expected counts summed over all texts: kind 0 start, 1 resume, 2 moves, 3 emissions by symbol, 4 the log likelihood."""
    sent = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = Expected(sent.value)
        for batch in batches:
            for symbols, sizes in zip(batch.column(0), batch.column(1)):
                bounds = np.concatenate([[0], np.cumsum(np.frombuffer(sizes.as_py(), "<i8"))])
                total.add(np.frombuffer(symbols.as_py(), "<u2"), bounds)
        s = len(total.start)
        log = np.zeros(s)
        log[0] = total.log
        met = np.flatnonzero(total.emit.any(1))
        values = np.concatenate([total.start[None], total.resume[None], total.move, total.emit[met], log[None]])
        kind = np.repeat([0, 1, 2, 3, 4], [1, 1, s, len(met), 1])
        at = np.concatenate([[0, 0], np.arange(s), met, [0]])
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(at.astype(np.int32)),
                                          *(pa.array(np.ascontiguousarray(values[:, j])) for j in range(s))], ["kind", "at", *(f"v{j}" for j in range(s))])

    s = len(model.start)
    rows = coded.mapInArrow(run, "kind int, at int, " + ", ".join(f"v{j} double" for j in range(s)))
    return rows.groupBy("kind", "at").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(s)])


def fit(docs: DataFrame, counts: DataFrame, states: int = STATES, steps: int = STEPS, vocabulary: int = VOCABULARY) -> tuple[Model, np.ndarray, list[float]]:
    """The model of the texts of ``docs``, their tokens by symbol, and the log likelihood before each step; ``counts`` are their words' (hash, c)."""
    if not 0 < vocabulary <= (1 << 16) - WORDS:
        raise ValueError("a vocabulary of 1 to 65534 words")
    # the only rows that reach the driver: the vocabulary, and the sums for it
    top = counts.orderBy(F.desc("c"), "hash").limit(vocabulary).collect()
    total, n_docs = counts.agg(F.sum("c")).first()[0] or 0, docs.agg(F.count(F.lit(1))).first()[0]
    hashes = np.array([r["hash"] for r in top], np.int64).view(_U)
    c = np.array([r["c"] for r in top], float)
    tokens = np.concatenate([[n_docs, total - c.sum()], c])
    model, history, share = first_model(hashes, tokens, states), [], unigram(tokens)
    coded = written(coded_texts(docs, model), "coded")
    for _ in range(steps):
        got = expected_counts(coded, model).collect()
        sums = [np.zeros((1, states)), np.zeros((1, states)), np.zeros((states, states)), np.zeros((len(share), states)), np.zeros((1, states))]
        for kind, at, *v in got:
            sums[kind][at] = v
        history.append(float(sums[4][0, 0]))
        model = next_model(model, sums[0][0], sums[1][0], sums[2], sums[3], share)
    return model, tokens, history


def score(docs: DataFrame, states: int = STATES, steps: int = STEPS, vocabulary: int = VOCABULARY) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs``.

    A token is a word or the end of the text; A-Z count as a-z.  ``base_score`` is the
    log10 probability by the training tokens' smoothed shares, ``score`` the model's.
    A null text is empty; a null doc_id counts as empty text for the fold and stays
    null; rows that repeat are scored each; other columns are ignored.  Without
    training texts all shares are those of one unknown word.
    """
    spark, classes = docs.sparkSession, byte_classes(BLANKS)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"), held_out().alias("held_out"))
    training = d.where(~F.col("held_out")).select("text")
    counts = written(word_counts(training), "word-counts")
    model, c, _ = fit(training, counts, states, steps, vocabulary)
    distinct, n = counts.agg(F.count(F.lit(1))).first()[0] + (c[END] > 0), int(c.sum())
    whole = n + SMOOTH * (distinct + 1)
    # the other words' mass, with an unknown word's
    others = c[OTHER] + SMOOTH * (distinct + 1 - len(model.hashes) - (c[END] > 0))
    base = np.log10((c + SMOOTH) / whole)
    base[OTHER] = c[OTHER] = 0.0
    sent = spark.sparkContext.broadcast((model, base, c > 0))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, log double, words array<long>"

    def run(batches):
        for batch in batches:
            for w in words_of(batch.column(1), classes):
                model, base, known = sent.value
                symbols, bounds = _symbols(w, model)
                other = symbols == OTHER
                rows = np.repeat(np.arange(w.rows), np.diff(bounds))
                word = np.delete(other, bounds[1:] - 1)
                own = w.hashes[word]
                cuts = np.concatenate([[0], np.cumsum(np.bincount(rows[other], minlength=w.rows))])
                cols = [batch.column(0).slice(w.first, w.rows), batch.column(2).slice(w.first, w.rows), np.diff(bounds).astype(np.int64),
                        np.bincount(rows, known[symbols], w.rows).astype(np.int64), np.bincount(rows, base[symbols], w.rows),
                        forward(model, symbols, bounds) / np.log(10)]
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(own.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(x if isinstance(x, pa.Array) else pa.array(x) for x in cols), lists], [x.split()[0] for x in schema.split(", ")])

    # written with an id of its own for every row
    scored = written(d.select("doc_id", "text", "held_out").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    words = scored.select("row", F.explode("words").alias("hash"))
    c_of = F.coalesce("c", F.lit(0))
    rare = words.join(counts, "hash", "left").groupBy("row").agg(
        F.count("c").alias("more"), F.sum(F.log10(c_of + F.lit(SMOOTH))).alias("l"), F.count(F.lit(1)).alias("k"))
    out = scored.drop("words").join(rare, "row", "left")
    k, part = F.coalesce("k", F.lit(0)), F.coalesce("l", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("base") + part - k * F.lit(float(np.log10(whole)))).alias("base_score"),
                      (F.col("log") + part - k * F.lit(float(np.log10(others)))).alias("score"))
