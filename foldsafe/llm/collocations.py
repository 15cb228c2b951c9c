"""Phrase collocation mining with Toivonen's method.

A sample of the documents proposes phrases; the full pass counts these and their
negative border (phrases that are not proposed, though the two phrases that are
one word shorter are) exactly.  A border phrase that turns out frequent is a
failure: it joins the proposed, and a further pass counts what the border gains by
it, until a pass has no failure.  Every frequent phrase is then counted exactly,
whatever the sample was.

Tasks know the proposed phrases by a bit set of bounded size, filled by Spark: a
false hit there only counts a phrase more.  Bits are never taken back, so that what
a pass counts is told apart from what earlier ones did.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.llm.byte_words import Words, byte_classes, words_of
from foldsafe.llm.common import empty_text, mix, written

_U = np.uint64
_STEP, _SEED = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)
# Fixed by the definition: what splits words, and texts into pieces.
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
SAMPLE_PARTS, SAMPLE_COUNT = 16, 2
MAX_BITS = 28
_PAGE = 16
# Occurrences that a task sums before it hands them over; phrases that it remembers to have spelled.
_HELD, _SPELLED = 1 << 21, 1 << 19
# Bytes of texts whose phrases are worked on together.
_TEXT_BYTES = 1 << 21


class Phrases:
    """A set of phrase hashes as bits; never misses a member."""

    def __init__(self, bits: int, pages: dict[int, bytes]):
        self.shift = _U(64 - bits)
        self.set = np.zeros(1 << (bits - 3), np.uint8)
        size = 1 << (min(_PAGE, bits) - 3)
        for page, content in pages.items():
            self.set[page * size: (page + 1) * size] |= np.frombuffer(content, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> self.shift).astype(np.int64)
        return (self.set[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The hashes of phrases with one word more."""
    return mix(hashes * _STEP + words)


def _starts(langs: pa.Array, w: Words) -> np.ndarray:
    """The hash of the empty phrase of each text's language."""
    seeds = langs.slice(w.first, w.rows).to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
    return mix(seeds ^ _SEED)


def _occurrences(w: Words, seeds: np.ndarray, longest: int, proposed: Phrases | None, known: Phrases | None):
    """Length, places and hashes of the phrases that are proposed or in the border (without ``proposed``: of all), by length.

    A last mask says which of them the pass with ``known`` counted.
    """
    n = len(w.hashes)
    at, hashes, was = np.arange(n), longer(seeds[w.row], w.hashes), np.full(n, known is not None)
    for k in range(1, longest + 1):
        yield k, at, hashes, was
        here, before = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        here[at if proposed is None else at[proposed.holds(hashes)]] = True
        if known is not None:
            before[at[was & known.holds(hashes)]] = True
        # a phrase needs the shorter one at its place and the one a word on, with no break between
        last = np.minimum(at + k, n - 1)
        ok = here[at] & here[at + 1] & w.joined[last]
        at, hashes = at[ok], longer(hashes[ok], w.hashes[last[ok]])
        was = before[at] & before[at + 1]


def _batch(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["hash", "n"])


def _counts(docs: DataFrame, longest: int, proposed=None, known=None) -> DataFrame:
    """``hash, n`` of the phrases that a pass counts; without ``proposed``, of all; the first passes count empty phrases, once a word."""
    classes = byte_classes(BLANKS, BREAKS)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for w in words_of(batch.column(1), classes, _TEXT_BYTES):
                seeds = _starts(batch.column(0), w)
                if known is None:
                    values, which = np.unique(seeds, return_inverse=True)
                    yield _batch(values, np.bincount(which, w.lengths(), len(values)))
                for _, _, hashes, was in _occurrences(w, seeds, longest, proposed and proposed.value, known and known.value):
                    parts.append(hashes[~was])
                    held += len(parts[-1])
                if held >= _HELD:
                    yield _batch(*np.unique(np.concatenate(parts), return_counts=True))
                    parts, held = [], 0
        if parts:
            yield _batch(*np.unique(np.concatenate(parts), return_counts=True))

    return docs.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


@dataclass
class _Bits:
    """The bit set of a growing table of hashes."""

    bits: int
    pages: dict[int, bytes]

    @classmethod
    def sized(cls, members: DataFrame) -> "_Bits":
        n = members.agg(F.count(F.lit(1))).first()[0]
        return cls(min(max(math.ceil(math.log2(n + 1)) + 4, 10), MAX_BITS), {})

    def add(self, members: DataFrame) -> "_Bits":
        """With the bits of ``members`` (hash); Spark fills the pages, at most 2 ** MAX_BITS bits reach the driver."""
        bits, page = self.bits, min(_PAGE, self.bits)

        def fill(table: pa.Table) -> pa.Table:
            out = np.zeros(1 << (page - 3), np.uint8)
            at = table.column("bit").to_numpy()
            np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
            return pa.table({"page": table.column("page")[:1].combine_chunks(), "content": pa.array([out.tobytes()], pa.binary())})

        place = F.shiftrightunsigned("hash", 64 - bits)
        d = members.select(F.shiftrightunsigned(place, page).alias("page"), place.bitwiseAND(F.lit((1 << page) - 1)).alias("bit"))
        d = d.distinct().groupBy("page").applyInArrow(fill, "page long, content binary")
        pages = dict(self.pages)
        for row in d.collect():
            new = np.frombuffer(row["content"], np.uint8)
            if row["page"] in pages:
                new = new | np.frombuffer(pages[row["page"]], np.uint8)
            pages[row["page"]] = new.tobytes()
        return _Bits(bits, pages)

    def sent(self, spark):
        return spark.sparkContext.broadcast(Phrases(self.bits, self.pages))


def frequent(docs: DataFrame, min_count: int, longest: int) -> DataFrame:
    """``hash, n`` of every phrase of up to ``longest`` words with ``min_count`` occurrences (and of each language's empty phrase).

    ``docs`` are ``seed, text, part``; those of part 0 are the sample.
    """
    spark, d = docs.sparkSession, docs.select("seed", "text")
    proposed = written(_counts(docs.where("part = 0").select("seed", "text"), longest).where(F.col("n") >= SAMPLE_COUNT).select("hash"), "proposed")
    bits = _Bits.sized(proposed).add(proposed)
    sent, earlier, found = bits.sent(spark), None, None
    while True:
        new = written(_counts(d, longest, sent, earlier).where(F.col("n") >= min_count), "frequent")
        if earlier:
            earlier.destroy()
        # later passes count border phrases only, so that what they find frequent is a failure
        failures = new.select("hash") if earlier else written(new.select("hash").join(proposed, "hash", "left_anti"), "failures")
        found = found.union(new) if earlier else new
        if failures.isEmpty():
            sent.destroy()
            return found
        bits = bits.add(failures)
        earlier, sent = sent, bits.sent(spark)


def _spelled(docs: DataFrame, longest: int, members, wanted) -> DataFrame:
    """``hash, lang, phrase, size, empty, spans`` of phrases of two words and more of ``members`` that are ``wanted``, each once.

    ``empty`` is the hash of the language's empty phrase, ``spans`` are those of the
    phrase's runs of words, by first word, then length.
    """
    classes = byte_classes(BLANKS, BREAKS)
    schema = "hash long, lang string, phrase string, size int, empty long, spans array<long>"

    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        seen = np.empty(0, _U)
        for batch in batches:
            for w in words_of(batch.column(1), classes, _TEXT_BYTES):
                seeds = _starts(batch.column(0), w)
                for k, at, hashes, _ in _occurrences(w, seeds, longest, members.value, None):
                    if k == 1:
                        continue
                    inside = wanted.value.holds(hashes)
                    new, first = np.unique(hashes[inside], return_index=True)
                    places = at[inside][first]
                    unseen = ~np.isin(new, seen, assume_unique=True)
                    new, places = new[unseen], places[unseen]
                    if not len(new):
                        continue
                    seen = np.union1d(seen, new) if len(seen) < _SPELLED else new
                    empty, spans = seeds[w.row[places]], []
                    for i in range(k):
                        x = empty
                        for j in range(i, k):
                            x = longer(x, w.hashes[places + j])
                            spans.append(x)
                    flat = pa.array(np.stack(spans, 1).ravel().view(np.int64))
                    ends = pa.array(np.arange(len(new) + 1, dtype=np.int32) * len(spans))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(new.view(np.int64)), batch.column(2).take(pa.array(w.first + w.row[places])), pa.array(w.phrases(places, k)),
                         pa.array(np.full(len(new), k, np.int32)), pa.array(empty.view(np.int64)), pa.ListArray.from_arrays(ends, flat)], names)

    return docs.mapInArrow(run, schema).dropDuplicates(["hash"])


def _span(size: int, first: int, last: int) -> int:
    """Where the run of words ``first`` to ``last`` stands among the spans of a phrase of ``size`` words (from 1)."""
    return sum(size - a for a in range(first)) + last - first + 1


def _by_size(longest: int, column) -> Column:
    out = F.lit(None)
    for k in range(2, longest + 1):
        out = F.when(F.col("size") == k, column(k)).otherwise(out)
    return out


def collocations(docs: DataFrame, min_count: int = 30, longest: int = 4, per_lang: int = 2000, contained_share: float = 0.8) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``per_lang`` phrases of each language.

    ``a`` counts a phrase of 2 to ``longest`` words within pieces; its weakest cut
    gives ``l`` and ``r`` and the score floor(2000000 a / (l + r)), ties to the first
    cut.  A candidate (``min_count``) whose words lie inside a longer candidate with
    ``contained_share`` of its count is dropped.  ``n`` counts the language's words.
    Null texts are empty, a null lang is ``und``; rows that repeat count each; other
    columns are ignored; no document gives no row.  Phrases are told apart by 64-bit
    hashes.  A word or text of any length is read whole.
    """
    text = empty_text()
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"),
                    F.col("doc_id").cast("long").alias("id"))
    d = d.select("lang", "text", F.xxhash64("lang").alias("seed"),
                 F.pmod(F.xxhash64("id", F.length("text")), F.lit(SAMPLE_PARTS)).alias("part"))
    found = frequent(d, min_count, longest)
    bits = _Bits.sized(found).add(found)
    members = bits.sent(d.sparkSession)
    # most phrases occur in the sample, where few tasks meet each; the others are looked for everywhere
    columns = ["seed", "text", "lang"]
    early = written(_spelled(d.where("part = 0").select(columns), longest, members, members).join(found.select("hash"), "hash"), "spelled")
    left = found.select("hash").join(early, "hash", "left_anti")
    wanted = _Bits.sized(left).add(left).sent(d.sparkSession)
    late = _spelled(d.select(columns), longest, members, wanted).join(written(left, "left"), "hash")
    spelled = written(early.union(late.select(early.columns)).dropDuplicates(["hash"]).join(found.withColumnRenamed("n", "a"), "hash"), "spelled")
    members.destroy()
    wanted.destroy()

    def at(position):
        return F.col("spans")[F.lit(position - 1)]

    def cuts(k):
        return F.array(*[F.struct(F.lit(c).alias("cut"), at(_span(k, 0, c - 1)).alias("lh"), at(_span(k, c, k - 1)).alias("rh")) for c in range(1, k)])

    def inner(k):
        runs = [(i, j) for i in range(k) for j in range(i + 1, k) if j - i + 1 < k]
        return F.array(*[at(_span(k, i, j)) for i, j in runs]) if runs else F.array().cast("array<long>")

    left, right = (found.select(F.col("hash").alias(f"{s}h"), F.col("n").alias(s)) for s in "lr")
    parts = spelled.select("hash", "a", F.explode(_by_size(longest, cuts)).alias("c")).select("hash", "a", "c.*").join(left, "lh").join(right, "rh")
    whole = [F.col(c).cast("decimal(20,0)") for c in "alr"]
    parts = parts.withColumn("whole", whole[0] * F.lit(2_000_000).cast("decimal(7,0)")).withColumn("both", whole[1] + whole[2])
    score = F.expr("whole div both").alias("score")
    weakest = parts.groupBy("hash").agg(F.min(F.struct(score, "cut", "l", "r")).alias("w")).select("hash", "w.score", "w.l", "w.r")
    over = (spelled.select(F.col("a").alias("most"), F.explode(F.array_distinct(_by_size(longest, inner))).alias("hash"))
            .groupBy("hash").agg(F.max("most").alias("most")))
    percent = round(100 * contained_share)
    big = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(3,0)")
    kept = spelled.join(over, "hash", "left").where(F.col("most").isNull() | (big("most", 100) < big("a", percent)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = kept.join(weakest, "hash").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
    return top.join(found.withColumnRenamed("hash", "empty"), "empty").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = 30, longest: int = 4, per_lang: int = 2000, percent: int = 80) -> str:
    """DuckDB SQL: all phrases counted plainly."""
    upper = "".join(map(chr, range(65, 91)))
    return f"""WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS n FROM (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {longest} + 1)) AS k)))
  GROUP BY ALL HAVING count(*) >= {min_count}),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.k, c.phrase, a, l.n AS l, r.n AS r, cut, (2000000::HUGEINT * a) // (l.n::HUGEINT + r.n::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, sub, max(a) AS most FROM (
    SELECT lang, a, array_to_string(w[i : i + m - 1], ' ') AS sub FROM (
      SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, {longest})) AS m) WHERE m < k))
  GROUP BY ALL),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN inside ON inside.lang = weakest.lang AND sub = phrase
  WHERE most IS NULL OR 100 * most::HUGEINT < {percent} * a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= {per_lang}"""
