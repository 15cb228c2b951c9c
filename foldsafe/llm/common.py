"""Helpers shared by the operators: written intermediates, word hashes, connected components."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldsafe.session import scratch_path

_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table under the shared checkpoint folder: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_text(col: str = "text"):
    """The text column with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Tables:
    """Per-worker tables: which code points belong to words, and powers of the hash base."""

    def __init__(self):
        self.word = None
        self.pow = self.inv = np.ones(1, _U)

    def is_word(self) -> np.ndarray:
        if self.word is None:
            self.word = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
        return self.word

    def powers(self, n: int):
        if len(self.pow) < n:
            n = max(n, 1 << 16)
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("pow", _BASE), ("inv", inverse)):
                t = np.full(n, base, _U)
                t[0] = 1
                setattr(self, name, np.multiply.accumulate(t))
        return self.pow, self.inv


_TABLES = _Tables()


def _pieces(text: str):
    """Cut a long text between words, so that memory stays bounded."""
    i = 0
    while len(text) - i > _PIECE:
        j = i + _PIECE
        while j < len(text) and text[j].isalnum():
            j += 1
        yield text[i:j]
        i = j
    yield text[i:] if i else text


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (maximal run of letters and digits) of the lower-cased text."""
    out = []
    for piece in _pieces(text.lower()):
        a = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(a):
            continue
        edge = np.diff(_TABLES.is_word()[a].view(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _TABLES.powers(len(a) + 1)
        total = np.zeros(len(a) + 1, _U)
        np.cumsum(a * power[: len(a)], dtype=_U, out=total[1:])
        out.append(mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U)))
    return np.concatenate(out) if out else np.empty(0, _U)


def shingle_hashes(text: str, k: int = 5) -> np.ndarray:
    """Hashes of the runs of ``k`` words, in order; a text of 1 to k-1 words is one shingle, an empty one none."""
    w = word_hashes(text)
    n = len(w)
    if not n:
        return w
    size, out = min(k, n), np.zeros(max(n - k + 1, 1), _U)
    for i in range(size):
        out = out * _U(0xD6E8FEB86659FD93) + w[i: i + len(out)]
    return mix(out + _U(size))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``(a, b)`` edges as ``(node, component)``, the component being its least node.

    Alternating large-star and small-star steps, each a grouped minimum (partial
    aggregation) joined back, so a hub is never gathered; each round is a written
    table.  Rounds end when the edge set no longer changes.
    """
    e = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .where("a < b").distinct(), name)
    seen = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        e = written(large.join(low, "b")
                    .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")),
                                              F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
                    .select("e.*").where("a < b").distinct(), name)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            return e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).union(
                e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        seen = now


def row_total(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
