"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by their number of shingles into classes of powers of two.
For a class of items of up to S shingles a document is read as windows of 2S
shingles that start every S, so an item lies in one window, and a containment
threshold turns into a Jaccard threshold that is tight for the class.  From that
the class gets its number of MinHash functions, each a band of its own, so that
an item at the threshold is missed with probability MISS at most.  Candidates are
verified by exact containment of the item's shingles in the whole document.

A window whose minimum equals an item's minimum holds that shingle of the item:
windows without any shingle of an item need no signature, which loses nothing.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldsafe.llm.common import empty_text, mix, shingle_hashes, written

MISS = 1e-6
# Items whose shingles sum to about this many are searched in one pass over the documents.
PASS_SHINGLES = 200_000
_BITS = 22


def size_class(n: int) -> int:
    """The class of an item of ``n`` shingles: its largest size is 2 to that power."""
    return max(n - 1, 0).bit_length()


def functions_needed(smallest: int, window: int, threshold: float, miss: float = MISS) -> int:
    """MinHash functions that find an item of ``smallest`` shingles in a window, at the containment threshold."""
    shared = threshold * smallest
    jaccard = shared / (window + smallest - shared)
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(jaccard, 0.999999))))


class Search:
    """Signatures of a bounded set of items, by size class, and the search of one document."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: float):
        self.threshold, self.items, self.classes = threshold, {}, {}
        for item, shingles in items:
            own = np.unique(shingles)
            if len(own):
                self.items[item] = own
                self.classes.setdefault(size_class(len(shingles)), []).append(item)
        known = np.unique(np.concatenate(list(self.items.values()))) if self.items else np.empty(0, np.uint64)
        self.known, self.maybe = known, np.zeros(1 << _BITS, bool)
        self.maybe[(known >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.tables = {}
        for c, members in self.classes.items():
            count = functions_needed(min(len(self.items[i]) for i in members), 2 << c, threshold)
            # the function of a band: a bijection of the shingle hashes, of which the least is kept
            seeds = mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(c)) | np.uint64(1)
            table: dict[tuple[int, int], list[int]] = {}
            for item in members:
                for band, low in enumerate(self._minima(self.items[item], seeds)):
                    table.setdefault((band, low), []).append(item)
            self.tables[c] = (seeds, table)

    @staticmethod
    def _minima(shingles: np.ndarray, seeds: np.ndarray) -> list[int]:
        return mix(shingles[None, :] * seeds[:, None]).min(1).tolist()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """Item, its shingles and how many of them the text holds, for each item at the threshold or over."""
        if not self.items:
            return []
        shingles = shingle_hashes(text)
        hits = np.flatnonzero(self.maybe[(shingles >> np.uint64(64 - _BITS)).astype(np.int64)])
        if len(hits):
            at = np.minimum(np.searchsorted(self.known, shingles[hits]), len(self.known) - 1)
            hits = hits[self.known[at] == shingles[hits]]
        if not len(hits):
            return []
        found: set[int] = set()
        for c, (seeds, table) in self.tables.items():
            block = hits >> c
            for window in np.unique(np.concatenate([block, np.maximum(block - 1, 0)])).tolist():
                part = np.unique(shingles[window << c: (window + 2) << c])
                for key in enumerate(self._minima(part, seeds)):
                    found.update(table.get(key, ()))
        held = np.unique(shingles[hits])
        out = []
        for item in sorted(found):
            own = self.items[item]
            shared = int(np.isin(own, held, assume_unique=True).sum())
            if shared >= self.threshold * len(own) - 1e-9:
                out.append((item, len(own), shared))
        return out


_SEARCHES: dict[str, Search] = {}


def _search(name: str, items: list[tuple[int, bytes]], threshold: float) -> Search:
    """The search of a pass, made once per Python worker."""
    if name not in _SEARCHES:
        _SEARCHES.clear()
        _SEARCHES[name] = Search([(i, np.frombuffer(s, np.uint64)) for i, s in items], threshold)
    return _SEARCHES[name]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared``: every document that holds at least ``threshold`` of an item's shingles.

    Shingles are five words; an item of fewer words is one shingle of them all,
    which only a text of just those words holds; null and empty texts hold and are
    none.  Rows that repeat a doc_id or item_id give one row per pair (the largest
    overlap); items with a null id and documents with a null id take no part; other
    columns are ignored.  The items are dealt into passes of bounded size, each one
    scan of the documents with that part broadcast; there is no shuffle of documents.
    """
    spark = docs.sparkSession

    def shingled(batches):
        for b in batches:
            got = [shingle_hashes(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in got], pa.int64()),
                                              pa.array([s.tobytes() for s in got], pa.binary())], ["item_id", "n", "shingles"])

    named = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), empty_text().alias("text"))
    items = written(named.distinct().mapInArrow(shingled, "item_id long, n long, shingles binary"), "items")
    total = items.agg(F.sum("n")).first()[0] or 0
    passes = max(1, -(-total // PASS_SHINGLES))
    d = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"))
    out = None
    for p in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).select("item_id", "shingles")
        held = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in part.collect()])

        def run(batches, held=held, name=uuid.uuid4().hex):
            search = _search(name, held.value, threshold)
            for b in batches:
                rows = [(doc, *x) for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for x in search.find(text)]
                cols = list(zip(*rows)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "n_shingles", "n_shared"])

        found = d.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_shared long")
        out = found if out is None else out.union(found)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))


def oracle(threshold: float = 0.8) -> str:
    """DuckDB SQL: exact containment of every item in every document."""
    def shingles(name: str, key: str) -> str:
        return f"""{name}_w AS (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {name} WHERE {key} IS NOT NULL),
{name}_s AS (SELECT DISTINCT {key}, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM {name}_w WHERE len(w) > 0))"""
    return f"""WITH {shingles('documents', 'doc_id')}, {shingles('benchmark', 'item_id')},
n AS (SELECT item_id, count(*) AS n_shingles FROM benchmark_s GROUP BY 1)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared
FROM documents_s JOIN benchmark_s USING (s) JOIN n USING (item_id)
GROUP BY ALL HAVING count(*) >= {threshold} * n_shingles - 1e-9"""
