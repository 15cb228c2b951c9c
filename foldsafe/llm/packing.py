"""Packing token sequences by minimum bin slack.

Whole windows of ``capacity`` ids are cut off each document; what remains goes to
a pool of the task.  A window starts from the longest piece of the pool, then a
dynamic program over a bitset of reachable sums picks the multiset of remaining
lengths that fills it closest to capacity, walked back through the stages to get
the count of each length.  What slack is left is cut from a longer piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldsafe.llm.common import empty_text
from foldsafe.llm.tokens import encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (at most ``counts`` of each) whose sum is largest without passing ``capacity``.

    Bit s of the bitset says that sum s can be reached; every stage adds one more
    piece, and the bitset before it is kept to walk back.
    """
    reached, stages, mask = 1, [], (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        for _ in range(min(counts[length], capacity // length)):
            grown = (reached | reached << length) & mask
            if grown == reached:
                break
            stages.append((length, reached))
            reached = grown
        if reached >> capacity & 1:
            break
    rest, taken = reached.bit_length() - 1, {}
    for length, before in reversed(stages):
        if not before >> rest & 1:
            taken[length] = taken.get(length, 0) + 1
            rest -= length
    return taken


class Pool:
    """Remaining pieces (document, start, ids, document's tokens) by length, and the windows made of them."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next, self.by, self.size, self.ids = capacity, first_sequence, {}, 0, 0

    def add(self, piece: tuple) -> None:
        self.by.setdefault(len(piece[2]) // 4, []).append(piece)
        self.size += 1
        self.ids += len(piece[2]) // 4

    def pop(self, length: int) -> tuple:
        got = self.by[length].pop()
        if not self.by[length]:
            del self.by[length]
        self.size -= 1
        self.ids -= length
        return got

    def emit(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for doc, start, ids, total in pieces:
            out.append((doc, start, len(ids) // 4, ids, total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1
        return out

    def window(self) -> list[tuple]:
        """The next sequences, all with the same multiset of lengths."""
        seed = max(self.by)
        counts = {n: len(x) - (n == seed) for n, x in self.by.items()}
        taken = closest_fill({n: c for n, c in counts.items() if c}, self.capacity - seed)
        used = taken | {seed: taken.get(seed, 0) + 1}
        slack = self.capacity - sum(n * c for n, c in used.items())
        out = []
        for _ in range(1 if slack else min(len(self.by[n]) // c for n, c in used.items())):
            pieces = [self.pop(n) for n, c in used.items() for _ in range(c)]
            longer = [n for n in self.by if n > slack] if slack else []
            if longer:
                doc, start, ids, total = self.pop(min(longer))
                pieces.append((doc, start, ids[: 4 * slack], total))
                self.add((doc, start + slack, ids[4 * slack:], total))
            out += self.emit(pieces)
        return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, pool: int = 4096) -> DataFrame:
    """Pack every whole ``text`` (null: empty) with ``end_id`` into sequences of at most ``capacity`` ids.

    One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.  There is no shuffle: each input split packs
    its own documents with a pool of about ``pool`` pieces (more only while they
    would not fill two windows), so only the last
    window of a split can be short.  Repeated rows are packed each; a null doc_id
    stays null; an empty text is its end id alone; other columns are ignored.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext
        held, out, size = Pool(capacity, TaskContext.get().partitionId() << 33), [], 0

        def batch_of(rows):
            cols = list(zip(*rows))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], _NAMES)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode_batch(batch.column(1))):
                ids += tail
                total = len(ids) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    out += held.emit([(doc, start, ids[4 * start: 4 * (start + capacity)], total)])
                    size += capacity
                    if size > 1 << 20:
                        yield batch_of(out)
                        out, size = [], 0
                if whole < total:
                    held.add((doc, whole, ids[4 * whole:], total))
                while held.size >= pool and held.ids >= 2 * capacity:
                    new = held.window()
                    out += new
                    size += sum(r[2] for r in new)
                if size > 1 << 20:
                    yield batch_of(out)
                    out, size = [], 0
        while held.size:
            out += held.window()
        if out:
            yield batch_of(out)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"))
    return d.mapInArrow(run, SCHEMA)
