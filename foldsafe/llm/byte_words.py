"""Words of UTF-8 texts by byte classes, many texts at once: their hashes, places and breaks.

Delimiters are ASCII characters, so the bytes of an Arrow column are read as they
stand.  A word is the longest run of bytes that are neither blank nor break; A-Z
count as a-z.  Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from foldsafe.llm.common import _TABLES, mix

_U = np.uint64
_CHUNK = 1 << 17
_GROUP = 1 << 23
_UPPER = np.arange(ord("A"), ord("Z") + 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[_UPPER] += 32
_LOWER = _LOWER.tobytes()


@dataclass
class Words:
    """The words of a run of rows of a column, in order."""

    first: int                # the column's row that `row` counts from
    rows: int
    data: np.ndarray          # the texts' bytes
    hashes: np.ndarray
    row: np.ndarray           # text of each word
    start: np.ndarray         # its place in `data`
    end: np.ndarray
    joined: np.ndarray        # the word before is in the same text, with no break between

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes().translate(_LOWER)

    def phrases(self, places: np.ndarray, size: int) -> list[str]:
        """The runs of ``size`` words from each of ``places``, with one space between words."""
        low, size_1 = self.data.tobytes().translate(_LOWER), range(size)
        bounds = zip(*[self.start[places + i].tolist() for i in size_1], *[self.end[places + i].tolist() for i in size_1])
        return [b" ".join([low[b[i]: b[size + i]] for i in size_1]).decode() for b in bounds]

    def lengths(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.row, minlength=self.rows)


def byte_classes(blanks: bytes, breaks: bytes = b"") -> bytes:
    """0 for bytes of words, 1 for blanks, 2 for breaks."""
    return bytes(2 if c in breaks else 1 if c in blanks else 0 for c in range(256))


def _chunks(word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about _CHUNK bytes that end outside words."""
    i, n = 0, len(word)
    while n - i > _CHUNK:
        j = i + _CHUNK
        while j < n and word[j]:
            more = np.flatnonzero(~word[j: j + _CHUNK])
            j = min(j + (int(more[0]) if len(more) else _CHUNK), n)
        yield i, j
        i = j
    yield i, n


def _group(data: np.ndarray, bounds: np.ndarray, first: int, classes: bytes) -> Words:
    kind = np.frombuffer(data.tobytes().translate(classes), np.uint8)
    word = kind == 0
    n, edges = len(data), bounds[(bounds > 0) & (bounds < len(data))]
    before = np.zeros(n, bool)
    before[1:] = word[:-1]
    before[edges] = False
    start = np.flatnonzero(word & ~before)
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    after[edges - 1] = False
    end = np.flatnonzero(word & ~after) + 1
    hashes = np.empty(len(start), _U)
    cut = word.copy()
    cut[edges] = False  # a chunk may end where a text does
    for a, b in _chunks(cut):
        i, j = np.searchsorted(start, (a, b))
        if i == j:
            continue
        power, inverse = _TABLES.powers(b - a + 1)
        total = np.zeros(b - a + 1, _U)
        # bytes as numbers from 1, so that no byte leaves a word's hash as it is
        digits = np.frombuffer(data[a:b].tobytes().translate(_LOWER), np.uint8).astype(_U) + _U(1)
        np.cumsum(digits * power[: b - a], dtype=_U, out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        hashes[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(_U))
    places = np.searchsorted(start, bounds)
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(places))
    joined = np.ones(len(start) + 1, bool)
    joined[places] = False
    joined[np.searchsorted(start, np.flatnonzero(kind == 2))] = False
    joined = joined[:-1]
    return Words(first, len(bounds) - 1, data, hashes, row, start, end, joined)


def words_of(column: pa.Array, classes: bytes, group: int = _GROUP) -> Iterator[Words]:
    """The words of a column of strings without nulls, in groups of whole texts of about ``group`` bytes."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offsets, offsets[i] + group, "right")) - 1
        j = min(max(j, i + 1), len(column))
        bounds = offsets[i: j + 1] - offsets[i]
        yield _group(data[offsets[i]: offsets[j]], bounds, i, classes)
        i = j
