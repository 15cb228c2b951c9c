"""Whole-text token ids with the tokenizers library, one encoder per Python worker."""

from __future__ import annotations

import json
import os
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ENCODERS: dict[str, "Encoder"] = {}
# Pieces remembered by a worker; the first ones, which are the frequent ones, outlast the rest.
_CACHED, _LASTING, _CACHED_IDS = 350_000, 150_000, 1 << 23
_TOGETHER = 2_000
_GROUP_CHARS = 6_000_000
# The steps before the tokens for which pieces may be encoded apart.
_NORMALIZERS = ["NFC", ("Replace", "\\s+", " "), "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS_END = "\u0250"


def _splits_at_spaces(path: str) -> bool:
    """Whether the tokenizer's own steps are those that encoding by pieces takes for granted."""
    with open(path, encoding="utf-8") as f:
        steps = json.load(f)
    normalizers = [(n["type"], n["pattern"].get("Regex"), n["content"]) if n["type"] == "Replace" else n["type"]
                   for n in (steps["normalizer"] or {}).get("normalizers", [])]
    split, *rest = (steps["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (normalizers == _NORMALIZERS and split.get("type") == "Split" and split["pattern"].get("Regex") == _SPLIT
            and split["behavior"] == "Removed" and split["invert"] and [(r["type"], r["use_regex"]) for r in rest] == [("ByteLevel", False)]
            and steps["model"].get("end_of_word_suffix") == "</w>")


def _is_word(piece: str) -> bool:
    """Only Latin letters, also when normalised: a letter may decompose into one with marks, which joins marks after it."""
    return piece.isalpha() and (piece.isascii() or max(piece) < _LETTERS_END and unicodedata.normalize("NFC", piece).lower().isalpha())


class Encoder:
    """Encodes texts piece by piece, remembering the ids of short pieces.

    For a tokenizer that lower-cases, drops white space and never looks across it,
    and for which a run of letters is a word that ends in a token of its own kind,
    a text's ids are those of its space- and newline-separated pieces in turn, and
    a word with marks after it has the ids of the word, then of the marks.
    ``whole=True``, and any tokenizer whose steps are others, make no such use and
    hand over whole texts.
    """

    def __init__(self, path: str, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.whole, self.marks = Tokenizer.from_file(path), whole or not _splits_at_spaces(path), {}
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.is_end = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.is_end[ends] = True
        # remembered pieces, the end of each one's ids, and all their ids
        self.known, self.end, self.ids = pa.array([""], pa.large_string()), np.zeros(1, np.int64), np.empty(0, "<u4")

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in got]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of runs of letters: encoded together, then cut after each word's last token."""
        out: list[bytes] = []
        for i in range(0, len(words), _TOGETHER):
            part = words[i: i + _TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.is_end[ids]) + 1)).tolist()
            if len(cuts) == len(part):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
            else:  # a letter that does not stay one when lower-cased
                out += self._ids(part)
        return out

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each piece is remembered, or -1."""
        return pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int64)

    def _learn(self, new: list[str]) -> None:
        """Remember the new pieces, in order."""
        words, bases, odd, marked = set(), set(), [], []
        for p in new:
            if _is_word(p):
                words.add(p)
            elif _is_word(base := p.rstrip(string.punctuation)):
                marked.append((p, base, p[len(base):]))
                bases.add(base)
            else:
                odd.append(p)
        bases = list(bases.difference(words))
        places = self._places(pa.array(bases, pa.large_string())).tolist()
        ids = {p: self.ids[self.end[k - 1]: self.end[k]].tobytes() for p, k in zip(bases, places) if k > 0}
        words.update(p for p in bases if p not in ids)
        words = list(words)
        ids.update(zip(words, self._word_ids(words)))
        ids.update(zip(odd, self._ids(odd)))
        marks = [m for m in {m for _, _, m in marked} if m not in self.marks]
        if len(self.marks) > _LASTING:
            self.marks, marks = {}, list({m for _, _, m in marked})
        self.marks.update(zip(marks, self._ids(marks)))
        ids.update([(p, ids[base] + self.marks[m]) for p, base, m in marked])
        got = [ids[p] for p in new]
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        self.known = pa.concat_arrays([self.known, pa.array(new, pa.large_string())])
        self.end = np.concatenate([self.end, len(self.ids) + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(got), "<u4")])

    def _forget(self) -> None:
        if len(self.known) > _CACHED or len(self.ids) > _CACHED_IDS:
            n = _LASTING if self.end[min(_LASTING, len(self.end)) - 1] <= _CACHED_IDS // 2 else 1
            self.known, self.end = pa.array(self.known[:n].to_pylist(), pa.large_string()), self.end[:n].copy()
            self.ids = self.ids[: self.end[-1]].copy()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if self.whole:
            return self._ids(texts)
        if not texts:
            return []
        lists = pc.split_pattern(pa.array([_lowered(t).replace("\n", " ") for t in texts], pa.large_string()), " ")
        cuts = lists.offsets.to_numpy()
        coded = lists.values.dictionary_encode()
        self._forget()
        place = self._places(coded.dictionary)
        absent = np.flatnonzero(place < 0)
        if len(absent):
            place[absent] = len(self.known) + np.arange(len(absent))
            self._learn(coded.dictionary.take(pa.array(absent)).to_pylist())
        which = place[coded.indices.to_numpy()]
        first = np.concatenate([[0], self.end[:-1]])
        length, start = (self.end - first)[which], first[which]
        end = np.cumsum(length)
        flat = self.ids[np.repeat(start - end + length, length) + np.arange(end[-1] if len(end) else 0)]
        bounds = np.concatenate([[0], end])[cuts].tolist()
        return [flat[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encode_batch(self, texts) -> Iterator[bytes]:
        """The ids of each text of an Arrow column, in groups of bounded size."""
        group, size = [], 0
        for t in texts:
            group.append(t.as_py())
            size += len(group[-1])
            if size >= _GROUP_CHARS:
                yield from self.encode(group)
                group, size = [], 0
        if group:
            yield from self.encode(group)


def _lowered(text: str) -> str:
    """Lower-cased where that is sure to be what the tokenizer does anyway: Latin letters only."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        if max(text) >= "ƀ":
            return text
    return text.lower()


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
