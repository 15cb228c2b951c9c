"""Token-id files in Simple-8b word-aligned coding.

A file is a sequence of frames; a frame holds whole documents and is a run of
little-endian 64-bit words::

    magic, n_docs, n_ids, n_blocks, n_words, n_escapes
    doc_id[n_docs], has_id[n_docs], n_tokens[n_docs]
    word_offset[n_blocks + 1]          first word of each block of BLOCK ids
    word[n_words]                      4-bit selector, then 60 bits of payload
    escape[n_escapes]                  values over 60 bits; their words hold an index

followed by the eight bytes of END.  The selector says how many values of how
many bits fill the payload; the last word of a block may run past its end.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldsafe.llm.common import empty_text, written
from foldsafe.llm.tokens import encoder
from foldsafe.session import scratch_path

# Fixed values of the format: values per word and their bits, by selector 1 to 14; selector 0 marks an escape.
PACKINGS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
            (2, 30), (1, 60))
BLOCK = 1024
MAGIC = int.from_bytes(b"S8BFRAME", "little")
END = "S8B-END\n"
FRAME_IDS = 1 << 18
FRAMES_A_FILE = 32

_U = np.uint64


_SHORT_WIDTHS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, as bytes."""
    if len(values) and values.max() < 1 << 16:
        return _SHORT_WIDTHS[values.astype(np.uint16)]
    out = np.zeros(len(values), np.uint8)
    rest = values.astype(_U)
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >= _U(1) << _U(step)
        if high.any():
            out[high] += step
            rest = np.where(high, rest >> _U(step), rest)
    return out + (rest > 0).astype(np.uint8)


def encode_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block (one more at the end) and escapes of unsigned 64-bit values.

    All blocks advance together: at each step every block's next word takes the
    largest count of values that fits it.
    """
    n, blocks = len(values), -(-len(values) // BLOCK)
    if not n:
        return np.empty(0, _U), np.zeros(1, np.int64), np.empty(0, _U)
    reach = PACKINGS[0][0]
    grid = np.zeros((blocks, BLOCK + reach), _U)
    width = np.zeros((blocks, BLOCK + reach), np.uint8)
    for wide, flat in ((grid, values), (width, _widths(values))):
        full = n // BLOCK
        wide[:full, :BLOCK] = flat[: full * BLOCK].reshape(full, BLOCK)
        wide[full:, : n - full * BLOCK] = flat[full * BLOCK:]
    selector = np.zeros((blocks, BLOCK), np.uint8)
    widest, have = width, 1
    for s in range(len(PACKINGS), 0, -1):
        count, bits = PACKINGS[s - 1]
        while have < count:  # the widest of each run of `have` values
            step = min(have, count - have)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            have += step
        np.copyto(selector, s, where=widest[:, :BLOCK] <= bits)
    take = np.array([1] + [c for c, _ in PACKINGS], np.int64)
    length = np.full(blocks, BLOCK)
    length[-1] = n - BLOCK * (blocks - 1)
    at, line, steps = np.zeros(blocks, np.int64), np.arange(blocks), []
    while (live := at < length).any():
        steps.append(np.where(live, at, -1))
        at = np.where(live, at + take[selector[line, np.minimum(at, BLOCK - 1)]], at)
    visited = np.stack(steps, 1)
    used = visited >= 0
    offsets = np.concatenate([[0], np.cumsum(used.sum(1))])
    place = (np.repeat(line, used.sum(1)), visited[used])
    chosen, words = selector[place], np.zeros(len(place[0]), _U)
    for s, (count, bits) in enumerate(PACKINGS, 1):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            start = place[0][mine] * grid.shape[1] + place[1][mine]
            word = np.full(len(mine), s << 60, _U)
            for i in range(count):
                word |= grid.ravel()[start + i] << _U(i * bits)
            words[mine] = word
    odd = np.flatnonzero(chosen == 0)
    words[odd] = np.arange(len(odd), dtype=_U)
    return words, offsets, grid[place[0][odd], place[1][odd]]


def decode_values(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of :func:`encode_values`, all words of a selector at once."""
    out = np.zeros(n + PACKINGS[0][0], _U)
    chosen = (words >> _U(60)).astype(np.int64)
    counts = np.array([1] + [c for c, _ in PACKINGS], np.int64)[chosen]
    before = np.cumsum(counts) - counts
    blocks = len(offsets) - 1
    block = np.repeat(np.arange(blocks), np.diff(offsets))
    start = before - before[offsets[:-1]][block] + block * BLOCK if blocks else before
    end = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(chosen):
        mine = chosen == s
        if s == 0:
            out[start[mine]] = escapes[words[mine].astype(np.int64)]
            continue
        count, bits = PACKINGS[s - 1]
        got = (words[mine][:, None] >> (np.arange(count) * bits).astype(_U)) & _U((1 << bits) - 1)
        to = start[mine][:, None] + np.arange(count)
        kept = to < end[mine][:, None]
        out[to[kept]] = got[kept]
    return out[:n]


def frame(doc_ids: list, parts: list[bytes]) -> bytes:
    """One frame of whole documents, their ids given as little-endian unsigned 32-bit integers."""
    values = np.frombuffer(b"".join(parts), "<u4").astype(_U)
    words, offsets, escapes = encode_values(values)
    head = np.array([MAGIC, len(parts), len(values), len(offsets) - 1, len(words), len(escapes)], _U)
    docs = np.array([0 if i is None else i for i in doc_ids], np.int64).view(_U)
    has = np.array([i is not None for i in doc_ids], _U)
    sizes = np.array([len(p) // 4 for p in parts], _U)
    return np.concatenate([head, docs, has, sizes, offsets.astype(_U), words, escapes]).astype("<u8").tobytes()


def frames(content: bytes) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Document ids, token counts and all values of each frame of a file."""
    data, at, end = np.frombuffer(content, "<u8"), 0, int.from_bytes(END.encode(), "little")
    while at < len(data):
        magic, n_docs, n_ids, n_blocks, n_words, n_escapes = (int(x) for x in data[at: at + 6])
        if magic != MAGIC:
            raise ValueError(f"not a token file: no frame at word {at}")
        cuts = np.cumsum([at + 6, n_docs, n_docs, n_docs, n_blocks + 1, n_words, n_escapes])
        docs, has, sizes, offsets, words, escapes = (data[a:b] for a, b in zip(cuts, cuts[1:]))
        if data[cuts[-1]] != end:
            raise ValueError(f"token file cut off at word {cuts[-1]}")
        ids = [int(i) if h else None for i, h in zip(docs.view("<i8"), has)]
        yield ids, sizes.astype(np.int64), decode_values(words, offsets.astype(np.int64), escapes, n_ids)
        at = int(cuts[-1]) + 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, files: int | None = None) -> None:
    """Encode every whole ``text`` (null: empty), append ``end_id`` and write token files in ascending ``doc_id`` order.

    One range shuffle of (doc_id, text) orders the documents; each task then
    tokenises its range in turn and hands over frames of whole documents, which
    Spark's writer puts into files of at most FRAMES_A_FILE frames, wherever
    Spark can write.  Repeated rows are kept, ordered by a hash of the text; a null doc_id comes
    first.  Columns other than doc_id and text are ignored.  An empty table gives
    no documents.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"))
    n = files or max(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # ranges by id and text hash: their bounds go through the driver, so no text may be in them
    d = d.withColumn("version", F.xxhash64("text"))
    ordered = d.repartitionByRange(n, "doc_id", "version").sortWithinPartitions("doc_id", "version", "text").drop("version")
    tail = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        ids, parts, held = [], [], 0
        for batch in batches:
            for doc, got in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode_batch(batch.column(1))):
                got += tail
                ids.append(doc)
                parts.append(got)
                held += len(got) // 4
                if held >= FRAME_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array([frame(ids, parts)], pa.binary())], ["frame"])
                    ids, parts, held = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([frame(ids, parts)], pa.binary())], ["frame"])

    write_frames(ordered.mapInArrow(encode, "frame binary"), path)


def write_frames(found: DataFrame, path: str, frames_a_file: int = FRAMES_A_FILE) -> None:
    """Token files of a column ``frame``, in the order of its partitions and rows."""
    (found.select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", END).option("maxRecordsPerFile", frames_a_file).text(path))


def read_tokens(spark, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of token files: file, place (order in the file), doc_id, n_tokens, ids_crc32 (and ids, binary)."""
    schema = "file string, place long, doc_id long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def decode(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                place = 0
                for ids, sizes, values in frames(content.as_py()):
                    raw = memoryview(values.astype("<u4").tobytes())
                    ends = np.cumsum(sizes) * 4
                    spans = [raw[e - 4 * s: e] for s, e in zip(sizes.tolist(), ends.tolist())]
                    cols = [pa.array([name] * len(ids)), pa.array(range(place, place + len(ids)), pa.int64()),
                            pa.array(ids, pa.int64()), pa.array(sizes), pa.array([zlib.crc32(x) for x in spans], pa.int64())]
                    if with_ids:
                        cols.append(pa.array([bytes(x) for x in spans], pa.binary()))
                    place += len(ids)
                    yield pa.RecordBatch.from_arrays(cols, schema=None, names=[f.split()[0] for f in schema.split(", ")])

    found = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return found.mapInArrow(decode, schema)


def token_index(spark, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A running sum of three levels: within a file, over a task's files in the order
    of their numbers, and over one total per task; names give task and number as
    Spark's writer has them (``part-<task>-...-c<number>``), of any number of digits.
    """
    from pyspark.sql import Window
    d = written(read_tokens(spark, path), "token-index")
    name = F.element_at(F.split("file", "/"), -1)
    part, number = (F.regexp_extract(name, pattern, 1).cast("long") for pattern in (r"^part-(\d+)-", r"-c(\d+)(?:\.|$)"))

    def earlier(keys: list, order: str):
        w = Window.partitionBy(*keys) if keys else Window
        return F.coalesce(F.sum("n").over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    files = d.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("part", part).withColumn("number", number)
    tasks = files.groupBy("part").agg(F.sum("n").alias("n"))
    tasks = tasks.select("part", earlier([], "part").alias("tasks"))
    before = files.withColumn("files", earlier(["part"], "number")).join(tasks, "part").select("file", (F.col("tasks") + F.col("files")).alias("before"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (d.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(before, "file")
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def token_file_path(spark) -> str:
    return scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
