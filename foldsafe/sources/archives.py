"""Archive members and labelled file trees (A4, A5).

An archive is opened inside one task (``binaryFile`` + ``mapInArrow``), read as
a stream and yields one row per member; many archives are many tasks, and
archives written here hold at most about ``ARCHIVE_BYTES`` of texts, so a task's
memory doesn't follow the table.  A directory tree is read with
``recursiveFileLookup`` and the label is parsed from the path; written trees are
dealt over ``TREE_SHARDS`` folders, so that tasks don't wait for one folder.
"""

from __future__ import annotations

import io
import os
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

MEMBER_SCHEMA = "archive string, member string, size bigint, text string"
# Bytes of texts in an archive that is written, and of members that a reader hands on together.
ARCHIVE_BYTES, BATCH_BYTES = 64 << 20, 4 << 20
TREE_SHARDS = 32


def local_path(path: str) -> str:
    """The path of a shared folder for ``open`` and ``os``, which know no ``file:`` URI."""
    parts = urlsplit(path)
    return parts.path if parts.scheme == "file" else path


def _archive(path: str, content: pa.Buffer) -> Iterator[tuple]:
    with tarfile.open(fileobj=pa.BufferReader(content), mode="r|*") as tar:
        for m in tar:
            if m.isfile():
                data = tar.extractfile(m).read()
                yield path, m.name, len(data), data.decode("utf-8", errors="replace")
            tar.members = []  # a stream needs no list of what was read


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        types = (pa.string(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)],
                                          ["archive", "member", "size", "text"])

    for b in batches:
        rows, held = [], 0
        for path, content in zip(b.column(0), b.column(1)):
            for row in _archive(path.as_py(), content.as_buffer()):
                rows.append(row)
                held += row[2]
                if held >= BATCH_BYTES or len(rows) >= 10_000:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)


def read_archive_members(spark: SparkSession, pattern: str) -> DataFrame:
    """A4: one row per regular-file member of every .tar/.tar.gz/.tar.bz2."""
    raw = spark.read.format("binaryFile").load(pattern)
    return raw.select("path", "content").mapInArrow(_members, MEMBER_SCHEMA)


def write_archives(docs: DataFrame, id_col: str, text_col: str, out_dir: str, n_archives: int, most: int = ARCHIVE_BYTES) -> None:
    """Pack documents into ``n_archives`` tar.gz files (one per task), or more
    where these would hold over about ``most`` bytes of texts."""
    out_dir = local_path(out_dir)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, t) for b in batches for i, t in zip(b.column(0), b.column(1)))
        n, row = 0, next(rows, None)
        while row is not None:
            name, held = f"part-{uuid.uuid4().hex}.tar.gz", 0
            part = os.path.join(out_dir, f".{name}.tmp")
            with tarfile.open(part, mode="w:gz") as tar:
                while row is not None and held < most:
                    i, data = row[0].as_py(), row[1].as_py().encode("utf-8")
                    info = tarfile.TarInfo(name=f"docs/{i}.txt")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
                    tar.members = []
                    held, n, row = held + len(data), n + 1, next(rows, None)
            os.replace(part, os.path.join(out_dir, name))  # whole archives only
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    os.makedirs(out_dir, exist_ok=True)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    docs.select(id_col, text_col).repartition(max(n_archives, -(-size // most)), id_col).mapInArrow(pack, "n bigint").collect()


def write_labelled_tree(docs: DataFrame, id_col: str, text_col: str, label_col: str, out_dir: str) -> None:
    """One file per document under ``<shard>/<label>/``, plus a ``cmds`` file per
    folder that readers must skip."""
    out_dir = local_path(out_dir)

    def dump(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, made = 0, set()
        for b in batches:
            for i, t, lab in zip(*(c.to_pylist() for c in b.columns)):
                shard = zlib.crc32(str(i).encode()) % TREE_SHARDS
                d = os.path.join(out_dir, f"{shard:02d}", str(lab))
                if d not in made:
                    made.add(d)
                    os.makedirs(d, exist_ok=True)
                    with open(os.path.join(d, "cmds"), "w") as f:
                        f.write("index\n")
                with open(os.path.join(d, f"{i}.eml"), "w", encoding="utf-8") as f:
                    f.write(t)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    os.makedirs(out_dir, exist_ok=True)
    docs.select(id_col, text_col, label_col).mapInArrow(dump, "n bigint").collect()


def read_labelled_tree(spark: SparkSession, root: str, label_map: dict[str, int] | None = None) -> DataFrame:
    """A5: every file below ``root`` except ``cmds``; label = its folder name."""
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
           .select("path", "length", "content"))
    raw = raw.where(~F.col("path").endswith("/cmds"))
    folder = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    name = F.regexp_extract("path", r"/([^/]+)$", 1)
    lab = folder.cast("int") if label_map is None else F.create_map(*[x for k, v in label_map.items() for x in (F.lit(k), F.lit(v))])[folder]
    return raw.select("path", name.alias("name"), lab.alias("label"), F.col("length").alias("size"),
                      F.decode("content", "UTF-8").alias("text"))
