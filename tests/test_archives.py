"""Archives of bounded size, read as streams; trees of several folders, each marked once."""

import glob
import os
import tarfile

from pyspark.sql import functions as F

from foldsafe.sources import archives as AR


def test_archives_stay_small_and_lose_no_member(spark, tmp_path):
    docs = spark.createDataFrame([(i, ("é" + "x" * (i % 50)) * 10) for i in range(300)] + [(7, "again")], "doc_id long, text string")
    AR.write_archives(docs, "doc_id", "text", f"file://{tmp_path}/a", n_archives=2, most=5_000)
    files = glob.glob(f"{tmp_path}/a/*.tar.gz")
    sizes = []
    for f in files:
        with tarfile.open(f) as tar:
            sizes.append(sum(m.size for m in tar.getmembers()))
    assert len(files) > 10 and max(sizes) < 6_000 and len(os.listdir(tmp_path / "a")) == len(files)
    got = AR.read_archive_members(spark, f"{tmp_path}/a/*.tar.gz").select("member", "size", "text").collect()
    want = [(f"docs/{r['doc_id']}.txt", len(r["text"].encode()), r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got)) == sorted(want)


def test_one_hot_id_is_many_archives(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x" * 100)] * 200, "doc_id long, text string")
    AR.write_archives(docs, "doc_id", "text", f"{tmp_path}/a", n_archives=1, most=1_000)
    assert len(glob.glob(f"{tmp_path}/a/*.tar.gz")) >= 18
    assert AR.read_archive_members(spark, f"{tmp_path}/a/*.tar.gz").count() == 200


def test_members_come_in_bounded_batches(tmp_path):
    import io

    import pyarrow as pa
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:bz2") as tar:
        tar.addfile(_folder("dir"))
        for i in range(40):
            data = b"z" * (1 << 20)
            info = tarfile.TarInfo(f"{i}.txt")
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    raw = pa.RecordBatch.from_arrays([pa.array(["p"]), pa.array([buf.getvalue()], pa.binary())], ["path", "content"])
    out = list(AR._members(iter([raw])))
    assert sum(b.num_rows for b in out) == 40 and max(b.nbytes for b in out) < 6 << 20


def _folder(name):
    info = tarfile.TarInfo(name)
    info.type = tarfile.DIRTYPE
    return info


def test_tree_folders_are_many_and_marked_once(spark, tmp_path):
    rows = [(i, f"mail {i}", i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").coalesce(1)
    AR.write_labelled_tree(docs, "doc_id", "text", "label", f"file://{tmp_path}/t")
    folders = glob.glob(f"{tmp_path}/t/*/*/cmds")
    assert len(glob.glob(f"{tmp_path}/t/*")) > 16 and len(folders) <= 2 * AR.TREE_SHARDS
    t = AR.read_labelled_tree(spark, f"{tmp_path}/t")
    got = t.select(F.regexp_extract("name", r"^(\d+)", 1).cast("long"), "text", "label").collect()
    assert sorted(map(tuple, got)) == sorted(rows)
