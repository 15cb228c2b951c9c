"""Late rows of a stream: kept apart, counted exactly, the same after a restart or a batch run again."""

import glob
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from foldsafe.session import scratch_path
from foldsafe.streaming import monitor as MON

SCHEMA = "id long, k string, ts timestamp"
HOUR = 3600


def feed(spark, path, rows):
    d = spark.createDataFrame([(i, k, s) for i, k, s in rows], "id long, k string, s long")
    d.select("id", "k", F.timestamp_seconds("s").alias("ts")).write.mode("append").parquet(path)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_rows_after_the_watermark_are_kept_apart(spark, tmp_path, scheme):
    path, run = f"{scheme}{tmp_path}/feed", uuid.uuid4().hex

    def go():
        on_time, late = MON.split_late(spark.readStream.schema(SCHEMA).parquet(path), "ts", HOUR, HOUR, run)
        return sorted(r["id"] for r in on_time.collect()), sorted(r["id"] for r in late.collect())

    feed(spark, path, [])
    assert go() == ([], [])
    feed(spark, path, [(1, "a", 10), (2, "a", 5 * HOUR), (3, None, None)])       # the first batch knows no watermark
    assert go() == ([1, 2], [3])
    # seen 5 h, watermark 4 h: the window that ends at 4 h is closed, the next is open
    feed(spark, path, [(4, "a", 4 * HOUR - 1), (5, "a", 4 * HOUR), (6, "b", 9 * HOUR), (7, "b", 20)])
    assert go() == ([1, 2, 5, 6], [3, 4, 7]) and go() == ([1, 2, 5, 6], [3, 4, 7])   # started again without news
    feed(spark, path, [(8, "a", 8 * HOUR - 1), (9, "a", 8 * HOUR)])
    assert go() == ([1, 2, 5, 6, 9], [3, 4, 7, 8])
    # the last batch is run again, as after a driver lost before its commit
    last = max(glob.glob(f"{scratch_path(spark, 'stream-ckpt')}/late-{run}/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))
    folder, number = last.rsplit("/", 1)
    shutil.move(last, f"{tmp_path}/commit")
    for crc in glob.glob(f"{folder}/.{number}.crc"):
        shutil.move(crc, f"{tmp_path}/crc")
    assert go() == ([1, 2, 5, 6, 9], [3, 4, 7, 8])
    on_time, late = MON.split_late(spark.readStream.schema(SCHEMA).parquet(path), "ts", HOUR, HOUR, run)
    counts = {(r["window_start"] and r["window_start"].timestamp(), r["k"]): (r["n"], r["n_late"]) for r in MON.late_counts(on_time, late, ["k"]).collect()}
    assert sum(a + b for a, b in counts.values()) == 9 and counts[None, None] == (0, 1) and counts[0, "b"] == (0, 1)
