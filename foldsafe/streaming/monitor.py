"""Scoring and monitoring of arriving rows (O1-O3).

Sources are file streams; every query checkpoints its offsets and state
under the shared ``spark.checkpoint.dir`` so a restarted driver or a lost
executor resumes exactly where it stopped.  Windowed aggregates run in
``update`` mode with a watermark (state older than the watermark is
dropped), and ``foreachBatch`` writes each micro-batch's updated rows tagged
with the batch id: a replayed batch rewrites only its own folder, and the
final value of a window is its row from the latest batch.

Rows that come after the watermark are not lost: :func:`split_late` keeps them in a
table of their own, so that rows on time and late rows are together all rows.

Fitted constants (per-type baselines, the training histogram) are static
tables bounded by the number of types / bins, joined stream-static.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from foldsafe.operators.broadcast import bounded
from foldsafe.session import scratch_path

PSI_EPS = 1e-4


def stream_files(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def _run(query_df: DataFrame, name: str, mode: str, by_batch: bool, run_id: str | None = None) -> str:
    """Run a streaming query to completion (availableNow) and return the
    folder its batches were written to.  Reusing ``run_id`` resumes from the
    same checkpoint: only data not yet committed is processed."""
    spark = query_df.sparkSession
    run = f"{name}-{run_id or uuid.uuid4().hex[:10]}"
    out, ckpt = scratch_path(spark, f"stream-out/{run}"), scratch_path(spark, f"stream-ckpt/{run}")

    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("batch_id", F.lit(batch_id)) if by_batch else batch
        b.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    q = (query_df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def latest_per_key(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The final row of every key: the one from the latest micro-batch."""
    d = spark.read.parquet(out)
    w = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return d.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "batch_id", "batch")


def stream_score(stream: DataFrame, baseline: DataFrame, key: str, name: str = "score",
                 run_id: str | None = None) -> DataFrame:
    """O1: score arriving rows with a fitted model given as a small constants
    table (joined stream-static, broadcast: bounded by the key count)."""
    scored = stream.join(bounded(baseline), key, "left")
    out = _run(scored, name, "append", by_batch=False, run_id=run_id)
    return stream.sparkSession.read.parquet(out).drop("batch")


def stream_metrics(stream: DataFrame, baseline: DataFrame, key: str, ts: str, real: str, pred: str,
                   window: str = "1 day", delay: str = "1 day", name: str = "metrics",
                   run_id: str | None = None) -> DataFrame:
    """O2: RMSE, bias and error rate per event-time window and key."""
    s = stream.join(bounded(baseline), key, "left").withColumn("__t", F.col(ts).cast("timestamp"))
    e = F.col(pred) - F.col(real)
    agg = (s.withWatermark("__t", delay).groupBy(F.window("__t", window).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum(e).alias("se"),
                 F.sum((F.abs(e) > F.col(real) * 0.5).cast("long")).alias("n_err")))
    out = _run(agg.select(F.date_format("w.start", "yyyy-MM-dd").alias("window_start"), key, "n", "sse", "se", "n_err"),
               name, "update", by_batch=True, run_id=run_id)
    f = latest_per_key(stream.sparkSession, out, ["window_start", key])
    return f.select("window_start", key, "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                    (F.col("se") / F.col("n")).alias("bias"), (F.col("n_err") / F.col("n")).alias("error_rate"))


def stream_drift(stream: DataFrame, ref_shares: DataFrame, lo: float, hi: float, bins: int, col: str, ts: str,
                 window: str = "1 day", delay: str = "1 day", threshold: float = 0.1, name: str = "drift",
                 run_id: str | None = None) -> DataFrame:
    """O3: per window, bin shares of ``col`` vs the training shares,
    population-stability index Σ (p - q) ln(p / q) (empty shares floored at
    1e-4) and an alarm flag."""
    width = (hi - lo) / bins
    b = F.greatest(F.lit(0), F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))).cast("int")
    s = stream.withColumn("__t", F.col(ts).cast("timestamp")).withColumn("bin", b)
    agg = (s.withWatermark("__t", delay).groupBy(F.window("__t", window).alias("w"), "bin")
            .agg(F.count(F.lit(1)).alias("n")))
    out = _run(agg.select(F.date_format("w.start", "yyyy-MM-dd").alias("window_start"), "bin", "n"), name, "update",
               by_batch=True, run_id=run_id)
    cnt = latest_per_key(stream.sparkSession, out, ["window_start", "bin"])
    wins = cnt.select("window_start").distinct()
    grid = wins.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))   # windows x bins (bins bounded)
    full = grid.join(cnt, ["window_start", "bin"], "left").fillna(0, ["n"])
    full = full.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("window_start")))
    full = full.join(F.broadcast(ref_shares.select(     # one row per histogram bin
        "bin", F.col("share").alias("q"))), "bin", "left").fillna(0.0, ["q"])
    p = F.greatest(F.col("p"), F.lit(PSI_EPS))
    q = F.greatest(F.col("q"), F.lit(PSI_EPS))
    psi = full.groupBy("window_start").agg(F.sum((p - q) * F.log(p / q)).alias("psi"), F.sum("n").alias("n"))
    return psi.withColumn("alarm", (F.col("psi") > F.lit(threshold)).cast("int"))


def split_late(stream: DataFrame, ts: str, window_seconds: int, delay_seconds: int, run_id: str, name: str = "late") -> tuple[DataFrame, DataFrame]:
    """The arriving rows on time and the late ones, as two tables with ``window_start``.

    A row is late if its window had ended by the watermark: the greatest time of the
    batches before its own, less the delay.  That greatest time is written with every
    batch, so a restarted job goes on with it and a batch that is run again, which
    rewrites its own folders, splits its rows as before.  Rows without a time belong to no
    window and stand with the late ones.  Reusing ``run_id`` reads only what is new; two jobs need ids of their own.
    """
    spark = stream.sparkSession
    root, ckpt = scratch_path(spark, f"stream-out/{name}-{run_id}"), scratch_path(spark, f"stream-ckpt/{name}-{run_id}")
    width = F.lit(window_seconds)
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    rows = stream.withColumn("window_start", F.timestamp_seconds(F.floor(at / width) * width))
    tables = {"on_time": rows.schema, "late": rows.schema, "marks": "greatest long"}
    for t, schema in tables.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(os.path.join(root, t, "batch=-1"))

    def read(t: str) -> DataFrame:
        return spark.read.schema(tables[t]).option("basePath", os.path.join(root, t)).parquet(os.path.join(root, t))

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = spark.read.parquet(os.path.join(root, "marks")).where(F.col("batch") < batch_id).agg(F.max("greatest")).first()[0]
        late = F.col("window_start").isNull()
        if seen is not None:
            late = late | (F.unix_seconds("window_start") + width <= F.lit(seen - delay_seconds))
        batch = batch.persist()
        try:
            for t, part in (("late", batch.where(late)), ("on_time", batch.where(~late)), ("marks", batch.agg(F.max(at).alias("greatest")))):
                part.write.mode("overwrite").parquet(os.path.join(root, t, f"batch={batch_id}"))
        finally:
            batch.unpersist()

    q = rows.writeStream.option("checkpointLocation", ckpt).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    return read("on_time"), read("late")


def late_counts(on_time: DataFrame, late: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per window and key the rows on time and the late ones, every window of either."""
    both = on_time.select("window_start", *keys, F.lit(0).alias("__late")).unionByName(late.select("window_start", *keys, F.lit(1).alias("__late")))
    return both.groupBy("window_start", *keys).agg(F.count_if(F.col("__late") == 0).alias("n"), F.count_if(F.col("__late") == 1).alias("n_late"))
