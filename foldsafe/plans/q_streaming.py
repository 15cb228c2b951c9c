"""Registered queries: streaming scoring and monitoring over ``events`` (O1-O3).

The events table is first laid out as several files (Spark-derived) so the
file stream really runs in several micro-batches."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from foldsafe.operators.stats import histogram_bin
from foldsafe.plans.catalog import register
from foldsafe.session import read_table, scratch_path
from foldsafe.sources.files import tag
from foldsafe.streaming import monitor as MON

CUTOFF = "2024-01-15 00:00:00"
BINS = 10
# The demo stream replays a whole month at once; a watermark wider than the
# span keeps every row (a live job uses hours).
DELAY = "40 days"


def _events_dir(spark, sf):
    path = scratch_path(spark, f"events-stream-{tag(os.path.abspath(sf))}")
    if not os.path.exists(os.path.join(path, "_SUCCESS")):
        e = read_table(spark, sf, "events")
        e.repartition(6, F.to_date("ts")).write.mode("overwrite").parquet(path)
    return path


def _stream(spark, sf):
    path = _events_dir(spark, sf)
    schema = spark.read.parquet(path).schema
    return MON.stream_files(spark, path, schema, max_files=2)


def _baseline(spark, sf):
    """Fitted on the training window: mean value per event type (bounded by types)."""
    e = read_table(spark, sf, "events").where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return e.groupBy("event_type").agg(F.avg("value").alias("pred"))


BASE_SQL = f"""base AS (SELECT event_type, avg(value) AS pred FROM events WHERE ts < TIMESTAMP '{CUTOFF}' GROUP BY event_type)"""


@register("stream_score", f"""WITH {BASE_SQL}
SELECT e.event_id, e.event_type, round(b.pred, 6) AS pred FROM events e LEFT JOIN base b USING (event_type)""")
def q_o1(spark, sf):
    s = MON.stream_score(_stream(spark, sf).select("event_id", "event_type"), _baseline(spark, sf), "event_type", "score")
    return s.select("event_id", "event_type", F.round("pred", 6).alias("pred"))


@register("stream_metrics", f"""WITH {BASE_SQL},
s AS (SELECT strftime(date_trunc('day', e.ts), '%Y-%m-%d') AS window_start, e.event_type, b.pred - e.value AS err, e.value
      FROM events e LEFT JOIN base b USING (event_type))
SELECT window_start, event_type, count(*) AS n, round(sqrt(sum(err * err) / count(*)), 6) AS rmse,
       round(sum(err) / count(*), 6) AS bias, round(sum(CAST(abs(err) > value * 0.5 AS BIGINT)) / count(*), 6) AS error_rate
FROM s GROUP BY 1, 2""")
def q_o2(spark, sf):
    m = MON.stream_metrics(_stream(spark, sf).select("event_id", "ts", "event_type", "value"), _baseline(spark, sf),
                           "event_type", "ts", "value", "pred", delay=DELAY)
    return m.select("window_start", "event_type", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "bias", "error_rate")])


def _ref_hist(spark, sf):
    tr = read_table(spark, sf, "events").where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    lo, hi = tr.agg(F.min("value"), F.max("value")).first()
    b = tr.groupBy(histogram_bin(F.col("value"), lo, hi, BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    tot = tr.count()
    return b.select("bin", (F.col("n") / F.lit(float(tot))).alias("share")), lo, hi


@register("stream_drift", f"""WITH tr AS (SELECT * FROM events WHERE ts < TIMESTAMP '{CUTOFF}'),
r AS (SELECT min(value) AS lo, max(value) AS hi FROM tr),
ref AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / {BINS})), {BINS - 1}) AS INTEGER) AS bin, count(*) / (SELECT count(*) FROM tr) AS q
        FROM tr, r GROUP BY 1),
s AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start,
             CAST(greatest(0, least(floor((value - lo) / ((hi - lo) / {BINS})), {BINS - 1})) AS INTEGER) AS bin FROM events, r),
c AS (SELECT window_start, bin, count(*) AS n FROM s GROUP BY 1, 2),
g AS (SELECT w.window_start, b.bin FROM (SELECT DISTINCT window_start FROM c) w, range(0, {BINS}) b(bin)),
f AS (SELECT g.window_start, g.bin, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (window_start, bin)),
p AS (SELECT f.*, n / sum(n) OVER (PARTITION BY window_start) AS p, coalesce(ref.q, 0.0) AS q FROM f LEFT JOIN ref USING (bin))
SELECT window_start, round(sum((greatest(p, {MON.PSI_EPS}) - greatest(q, {MON.PSI_EPS})) * ln(greatest(p, {MON.PSI_EPS}) / greatest(q, {MON.PSI_EPS}))), 6) AS psi,
       CAST(sum(n) AS BIGINT) AS n, CAST(sum((greatest(p, {MON.PSI_EPS}) - greatest(q, {MON.PSI_EPS})) * ln(greatest(p, {MON.PSI_EPS}) / greatest(q, {MON.PSI_EPS}))) > 0.1 AS INTEGER) AS alarm
FROM p GROUP BY window_start""")
def q_o3(spark, sf):
    ref, lo, hi = _ref_hist(spark, sf)
    d = MON.stream_drift(_stream(spark, sf).select("ts", "value"), ref, lo, hi, BINS, "value", "ts", delay=DELAY)
    return d.select("window_start", F.round("psi", 6).alias("psi"), "n", "alarm")


# The arrival of late rows.  Every seventh event comes five days after its time; the feed arrives in waves of a week.
LATE_DAYS, WAVE_DAYS, WAVES, LATE_DELAY = 5, 7, 5, 86400
FEED_START = "2024-01-01"
WAVE = f"least(greatest(CAST(floor((datediff(ts, DATE'{FEED_START}') + CASE WHEN event_id % 7 = 0 THEN {LATE_DAYS} ELSE 0 END) / {WAVE_DAYS}) AS INT), 0), {WAVES - 1})"
WAVE_SQL = WAVE.replace(f"datediff(ts, DATE'{FEED_START}')", f"date_diff('day', DATE '{FEED_START}', CAST(ts AS DATE))")


@register("stream_late_rows", f"""WITH a AS (SELECT event_type, ts, date_trunc('day', ts) AS w, {WAVE_SQL} AS wave FROM events),
m AS (SELECT wave, max(floor(epoch(max(ts)))) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a GROUP BY wave),
s AS (SELECT a.*, coalesce(epoch(w) + 86400 <= seen - {LATE_DELAY}, false) AS late FROM a JOIN m USING (wave))
SELECT strftime(w, '%Y-%m-%d') AS window_start, event_type, CAST(count_if(NOT late) AS BIGINT) AS n, CAST(count_if(late) AS BIGINT) AS n_late FROM s GROUP BY ALL""")
def q_late(spark, sf):
    """O2 with late rows: the feed comes in waves, the job is started anew for each and goes on where it stopped."""
    run = uuid.uuid4().hex
    feed = scratch_path(spark, f"feed-{run}")
    e = read_table(spark, sf, "events").select("event_id", "event_type", "ts").withColumn("wave", F.expr(WAVE))
    for wave in range(WAVES):
        e.where(F.col("wave") == wave).drop("wave").write.mode("append").parquet(feed)
        stream = spark.readStream.schema(e.drop("wave").schema).parquet(feed)
        on_time, late = MON.split_late(stream, "ts", 86400, LATE_DELAY, run)
    c = MON.late_counts(on_time, late, ["event_type"])
    return c.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "event_type", "n", "n_late")
