"""Registered queries: splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.functions.keys import sql_seeded_hash
from foldsafe.operators import splits as SP
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_BANDED, SQL_DISTRICTS, districts, districts_banded
from foldsafe.plans.sqlutil import kfold_sql, random_split_sql, stratified_split_sql
from foldsafe.session import read_table


@register("split_random", f"""WITH {SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)}
SELECT row_id, is_test FROM districts_rsplit""")
def q_i1(spark, sf):
    return SP.split_random(districts(spark, sf), "row_id", 0.2, seed=42).select("row_id", "is_test")


@register("split_stratified", f"""WITH {SQL_BANDED}, {stratified_split_sql('banded', 'row_id', 'band', 0.2, 42)}
SELECT row_id, band, is_test FROM banded_split""")
def q_i2(spark, sf):
    return SP.split_stratified(districts_banded(spark, sf), "row_id", "band", 0.2, seed=42).select("row_id", "band", "is_test")


@register("split_positional", """
SELECT vec_id, CAST(vec_id >= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM embeddings) AS INTEGER) AS is_test
FROM embeddings""")
def q_i3(spark, sf):
    e = read_table(spark, sf, "embeddings")
    n_train = int(e.count() * 0.8)          # one scalar: the canonical train size
    return SP.split_positional(e, "vec_id", n_train).select("vec_id", "is_test")


@register("fold_kfold_shuffled", f"""WITH {SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, 42)}
SELECT row_id, fold FROM districts_kf""")
def q_i4(spark, sf):
    return SP.fold_kfold_shuffled(districts(spark, sf), "row_id", 5, seed=42).select("row_id", "fold")


@register("fold_kfold_contiguous", f"""WITH {SQL_DISTRICTS}, {kfold_sql('districts', 'row_id', 5, order='row_id')}
SELECT row_id, fold FROM districts_kf""")
def q_i5(spark, sf):
    return SP.fold_kfold_contiguous(districts(spark, sf), "row_id", 5).select("row_id", "fold")


@register("fold_stratified", f"""
SELECT event_id, CAST(label AS INTEGER) AS label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY {sql_seeded_hash('event_id', 42)}, event_id) - 1) % 5 AS INTEGER) AS fold,
       CAST((row_number() OVER (PARTITION BY label ORDER BY event_id) - 1) % 5 AS INTEGER) AS fold_unshuffled
FROM (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)""")
def q_i6(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", (F.col("event_type") == "purchase").cast("int").alias("label"))
    a = SP.fold_stratified(e, "event_id", "label", 5, seed=42)
    b = SP.fold_stratified(a, "event_id", "label", 5, seed=None, out="fold_unshuffled")
    return b.select("event_id", "label", "fold", "fold_unshuffled")


@register("split_hash", """
SELECT row_id, CAST(('0x' || substr(md5(CAST(row_id AS VARCHAR)), 1, 8))::BIGINT < 0.2 * 4294967296.0 AS INTEGER) AS is_test
FROM (SELECT o_orderkey AS row_id FROM orders)""")
def q_i7(spark, sf):
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"))
    return SP.split_hash(o, "row_id", 0.2).select("row_id", "is_test")


@register("split_time", """
WITH q AS (SELECT quantile_disc(epoch_us(ts), 0.2) AS q1, quantile_disc(epoch_us(ts), 0.4) AS q2,
                  quantile_disc(epoch_us(ts), 0.6) AS q3, quantile_disc(epoch_us(ts), 0.8) AS q4 FROM events)
SELECT event_id, CAST(ts >= TIMESTAMP '2024-01-20 00:00:00' AS INTEGER) AS is_test,
       CAST((epoch_us(ts) >= q1)::INT + (epoch_us(ts) >= q2)::INT + (epoch_us(ts) >= q3)::INT + (epoch_us(ts) >= q4)::INT AS INTEGER) AS time_fold
FROM events, q""")
def q_i8(spark, sf):
    e = read_table(spark, sf, "events")
    d = SP.split_time(e, "ts", "2024-01-20 00:00:00")
    d = SP.fold_time_expanding(d, "ts", 4)
    return d.select("event_id", "is_test", F.col("time_fold").cast("int").alias("time_fold"))


@register("split_group", f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
{random_split_sql('u', 'user_id', 0.2, 42)}
SELECT e.event_id, e.user_id, r.is_test FROM events e JOIN u_rsplit r USING (user_id)""")
def q_i9(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", "user_id")
    return SP.split_group(e, "user_id", 0.2, seed=42).select("event_id", "user_id", "is_test")


@register("win_stratum_position", f"""WITH {SQL_BANDED}
SELECT row_id, band, row_number() OVER (PARTITION BY band ORDER BY {sql_seeded_hash('row_id', 42)}, row_id) - 1 AS pos
FROM banded""")
def q_f3(spark, sf):
    return SP.stratum_position(districts_banded(spark, sf), "row_id", "band", 42).select("row_id", "band", "pos")
