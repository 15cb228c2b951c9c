"""Exact quantiles without collecting a column into one buffer.

Spark's exact ``percentile``/``median`` keep every distinct value of a group
in one aggregation buffer — fine for thousands of values, not for a column of
billions.  Here an exact quantile is found by narrowing value ranges:

1. per (group, column) key the rows are counted, with their least and greatest
   value; a key of one value answers at once (a value holding a third of the
   rows never needs sorting), one of at most ``MAX_EXACT_ROWS`` rows is ranked;
2. the range of a larger key is cut into 256 equal-width buckets (a join with
   the range table and one arithmetic expression per row — no arrays, no UDF);
3. bucket counts with their min/max locate the bucket that holds each wanted
   rank, and it takes the place of the key's range in 1.

No task ever ranks more than ``MAX_EXACT_ROWS`` rows, at any data size.  Ranges,
counts and answers are tables in the shared folder, so any number of groups will
do; the driver only learns whether a range is left.
Interpolation is linear between ranks floor(h) and ceil(h), h = (n - 1) q —
the semantics of ``percentile``, ``median`` and DuckDB's ``quantile_cont``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.operators.broadcast import bounded
from foldsafe.session import scratch_path

N_BUCKETS = 256
MAX_EXACT_ROWS = 2_000_000

_RANGE = ["__k", "__lo", "__hi", "__off"]


def _kept(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, f"quantiles-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``__k`` (struct of group and column name) and ``x`` of every value."""
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols]
    d = df.select(*by, F.explode(F.array(*structs)).alias("__s")).where(F.col("__s.x").isNotNull())
    return d.select(F.struct(*by, F.col("__s.column").alias("column")).alias("__k"), F.col("__s.x").alias("x"))


def _bucket(x: Column, lo: Column, hi: Column) -> Column:
    """The bucket of ``x``; where the width is no positive finite number, the ends get buckets of their own."""
    width = hi / N_BUCKETS - lo / N_BUCKETS
    usable = (width > 0) & (width < float("inf"))
    even = F.least(F.floor((x - lo) / F.when(usable, width)), F.lit(N_BUCKETS - 1))
    return F.when(usable, even).when(x == lo, 0).when(x == hi, N_BUCKETS - 1).otherwise(N_BUCKETS // 2).cast("int")


def _inside(long: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of ``long`` in each of the ranges, which don't overlap within a key."""
    r = bounded(ranges.select(*_RANGE).distinct()).withColumnRenamed("__k", "__rk")
    on = (F.col("__k") == F.col("__rk")) & (F.col("x") >= F.col("__lo")) & (F.col("x") <= F.col("__hi"))
    return long.join(r, on).drop("__rk")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    discrete: bool = False) -> DataFrame:
    """Exact quantiles: one row per (by..., column, prob) with ``value``, a key without values having none.

    Linear interpolation, or with ``discrete`` the least value whose cumulated share reaches the probability.
    """
    long = _long(df, cols, by)
    sizes = _kept(long.groupBy("__k").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    n, prob = F.col("n"), F.col("prob")
    h = F.greatest(F.ceil(prob * n) - 1, F.lit(0)).cast("double") if discrete else (n - 1) * prob
    plan = sizes.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).withColumn("h", h)
    plan = plan.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("h"), F.ceil("h")))))
    todo = plan.select("__k", F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.lit(0).cast("long").alias("__off"),
                       n.alias("__n"), "rank").distinct()
    known, small = [], []
    while True:
        several = F.col("__lo") < F.col("__hi")
        known.append(todo.where(~several).select("__k", "rank", F.col("__lo").alias("x")))
        small.append(todo.where(several & (F.col("__n") <= MAX_EXACT_ROWS)))
        wide = todo.where(several & (F.col("__n") > MAX_EXACT_ROWS))
        if wide.isEmpty():
            break
        counts = (_inside(long, wide).groupBy(*_RANGE, _bucket(F.col("x"), F.col("__lo"), F.col("__hi")).alias("__b"))
                  .agg(F.count(F.lit(1)).alias("cnt"), F.min("x").alias("bmin"), F.max("x").alias("bmax")))
        before = Window.partitionBy(*_RANGE).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("start", F.col("__off") + F.coalesce(F.sum("cnt").over(before), F.lit(0)))
        hit = wide.join(counts, _RANGE).where("rank >= start and rank < start + cnt")
        todo = _kept(hit.select("__k", F.col("bmin").alias("__lo"), F.col("bmax").alias("__hi"),
                                F.col("start").alias("__off"), F.col("cnt").alias("__n"), "rank"))
    exact = reduce(DataFrame.union, small)
    place = F.row_number().over(Window.partitionBy(*_RANGE).orderBy("x")) - 1 + F.col("__off")
    ranked = _inside(long, exact).withColumn("rank", place.cast("long")).join(exact, [*_RANGE, "rank"]).select("__k", "rank", "x")
    answers = reduce(DataFrame.union, known, ranked)
    ends = plan.select("__k", "prob", "h", "rank").join(answers, ["__k", "rank"]).groupBy("__k", "prob", "h").agg(
        F.min(F.struct("rank", "x")).alias("a"), F.max(F.struct("rank", "x")).alias("b"))
    a, b = F.col("a.x"), F.col("b.x")
    value = F.when(a == b, a).otherwise(a + (F.col("h") - F.col("a.rank")) * (b - a))
    return _kept(ends.select("__k.*", "prob", value.alias("value")))


def exact_quantile_dict(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """Ungrouped quantiles as fitted constants {column: {prob: value}}."""
    out = {c: {p: None for p in probs} for c in cols}
    for r in exact_quantiles(df, cols, probs).collect():
        out[r["column"]][r["prob"]] = r["value"]
    return out


def exact_median(df: DataFrame, cols: Sequence[str]) -> dict:
    return {c: v[0.5] for c, v in exact_quantile_dict(df, cols, [0.5]).items()}
