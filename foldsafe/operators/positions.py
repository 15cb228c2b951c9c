"""Exact global positions without a single-partition sort.

A window ``row_number() over (order by h)`` with no partition moves every
row to one task.  Here the order key is first cut into B monotone buckets
(the top bits of a uniform hash, or approximate quantiles of any other
key); a tiny (groups x B) table of bucket counts gives each bucket its
offset; the final ``row_number`` runs per (group, bucket), so a hot group
is spread over B tasks.  The position does not depend on B.  Orders by given
columns are cut into ranges whose number follows the rows (``ranges``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.functions.keys import seeded_hash
from foldsafe.operators.ranges import ROWS_PER_RANGE, as_keys, elastic_ranges

DEFAULT_BUCKET_BITS = 12


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def positions(df: DataFrame, order_cols: Sequence[str], bucket: Column,
              group_cols: Sequence[str] = (), out: str = "pos",
              total_out: str | None = None, counts_out: list | None = None) -> DataFrame:
    """0-based position of every row inside its group, ordered by ``order_cols``.

    ``bucket`` must be monotone non-decreasing in ``order_cols``.  Plan: one
    exchange on (group, bucket) for the local ``row_number``; the bucket
    offsets come from a (groups x buckets) count table joined afterwards
    (small: AQE broadcasts it).  Optionally adds the group size as
    ``total_out``; ``counts_out`` receives the per-group count table so
    callers derive quotas from the same aggregate (Spark reuses the exchange).
    """
    group_cols = list(group_cols)
    d = df.withColumn("__b", bucket)
    counts = d.groupBy(*group_cols, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    if counts_out is not None:
        counts_out.append(counts.groupBy(*group_cols).agg(F.sum("__cnt").alias("n")))
    w = Window.partitionBy(*group_cols).orderBy("__b") if group_cols else Window.orderBy("__b")
    offs = counts.withColumn("__off", F.sum("__cnt").over(w) - F.col("__cnt"))
    if total_out:
        wt = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(1))
        offs = offs.withColumn(total_out, F.sum("__cnt").over(wt))
    offs = offs.drop("__cnt")
    wr = Window.partitionBy(*group_cols, "__b").orderBy(*order_cols)
    ranked = d.withColumn("__rn", F.row_number().over(wr))
    joined = _null_safe_join(ranked, offs, [*group_cols, "__b"])
    return (joined.withColumn(out, F.col("__off") + F.col("__rn") - F.lit(1))
                  .drop("__b", "__off", "__rn"))


def hash_positions(df: DataFrame, key: str, seed: int = 42, group_cols: Sequence[str] = (),
                   out: str = "pos", total_out: str | None = None,
                   bucket_bits: int = DEFAULT_BUCKET_BITS, hash_col: str = "__h",
                   counts_out: list | None = None) -> DataFrame:
    """Positions in seeded-hash order (ties by key): a reproducible shuffle."""
    d = df.withColumn(hash_col, seeded_hash(key, seed))
    bucket = F.shiftright(F.col(hash_col), 32 - bucket_bits)
    res = positions(d, [hash_col, key], bucket, group_cols, out, total_out, counts_out)
    return res.drop(hash_col) if hash_col == "__h" else res


def quantile_bucket(df: DataFrame, col: str, n_buckets: int = 256,
                    accuracy: int = 10000) -> Column:
    """A monotone bucket expression for an arbitrary numeric key: the number
    of approximate quantile split points <= value (split points are a bounded
    list of scalars)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    pts = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("q")).first()["q"] or []
    pts = sorted(set(float(p) for p in pts if p is not None))
    if not pts:
        return F.lit(0)
    arr = F.array(*[F.lit(p) for p in pts])
    x = F.col(col).cast("double")
    return F.when(x.isNull(), F.lit(len(pts) + 1)).otherwise(F.size(F.filter(arr, lambda p: p <= x)))


def ordered_positions(df: DataFrame, order: Sequence | str, group_cols: Sequence[str] = (),
                      out: str = "pos", total_out: str | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Positions in the order of explicit columns (names or ``Key``) that
    together are unique, such as a row id."""
    keys = as_keys([order] if isinstance(order, str) else order)
    d = elastic_ranges(df, group_cols, keys, "__range", rows_per_range)
    return positions(d, [k.sort() for k in keys], F.col("__range"), group_cols, out, total_out).drop("__range")


def ordered_sum(df: DataFrame, group_cols: Sequence[str], order: Sequence, value, out: str = "running",
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """:func:`running_sum` in the order of explicit columns (names or ``Key``)
    that together are unique in a group."""
    keys = as_keys(order)
    d = elastic_ranges(df, group_cols, keys, "__range", rows_per_range)
    return running_sum(d, group_cols, [k.sort() for k in keys], value, F.col("__range"), out).drop("__range")


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, value, bucket: Column,
                out: str = "running") -> DataFrame:
    """Cumulative sum of ``value`` inside each group in ``order_cols`` order
    (rows frame, current row included), two-level like :func:`positions`: a
    hot group is spread over its buckets; bucket totals become offsets."""
    group_cols = list(group_cols)
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn("__b", bucket).withColumn("__v", v)
    tot = d.groupBy(*group_cols, "__b").agg(F.sum("__v").alias("__s"))
    w = Window.partitionBy(*group_cols).orderBy("__b") if group_cols else Window.orderBy("__b")
    offs = tot.withColumn("__off", F.coalesce(F.sum("__s").over(w) - F.col("__s"), F.lit(0))).drop("__s")
    wr = (Window.partitionBy(*group_cols, "__b").orderBy(*order_cols)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = d.withColumn("__rs", F.sum("__v").over(wr))
    joined = _null_safe_join(ranked, offs, [*group_cols, "__b"])
    return joined.withColumn(out, F.col("__off") + F.col("__rs")).drop("__b", "__v", "__off", "__rs")


def group_rank(df: DataFrame, group_cols: Sequence[str], score: str, out: str = "rank",
               rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``rank()`` ascending within groups (ties share the lowest rank) without
    one task per group: counts per distinct (group, score), a two-level running
    count over them, joined back."""
    group_cols = list(group_cols)
    cnt = df.groupBy(*group_cols, score).agg(F.count(F.lit(1)).alias("__c"))
    cum = ordered_sum(cnt, group_cols, [score], "__c", "__cum", rows_per_range)
    cum = cum.select(*group_cols, score, (F.col("__cum") - F.col("__c") + 1).cast("int").alias(out))
    return _null_safe_join(df, cum, [*group_cols, score])


def topk_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, out: str = "rank",
                   salts: int = 64) -> DataFrame:
    """First k rows per group by a total order, two-level: top-k per
    (group, salt) first, then top-k over at most k x salts rows per group.
    Exact; a hot group is ranked by ``salts`` tasks."""
    by = list(by)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    d = df.withColumn("__salt", salt)
    part = d.withColumn("__r1", F.row_number().over(Window.partitionBy(*by, "__salt").orderBy(*order))).where(F.col("__r1") <= k)
    fin = part.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(out) <= k)
    return fin.drop("__salt", "__r1")
