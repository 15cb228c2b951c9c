"""Splits and folds.

Every assignment is exact (counts match the requested sizes), reproducible
(seeded hash of the row key, never ``rand()``) and partition-invariant.
Each function returns the input with one extra column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.functions.keys import TWO_32, seeded_hash
from foldsafe.operators.positions import hash_positions, ordered_positions
from foldsafe.operators.quantiles import exact_quantiles


def _fold_of(pos, total, k: int):
    """Contiguous cut of positions 0..n-1 into k folds; the first n % k folds
    hold one extra row (the KFold convention)."""
    q = F.floor(total / F.lit(k))
    r = total - q * F.lit(k)
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - big) / q)).cast("int")


def split_random(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42,
                 out: str = "is_test") -> DataFrame:
    """Exactly ceil(test_frac * n) rows flagged as test."""
    d = hash_positions(df, key, seed, out="__pos", total_out="__n")
    return d.withColumn(out, (F.col("__pos") < F.ceil(F.col("__n") * F.lit(test_frac))).cast("int")).drop("__pos", "__n")


def stratum_quotas(counts: DataFrame, stratum: str, test_frac: float) -> DataFrame:
    """Per-stratum test quota from a (stratum, n) table: floor shares, then the
    leftover by largest remainder (ties by stratum value).  Runs on the
    (strata)-row table only."""
    w_all = Window.partitionBy(F.lit(1))
    c = (counts.withColumnRenamed("n", "__c")
          .withColumn("__n", F.sum("__c").over(w_all))
          .withColumn("__t", F.ceil(F.col("__n") * F.lit(test_frac)))
          .withColumn("__exact", F.col("__t") * F.col("__c") / F.col("__n"))
          .withColumn("__fl", F.floor("__exact"))
          .withColumn("__left", F.col("__t") - F.sum("__fl").over(w_all)))
    w_rem = Window.orderBy(F.desc(F.col("__exact") - F.col("__fl")), F.asc_nulls_first(stratum))
    c = c.withColumn("__rank", F.row_number().over(w_rem))
    return c.select(stratum, (F.col("__fl") + (F.col("__rank") <= F.col("__left")).cast("int")).cast("bigint").alias("quota"))


def split_stratified(df: DataFrame, key: str, stratum: str, test_frac: float = 0.2,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """Exact test size overall and per stratum (largest remainder).
    Quotas come from the same (stratum, bucket) count aggregate as the
    positions: the source is read twice in total (counts, then rows)."""
    counts = []
    d = hash_positions(df, key, seed, group_cols=[stratum], out="__pos", counts_out=counts)
    quotas = stratum_quotas(counts[0], stratum, test_frac)
    d = d.join(bounded(quotas), d[stratum].eqNullSafe(quotas[stratum]), "inner").drop(quotas[stratum])
    return d.withColumn(out, (F.col("__pos") < F.col("quota")).cast("int")).drop("__pos", "quota")


def split_positional(df: DataFrame, row_id: str, n_train: int, out: str = "is_test") -> DataFrame:
    """First n rows by an explicit row id are train, the rest test."""
    return df.withColumn(out, (F.col(row_id) >= F.lit(n_train)).cast("int"))


def fold_kfold_shuffled(df: DataFrame, key: str, k: int = 5, seed: int = 42,
                        out: str = "fold") -> DataFrame:
    """I4: k folds over a seeded shuffle; sizes differ by at most one."""
    d = hash_positions(df, key, seed, out="__pos", total_out="__n")
    return d.withColumn(out, _fold_of(F.col("__pos"), F.col("__n"), k)).drop("__pos", "__n")


def fold_kfold_contiguous(df: DataFrame, order_col: str, k: int = 5, out: str = "fold") -> DataFrame:
    """K contiguous blocks in stored order (the un-shuffled integer ``cv``)."""
    d = ordered_positions(df, order_col, out="__pos", total_out="__n")
    return d.withColumn(out, _fold_of(F.col("__pos"), F.col("__n"), k)).drop("__pos", "__n")


def fold_stratified(df: DataFrame, key: str, label: str, k: int = 5, seed: int | None = 42,
                    out: str = "fold") -> DataFrame:
    """Per-class round robin over the class order: (position in class) mod k.

    ``seed=None`` keeps the stored order of ``key`` (un-shuffled variant).
    """
    if seed is None:
        d = ordered_positions(df, key, group_cols=[label], out="__pos")
    else:
        d = hash_positions(df, key, seed, group_cols=[label], out="__pos")
    return d.withColumn(out, F.pmod(F.col("__pos"), F.lit(k)).cast("int")).drop("__pos")


def stratum_position(df: DataFrame, key: str, stratum: str, seed: int = 42, out: str = "pos") -> DataFrame:
    """position of each row inside its stratum in seeded-hash order."""
    return hash_positions(df, key, seed, group_cols=[stratum], out=out)


def split_hash(df: DataFrame, key: str, test_frac: float = 0.2, seed: int | None = None,
               out: str = "is_test") -> DataFrame:
    """Row-wise stable membership, hash(key) < ratio * 2^32.

    Adding or removing other rows never moves a row.  Without a seed the
    plain md5 of the key is used.
    """
    if seed is None:
        h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    else:
        h = seeded_hash(key, seed)
    return df.withColumn(out, (h < F.lit(test_frac * TWO_32)).cast("int"))


def time_cuts(df: DataFrame, ts: str, k: int) -> list:
    """k exact (discrete) time quantiles i/(k+1) as epoch microseconds (exact
    as doubles until the year 2255), without sorting all times in one task."""
    us = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    cuts = exact_quantiles(us, ["us"], [i / (k + 1) for i in range(1, k + 1)], discrete=True).orderBy("prob").collect()
    return [int(r["value"]) for r in cuts]


def split_time(df: DataFrame, ts: str, cutoff: str, out: str = "is_test") -> DataFrame:
    """I8: train strictly before the cutoff, test at or after it."""
    return df.withColumn(out, (F.col(ts) >= F.lit(cutoff).cast(df.schema[ts].dataType)).cast("int"))


def fold_time_expanding(df: DataFrame, ts: str, k: int = 4, out: str = "time_fold") -> DataFrame:
    """I8: expanding-window folds.  ``time_fold`` = number of the k time
    quantiles <= ts; fold f validates on rows with time_fold = f and trains on
    rows with time_fold < f."""
    cuts = time_cuts(df, ts, k)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    expr = F.lit(0)
    for c in cuts:
        expr = expr + (us >= F.lit(c)).cast("int")
    return df.withColumn(out, expr)


def split_group(df: DataFrame, group_key: str, test_frac: float = 0.2, seed: int = 42,
                out: str = "is_test") -> DataFrame:
    """All rows of an entity on one side; exactly ceil(frac * entities)
    entities in test, chosen by seeded hash of the entity key."""
    ents = df.select(group_key).distinct()
    flagged = split_random(ents, group_key, test_frac, seed, out)
    return df.join(flagged, group_key, "inner")
