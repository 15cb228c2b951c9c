"""Relational joins and set operations the studies imply
(D1-D3, D7-D11, H1-H3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from foldsafe.functions.scalars import shift_matrix


def semi_by_key(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Attributes of the rows whose key is in ``keys`` (left semi join)."""
    return df.join(keys.select(on), on, "left_semi")


def inner_required(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Inner equi-join."""
    return left.join(right, on, "inner")


def missing_required(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """D2 check: left rows without a partner (must be empty for a valid registry)."""
    return left.join(right, on, "left_anti")


def anti_resume(candidates: DataFrame, done: DataFrame, key: str = "cand_key") -> DataFrame:
    """D3 / M5: candidates not yet measured (left anti join on the key)."""
    return candidates.join(done.select(key), key, "left_anti")


def rbf_features(df: DataFrame, x: Sequence[str], centres: Sequence[Sequence[float]], gamma: float,
                 prefix: str = "sim_") -> DataFrame:
    """exp(-gamma * |x - c|²) for each of a bounded list of centres.

    The centres are fitted constants (<= a few dozen), inlined as literals: a
    projection, no join and no shuffle."""
    cols = {}
    for j, c in enumerate(centres):
        d2 = None
        for xi, ci in zip(x, c):
            t = (F.col(xi) - F.lit(float(ci))) ** 2
            d2 = t if d2 is None else d2 + t
        cols[f"{prefix}{j}"] = F.exp(-F.lit(float(gamma)) * d2)
    return df.withColumns(cols)


def parity(expected: DataFrame, actual: DataFrame, key: str, col: str, tol: float = 1e-4) -> DataFrame:
    """Full outer join of expected vs actual; max and mean deviation,
    rows over tolerance and rows present on one side only."""
    e = expected.select(key, F.col(col).alias("__e"))
    a = actual.select(key, F.col(col).alias("__a"))
    j = e.join(a, key, "full_outer")
    dev = F.abs(F.col("__e") - F.col("__a"))
    return j.agg(F.count(F.lit(1)).alias("n"), F.max(dev).alias("max_dev"), F.avg(dev).alias("mean_dev"),
                 F.count_if(dev > tol).alias("n_fail"),
                 F.count_if(F.col("__e").isNull() | F.col("__a").isNull()).alias("n_unmatched"))


def interval_overlap(models: DataFrame, lo: str, hi: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Does each model's interval overlap the best (lowest score) model's
    interval?  The best row per group is one row per group, joined on the
    group key."""
    best = models.groupBy(*by).agg(F.min_by(F.struct(F.col(lo).alias("blo"), F.col(hi).alias("bhi")), score).alias("__b"))
    best = best.select(*by, "__b.blo", "__b.bhi")
    if by:
        j = models.join(F.broadcast(best), list(by))      # one row per group
    else:
        b = best.first()
        j = models.withColumn("blo", F.lit(b["blo"])).withColumn("bhi", F.lit(b["bhi"]))
    return j.withColumn("overlaps_best", (~((F.col(lo) > F.col("bhi")) | (F.col(hi) < F.col("blo")))).cast("int"))


def paired_delta(df: DataFrame, key: Sequence[str], treatment: str, a, b, score: str) -> DataFrame:
    """The same candidate under two treatments side by side (conditional
    aggregation = pivot without a self-join), delta = b - a."""
    g = df.groupBy(*key).agg(F.max(F.when(F.col(treatment) == F.lit(a), F.col(score))).alias("score_a"),
                             F.max(F.when(F.col(treatment) == F.lit(b), F.col(score))).alias("score_b"))
    return g.where(F.col("score_a").isNotNull() & F.col("score_b").isNotNull()).withColumn(
        "delta", F.col("score_b") - F.col("score_a"))


def augment_shifts(df: DataFrame, vec: str, h: int, w: int,
                   offsets: Sequence[tuple[int, int]] = ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))) -> DataFrame:
    """H1: original rows plus shifted copies (bag union) in ONE scan: explode
    the offset list, then shift.  Row count x len(offsets), label kept."""
    offs = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])
    d = df.withColumn("__o", F.explode(offs))
    shifted = None
    for dy, dx in offsets:
        e = shift_matrix(vec, dy, dx, h, w)
        cond = (F.col("__o.dy") == dy) & (F.col("__o.dx") == dx)
        shifted = F.when(cond, e) if shifted is None else shifted.when(cond, e)
    return d.withColumn(vec, shifted).withColumn("dy", F.col("__o.dy")).withColumn("dx", F.col("__o.dx")).drop("__o")


def union_folds(parts: Sequence[DataFrame]) -> DataFrame:
    """H3: bag union of per-fold outputs."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
