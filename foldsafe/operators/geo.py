"""The geographic branch: similarities to weighted cluster centres, refitted per training part.

Weighted k-means for all training parts of a set of folds at once: a step finds the
nearest centre of every row in every part it trains, and Spark sums weights and
coordinates by part and centre; folds x k rows reach the driver.  Coordinates are
counted in whole units and weights are integers, so the sums are exact and the
centres the same however the rows are partitioned.  The centres and gamma are a
table, and a table that is read back scores as the one that was written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from foldsafe.functions.keys import seeded_hash

SPEC_SCHEMA = "fold int, centre int, name string, place array<double>, weight long, gamma double"


def _distance(at: Sequence[Column], place: Sequence[float]) -> Column:
    return reduce(lambda a, b: a + b, [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(at, place)])


def fit_geo(df: DataFrame, cols: Sequence[str], key: str, k: int, gamma: float, weight: str | None = None, fold: str | None = None,
            unit: float = 1e-6, steps: int = 20, seed: int = 42) -> DataFrame:
    """The spec: per fold (null without folds) the centres of all rows outside it, in ``centre`` order.

    It starts from the k distinct places of least seeded key hash, and ends when no centre
    moves or after ``steps``.  A row goes to the first of equally near centres; a centre
    without rows stays where it is.  Rows with a null or non-finite coordinate, a null fold,
    or a weight that is null or below 1 take no part; fewer than k places are as many centres.
    """
    xs = [F.col(c).cast("double") for c in cols]
    whole = reduce(lambda a, b: a & b, [F.coalesce(F.abs(x) < float("inf"), F.lit(False)) for x in xs])
    u = [f"u{i}" for i in range(len(cols))]
    d = df.select(F.col(fold).cast("int").alias("fold") if fold else F.lit(-1).alias("fold"), seeded_hash(key, seed).alias("h"), F.col(key).alias("id"),
                  (F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias("w"),
                  *[F.when(whole, F.rint(x / unit)).cast("long").alias(n) for x, n in zip(xs, u)]).where("fold is not null and w >= 1 and u0 is not null").persist()
    try:
        first = d.groupBy("fold", *u).agg(F.min(F.struct("h", "id")).alias("h"))
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy("fold").orderBy("h"))).where(F.col("rank") <= k)
        starts = first.select("fold", "h", F.array(*u).alias("place")).collect()                      # folds x k rows
        folds = sorted({r["fold"] for r in starts}) if fold else [None]
        centres, weights = {}, {}
        for f in folds:
            least = {}
            for r in sorted((r for r in starts if r["fold"] != f), key=lambda r: tuple(r["h"])):
                least.setdefault(tuple(r["place"]), None)
            centres[f] = [tuple(map(float, p)) for p in list(least)[:k]]
        for _ in range(steps):
            moved = {f: list(c) for f, c in centres.items()}
            weights = {}
            for r in _step(d, centres, u):
                weights[r["part"], r["centre"]] = r["sw"]
                moved[r["part"]][r["centre"]] = tuple(float(r[n]) / float(r["sw"]) for n in u)
            if moved == centres:
                break
            centres = moved
    finally:
        d.unpersist()
    rows = [(f, i, f"cluster_{i}_similarity", [x * unit for x in c], weights.get((f, i), 0), float(gamma)) for f in folds for i, c in enumerate(centres[f])]
    return df.sparkSession.createDataFrame(rows, SPEC_SCHEMA)


def _step(d: DataFrame, centres: dict, u: Sequence[str]) -> list[Row]:
    """Per training part and centre: the weight and weighted coordinates of its nearest rows."""
    at = [F.col(n).cast("double") for n in u]

    def nearest(f, places):
        far = F.array(*[_distance(at, p) for p in places])
        own = F.struct(F.lit(f).cast("int").alias("part"), (F.array_position(far, F.array_min(far)) - 1).cast("int").alias("centre"))
        return own if f is None else F.when(F.col("fold") != f, own)

    parts = [nearest(f, places) for f, places in centres.items() if places]
    if not parts:
        return []
    rows = d.select("w", *u, F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("p"))
    return rows.groupBy("p.part", "p.centre").agg(F.sum("w").alias("sw"), *[F.sum(F.col("w") * F.col(n)).alias(n) for n in u]).collect()


def geo_similarity(df: DataFrame, cols: Sequence[str], spec: DataFrame, fold: str | None = None, out: str = "similarity") -> DataFrame:
    """``df`` with exp(-gamma d2) to every centre of the row's fold, an array in ``centre`` order: the centres
    were fitted without the row.  Null where a coordinate is null or not finite, or the fold has no centres."""
    rows = sorted(spec.collect(), key=lambda r: (r["fold"] is not None, r["fold"], r["centre"]))       # folds x k rows
    at = [F.col(c).cast("double") for c in cols]
    whole = reduce(lambda a, b: a & b, [F.coalesce(F.abs(x) < float("inf"), F.lit(False)) for x in at])
    answer = F.lit(None).cast("array<double>")
    for f in sorted({r["fold"] for r in rows}, key=lambda f: (f is not None, f)):
        sims = F.array(*[F.exp(-F.lit(r["gamma"]) * _distance(at, r["place"])) for r in rows if r["fold"] == f])
        mine = whole if f is None else whole & (F.col(fold) == f)
        answer = F.when(mine, sims).otherwise(answer)
    return df.withColumn(out, answer)
