"""Filters, ranking windows and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foldsafe.operators.positions import group_rank, ordered_sum, topk_per_group
from foldsafe.operators.ranges import ROWS_PER_RANGE


def first_n_per_cell(df: DataFrame, cells: Sequence[tuple], real: str, pred: str, order: str, n: int) -> DataFrame:
    """Rows with (real = a and pred = b) for each listed cell, the first n
    of each cell by ``order``."""
    cond = None
    for a, b in cells:
        c = (F.col(real) == F.lit(a)) & (F.col(pred) == F.lit(b))
        cond = c if cond is None else cond | c
    return topk_per_group(df.where(cond), [real, pred], [F.col(order).asc()], n, out="rn")


def facet_filter(df: DataFrame, selections: dict) -> DataFrame:
    """Multi-select facets; an empty selection means "all"."""
    for col, chosen in selections.items():
        if chosen:
            df = df.where(F.col(col).isin(list(chosen)))
    return df


def best_runs(runs: DataFrame, metric: str, by: Sequence[str] = ("search_id",), name_prefix: str | None = None,
              name_col: str = "kernel") -> DataFrame:
    """C3 + G3: finished runs without a parent (and optional name prefix),
    metric not NULL; the best (lowest metric, then lowest run id) per group."""
    r = runs.where((F.col("status") == "FINISHED") & F.col(metric).isNotNull())
    if "parent_run_id" in runs.columns:
        r = r.where(F.col("parent_run_id").isNull())
    if name_prefix:
        r = r.where(F.col(name_col).startswith(name_prefix))
    return r.groupBy(*by).agg(F.min_by(F.struct(metric, "run_id"), F.struct(metric, "run_id")).alias("b"),
                              F.count(F.lit(1)).alias("n_runs")).select(*by, "n_runs", "b.*")


def first_n(df: DataFrame, order: str, n: int) -> DataFrame:
    """First n rows in an explicit order (TakeOrdered, no global sort)."""
    return df.orderBy(order).limit(n)


def flag_budget(df: DataFrame, cost: str, cap: float, out: str = "skipped") -> DataFrame:
    """Keep every candidate, flag those over the budget with the reason."""
    over = F.col(cost) > F.lit(cap)
    return df.withColumn(out, over.cast("int")).withColumn(
        "reason", F.when(over, F.format_string("projected %.1f > cap %.1f", F.col(cost), F.lit(cap))))


def rank_candidates(df: DataFrame, score: str, by: Sequence[str] = ("search_id",), out: str = "rank") -> DataFrame:
    """F1: rank by score ascending within a search; ties share the lowest rank
    (two-level, so a search holding a third of all runs is not one task)."""
    return group_rank(df, list(by), score, out)


def budget_cutoff(df: DataFrame, cost: str, cap: float, by: Sequence[str] = ("search_id",), order: str | None = None,
                  n_dearest: int = 5, key: str = "run_id", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """candidates cheapest first; running projected clock; whether the
    candidate still fits the cap; the n dearest flagged.  Both the running sum
    and the top-n are two-level (hot searches are split)."""
    order = order or cost
    d = ordered_sum(df, list(by), [order, key], cost, "clock", rows_per_range)
    d = d.withColumn("inside_cap", (F.col("clock") <= F.lit(cap)).cast("int"))
    dear = topk_per_group(df.select(*by, key, cost), list(by), [F.col(cost).desc(), F.col(key).asc()], n_dearest, out="dear_rank")
    d = d.join(dear.select(*by, key, "dear_rank"), [*by, key], "left")
    return d.withColumn("is_dearest", F.col("dear_rank").isNotNull().cast("int"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (Spark plans TakeOrderedAndProject: per-partition
    top-k, then a k-row merge — no full sort)."""
    return df.orderBy(*order).limit(k)
