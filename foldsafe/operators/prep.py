"""Preprocessing as fit -> constants, apply -> projection.

``fit_*`` runs one aggregate job and returns constants bounded by the number
of columns / levels (never by rows).  ``apply_*`` is a pure ``select`` that
Catalyst folds into the surrounding stage.  Fitting only on training rows
(or on ``fold <> i``) is what keeps the pipeline leak-free.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from foldsafe.functions.scalars import log_positive
from foldsafe.operators.quantiles import exact_median, exact_quantiles


# --- K1 / K2: imputation ----------------------------------------------------

def fit_impute_numeric(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> dict[str, float]:
    """K1: exact median (midpoint of the two middle values, computed without
    collecting a column into one buffer) or mean per column."""
    if strategy == "median":
        return exact_median(df, cols)
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def apply_impute(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def mode_table(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """K2 as a table: most frequent non-null value per group, smallest on ties."""
    g = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("__n"))
    return g.groupBy(*by).agg(F.min_by(F.col(col), F.struct(-F.col("__n"), F.col(col))).alias("mode"))


def fit_impute_mode(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """K2: most frequent category per column (smallest value on ties)."""
    return {c: mode_table(df, c).first()["mode"] for c in cols}


# --- K3: standardisation ----------------------------------------------------

def fit_standardize(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """K3: mean and POPULATION std per column; a zero std becomes 1."""
    row = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols], *[F.stddev_pop(c).alias(f"{c}__s") for c in cols]).first()
    out = {}
    for c in cols:
        s = row[f"{c}__s"]
        out[c] = (row[f"{c}__m"], 1.0 if (s is None or s == 0) else s)
    return out


def apply_standardize(df: DataFrame, params: Mapping[str, tuple[float, float]], center: bool = True,
                      suffix: str = "") -> DataFrame:
    return df.withColumns({c + suffix: ((F.col(c) - F.lit(m)) if center else F.col(c)) / F.lit(s)
                           for c, (m, s) in params.items()})


def inverse_standardize(df: DataFrame, params: Mapping[str, tuple[float, float]], center: bool = True,
                        suffix: str = "") -> DataFrame:
    return df.withColumns({c: F.col(c + suffix) * F.lit(s) + (F.lit(m) if center else F.lit(0.0))
                           for c, (m, s) in params.items()})


def fold_moments(df: DataFrame, cols: Sequence[str], fold: str) -> DataFrame:
    """Single-pass folds: per-fold (n, sum, sum of squares) once, then the
    statistics of "every fold but i" as total minus part i.  Returns one row
    per (fold, column) with mean and population std of the complement."""
    parts = df.groupBy(fold).agg(*[F.count(c).alias(f"{c}__n") for c in cols],
                                 *[F.sum(F.col(c).cast("double")).alias(f"{c}__s") for c in cols],
                                 *[F.sum(F.col(c).cast("double") ** 2).alias(f"{c}__q") for c in cols])
    w = Window.partitionBy(F.lit(1))
    tot = parts.withColumns({f"{c}__{x}t": F.sum(f"{c}__{x}").over(w) for c in cols for x in ("n", "s", "q")})
    rows = []
    for c in cols:
        n = F.col(f"{c}__nt") - F.col(f"{c}__n")
        s = F.col(f"{c}__st") - F.col(f"{c}__s")
        q = F.col(f"{c}__qt") - F.col(f"{c}__q")
        m = s / n
        var = F.greatest(F.lit(0.0), q / n - m * m)
        rows.append(F.struct(F.lit(c).alias("column"), n.alias("n"), m.alias("mean"),
                             F.when(F.sqrt(var) == 0, F.lit(1.0)).otherwise(F.sqrt(var)).alias("std")))
    return tot.select(fold, F.explode(F.array(*rows)).alias("s")).select(fold, "s.*")


def fold_medians(df: DataFrame, cols: Sequence[str], fold: str, k: int) -> DataFrame:
    """Medians do not subtract: every row is replicated to the k-1 folds it
    trains (a bounded multiplier) and exact medians are taken per fold."""
    rep = df.select(*cols, F.explode(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col(fold))).alias("__i"))
    q = exact_quantiles(rep, cols, [0.5], by=["__i"])
    return q.select(F.col("__i").cast("int").alias(fold), "column", F.col("value").alias("median"))


# --- K4: one-hot ------------------------------------------------------------

def fit_one_hot(df: DataFrame, col: str, max_levels: int = 1000) -> list:
    """K4: sorted distinct levels.  The level list is a fitted constant; a
    cardinality above ``max_levels`` is refused rather than collected."""
    levels = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{col}: more than {max_levels} levels; not a one-hot column")
    return sorted(levels)


def one_hot_name(col: str, level) -> str:
    return f"{col}_{level}".replace(" ", "_").replace("-", "_").replace("<", "lt").replace(".", "_")


def apply_one_hot(df: DataFrame, col: str, levels: Sequence, drop: bool = True) -> DataFrame:
    """Indicator per fitted level; unseen and NULL levels give all zeros."""
    d = df.withColumns({one_hot_name(col, lv): F.coalesce((F.col(col) == F.lit(lv)).cast("int"), F.lit(0)) for lv in levels})
    return d.drop(col) if drop else d


# --- C5 / K7 -----------------------------------------------------------------

def skew_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness (pandas/DuckDB G1) and min per column,
    one aggregate; Spark's ``skewness`` is the population g1."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        n = F.count(x)
        g1 = F.skewness(x)
        aggs += [(g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias(f"{c}__skew"), F.min(x).alias(f"{c}__min")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__skew").alias("skew"), F.col(f"{c}__min").alias("min")) for c in cols]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def skewed_columns(df: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Columns with |skew| > threshold and min > 0 (log-transform candidates)."""
    return skew_table(df, cols).where((F.abs("skew") > threshold) & (F.col("min") > 0))


@dataclass
class LogBranch:
    """K7 constants: impute -> ln -> standardise on the selected columns."""
    medians: dict
    scale: dict = field(default_factory=dict)


def fit_log_branch(df: DataFrame, cols: Sequence[str]) -> LogBranch:
    med = fit_impute_numeric(df, cols)
    logged = apply_impute(df, med).withColumns({c: log_positive(c) for c in cols})
    return LogBranch(med, fit_standardize(logged, cols))


def apply_log_branch(df: DataFrame, lb: LogBranch, suffix: str = "_log") -> DataFrame:
    d = apply_impute(df, lb.medians)
    d = d.withColumns({c + suffix: (log_positive(c) - F.lit(m)) / F.lit(s) for c, (m, s) in lb.scale.items()})
    return d


# --- K8: column routing -----------------------------------------------------

@dataclass
class Branches:
    """K8 fitted spec: every input column routed to exactly one branch; the
    output column list is metadata, validated at plan time."""
    numeric: dict = field(default_factory=dict)      # col -> (median, mean, std)
    log: dict = field(default_factory=dict)          # col -> (median, mean, std) on ln
    categorical: dict = field(default_factory=dict)  # col -> levels
    passthrough: list = field(default_factory=list)

    def output_names(self) -> list[str]:
        names = [f"num__{c}" for c in self.numeric] + [f"log__{c}" for c in self.log]
        for c, lv in self.categorical.items():
            names += [f"cat__{one_hot_name(c, v)}" for v in lv]
        return names + list(self.passthrough)


def fit_branches(df: DataFrame, numeric: Sequence[str], log: Sequence[str], categorical: Sequence[str],
                 passthrough: Sequence[str] = ()) -> Branches:
    cols_all = list(numeric) + list(log)
    med = fit_impute_numeric(df, cols_all) if cols_all else {}
    imp = apply_impute(df, med)
    logged = imp.withColumns({c: log_positive(c) for c in log})
    st = fit_standardize(logged, cols_all) if cols_all else {}
    return Branches({c: (med[c], *st[c]) for c in numeric}, {c: (med[c], *st[c]) for c in log},
                    {c: fit_one_hot(df, c) for c in categorical}, list(passthrough))


def apply_branches(df: DataFrame, b: Branches) -> DataFrame:
    """One ``select`` producing exactly ``b.output_names()``."""
    out = []
    for c, (md, m, s) in b.numeric.items():
        out.append(((F.coalesce(F.col(c).cast("double"), F.lit(md)) - F.lit(m)) / F.lit(s)).alias(f"num__{c}"))
    for c, (md, m, s) in b.log.items():
        out.append(((log_positive(F.coalesce(F.col(c).cast("double"), F.lit(md))) - F.lit(m)) / F.lit(s)).alias(f"log__{c}"))
    for c, lv in b.categorical.items():
        out += [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"cat__{one_hot_name(c, v)}") for v in lv]
    out += [F.col(c) for c in b.passthrough]
    res = df.select(*out)
    if res.columns != b.output_names():
        raise ValueError("branch output names do not match the fitted spec")
    return res
