"""Descriptive aggregates and closed-form fits.

Wide statistics are computed for all columns in ONE aggregate job and
unpivoted afterwards (never one job per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.operators.quantiles import exact_quantiles


def _unpivot(row_df: DataFrame, names: Sequence[str], fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Turn one wide aggregate row (per group) with columns ``{name}__{field}``
    into one row per name."""
    structs = [F.struct(F.lit(n).alias("column"), *[F.col(f"{n}__{f}").alias(f) for f in fields]) for n in names]
    return row_df.select(*by, F.explode(F.array(*structs)).alias("__s")).select(*by, "__s.*")


def _wide_quantiles(q: DataFrame, keys: Sequence[str], names: dict) -> DataFrame:
    """(keys, prob, value) rows -> one column per probability."""
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in names.items()])


def agg_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of NULLs per column, only columns with at least one."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols])
    return _unpivot(wide, cols, ["nulls"]).where(F.col("nulls") > 0)


def agg_describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles (linear), max per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    base = _unpivot(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = _wide_quantiles(exact_quantiles(df, cols, [0.25, 0.5, 0.75]), ["column"], {0.25: "p25", 0.5: "p50", 0.75: "p75"})
    return base.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def agg_value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Frequency and proportion of each value (within ``by`` groups)."""
    g = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    return g.withColumn("proportion", F.col("n") / F.sum("n").over(w))


def agg_split_bias(df: DataFrame, stratum: str, strat_flag: str, rand_flag: str) -> DataFrame:
    """Per stratum, population share vs the share inside a stratified and a
    random test set, with relative bias in percent.  One conditional-agg pass."""
    g = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"),
                                F.sum(F.col(strat_flag).cast("long")).alias("n_strat"),
                                F.sum(F.col(rand_flag).cast("long")).alias("n_rand"))
    w = Window.partitionBy(F.lit(1))
    g = (g.withColumn("overall", F.col("n") / F.sum("n").over(w))
          .withColumn("stratified", F.col("n_strat") / F.sum("n_strat").over(w))
          .withColumn("random", F.col("n_rand") / F.sum("n_rand").over(w)))
    return g.select(stratum, "overall", "stratified", "random",
                    (F.lit(100.0) * (F.col("stratified") / F.col("overall") - 1)).alias("strat_err_pct"),
                    (F.lit(100.0) * (F.col("random") / F.col("overall") - 1)).alias("rand_err_pct"))


def agg_group_rate(df: DataFrame, by: str | Sequence[str], target: str) -> DataFrame:
    """E5: mean target and size per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.avg(F.col(target).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))


def column_ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """min/max per column as fitted scalars (one job)."""
    row = df.agg(*[F.min(c).alias(f"{c}__min") for c in cols], *[F.max(c).alias(f"{c}__max") for c in cols]).first()
    return {c: (row[f"{c}__min"], row[f"{c}__max"]) for c in cols}


def histogram_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin index 0..bins-1 over [lo, hi]; the last bin is closed."""
    width = (hi - lo) / bins if hi > lo else 1.0
    return F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def agg_histogram(df: DataFrame, col: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over [min, max] (numpy's convention)."""
    lo, hi = column_ranges(df, [col])[col]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = histogram_bin(F.col(col), lo, hi, bins)
    g = df.where(F.col(col).isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*by, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")


def agg_box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Exact quartiles, 1.5 IQR whiskers and outlier count per category
    (a category holding a third of the rows is still spread over many tasks)."""
    q = _wide_quantiles(exact_quantiles(df, [col], [0.25, 0.5, 0.75], by=[by]), [by], {0.25: "q1", 0.5: "median", 0.75: "q3"})
    n = df.groupBy(by).agg(F.count(F.col(col)).alias("n"))
    q = q.join(n, by).withColumn("lo_whisker", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_whisker", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    outl = df.join(bounded(q.select(by, "lo_whisker", "hi_whisker")), by).groupBy(by).agg(
        F.count_if((F.col(col) < F.col("lo_whisker")) | (F.col(col) > F.col("hi_whisker"))).alias("n_outliers"))
    return q.join(outl, by)


def agg_corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every column pair, one aggregate job, long form."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def agg_ranges(df: DataFrame, cols: Sequence[str], lo_q: float = 0.01, hi_q: float = 0.99) -> DataFrame:
    """Per column min, max, exact p1/p99 and the median (start value)."""
    mm = _unpivot(df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__min") for c in cols],
                         *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in cols]), cols, ["min", "max"])
    q = _wide_quantiles(exact_quantiles(df, cols, [lo_q, 0.5, hi_q]), ["column"], {lo_q: "p_lo", 0.5: "median", hi_q: "p_hi"})
    return mm.join(q, "column", "left").select("column", "min", "p_lo", "median", "p_hi", "max")


def fit_ols_simple(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R² of y on one x (per group)."""
    return df.groupBy(*by).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                               F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                               F.regr_r2(F.col(y), F.col(x)).alias("r2"),
                               F.regr_count(F.col(y), F.col(x)).alias("n"))


def fit_power_law(df: DataFrame, x: str, y: str, by: Sequence[str] = (), at: float | None = None) -> DataFrame:
    """Exponent p and factor k of y = k * x^p by least squares in log-log;
    optional extrapolation to x = ``at``.  Rows with x<=0 or y<=0 are ignored."""
    lx = F.when((F.col(x) > 0) & (F.col(y) > 0), F.log(F.col(x)))
    ly = F.when((F.col(x) > 0) & (F.col(y) > 0), F.log(F.col(y)))
    g = df.groupBy(*by).agg(F.regr_slope(ly, lx).alias("exponent"), F.regr_intercept(ly, lx).alias("__b"),
                            F.regr_count(ly, lx).alias("n"))
    g = g.withColumn("factor", F.exp("__b")).drop("__b")
    if at is not None:
        g = g.withColumn("projected", F.col("factor") * F.pow(F.lit(float(at)), F.col("exponent")))
    return g


def fit_cost_plane(df: DataFrame, x1: str, x2: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Ln y = a ln x1 + b ln x2 + c per group, closed-form solve of the
    3x3 normal equations from centred co-moments (one aggregate)."""
    ok = (F.col(x1) > 0) & (F.col(x2) > 0) & (F.col(y) > 0)
    u, v, w = (F.when(ok, F.log(F.col(c))) for c in (x1, x2, y))
    g = df.groupBy(*by).agg(F.var_pop(u).alias("suu"), F.var_pop(v).alias("svv"), F.covar_pop(u, v).alias("suv"),
                            F.covar_pop(u, w).alias("suw"), F.covar_pop(v, w).alias("svw"),
                            F.avg(u).alias("mu"), F.avg(v).alias("mv"), F.avg(w).alias("mw"),
                            F.count(w).alias("n"))
    det = F.col("suu") * F.col("svv") - F.col("suv") * F.col("suv")
    a = F.try_divide(F.col("suw") * F.col("svv") - F.col("svw") * F.col("suv"), det)
    b = F.try_divide(F.col("svw") * F.col("suu") - F.col("suw") * F.col("suv"), det)
    g = g.withColumn("a", a).withColumn("b", b)
    g = g.withColumn("c", F.col("mw") - F.col("a") * F.col("mu") - F.col("b") * F.col("mv"))
    return g.select(*by, "a", "b", "c", "n")


def project_cost_plane(df: DataFrame, plane: DataFrame, x1: str, x2: str, by: Sequence[str] = (),
                       out: str = "projected") -> DataFrame:
    """Apply E23: exp(a ln x1 + b ln x2 + c) per row.  The plane table has one
    row per group (bounded by the number of groups) and is joined on the
    group key; without groups its three coefficients are literals."""
    if by:
        pl = plane.select(*by, F.col("a").alias("__pa"), F.col("b").alias("__pb"), F.col("c").alias("__pc"))
        d = df.join(bounded(pl), list(by))
        a, b, c = F.col("__pa"), F.col("__pb"), F.col("__pc")
    else:
        r = plane.first()
        d, a, b, c = df, F.lit(r["a"]), F.lit(r["b"]), F.lit(r["c"])
    ok = (F.col(x1) > 0) & (F.col(x2) > 0)          # outside the log domain: no projection
    d = d.withColumn(out, F.when(ok, F.exp(a * F.log(x1) + b * F.log(x2) + c)))
    return d.drop("__pa", "__pb", "__pc") if by else d
