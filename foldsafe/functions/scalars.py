"""Projections and scalar functions.

All of them are plain Catalyst expressions: they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foldsafe.functions.keys import seeded_hash

USD_PER_UNIT = 100_000.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- B1 / B2 / B3 -----------------------------------------------------------

def safe_ratio(num, den) -> Column:
    """a / b with NULL instead of an ANSI error or inf when b = 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def derive_ratios(df: DataFrame, ratios: Mapping[str, tuple]) -> DataFrame:
    """B1/B2: add ``name = num / den`` columns (NULL on a zero denominator)."""
    return df.withColumns({k: safe_ratio(n, d) for k, (n, d) in ratios.items()})


def to_model_units(c) -> Column:
    """USD -> model units (÷ 100,000)."""
    return _c(c) / F.lit(USD_PER_UNIT)


def to_usd(c) -> Column:
    """Model units -> USD (× 100,000)."""
    return _c(c) * F.lit(USD_PER_UNIT)


# --- B4 / B7 / B8 / B10: vectors -------------------------------------------

def vector_scale(v, divisor: float = 255.0) -> Column:
    """Divide every element by ``divisor`` (double result)."""
    return F.transform(_c(v), lambda x: x.cast("double") / F.lit(divisor))


def narrow_vector(v, to: str = "smallint") -> Column:
    """Narrow element type (``smallint`` storage, ``float`` compute)."""
    return F.transform(_c(v), lambda x: x.cast(to))


def quantize_vector(v, lo: float = -1.0, hi: float = 1.0, levels: int = 255) -> Column:
    """Map floats in [lo, hi] to integers 0..levels (clipped), smallint."""
    span = hi - lo
    return F.transform(
        _c(v),
        lambda x: F.greatest(F.lit(0), F.least(F.lit(levels), F.round((x.cast("double") - F.lit(lo)) / F.lit(span) * F.lit(levels)).cast("int"))).cast("smallint"),
    )


def noise_clip(v, key, seed: int = 42, modulus: int = 100, hi: int = 255) -> Column:
    """Add deterministic integer noise U{0..modulus-1} per element, clip to [0, hi].

    The noise is a seeded hash of (row key, element index): identical on a
    task retry, unlike ``rand()``.
    """
    return F.transform(
        _c(v),
        lambda x, i: F.least(
            F.lit(hi),
            x.cast("int") + F.pmod(seeded_hash(F.concat_ws("/", _c(key).cast("string"), i.cast("string")), seed), F.lit(modulus)).cast("int"),
        ),
    )


def shift_matrix(v, dy: int, dx: int, h: int, w: int) -> Column:
    """Shift a flattened h×w matrix by (dy, dx) with zero fill."""
    def pick(i):
        r = F.floor(i / F.lit(w)).cast("int")
        c = F.pmod(i, F.lit(w))
        sr, sc = r - F.lit(dy), c - F.lit(dx)
        inside = (sr >= 0) & (sr < h) & (sc >= 0) & (sc < w)
        return F.when(inside, F.element_at(_c(v), (sr * F.lit(w) + sc + F.lit(1)).cast("int"))).otherwise(F.lit(0).cast("float"))
    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), pick)


# --- B5 / B6 / B9 / B11-B14 -------------------------------------------------

# The right-closed income-band edges used for stratification.
DEFAULT_BAND_EDGES = (0.0, 1.5, 3.0, 4.5, 6.0)


def cut_bins(c, edges: Sequence[float] = DEFAULT_BAND_EDGES, open_top: bool = True) -> Column:
    """Right-closed bins (e0,e1] -> 1, (e1,e2] -> 2, ...; (e_last, inf) -> len(edges).

    A value <= e0 (or NULL) gives NULL.  Not ``Bucketizer``: that one is
    left-closed.
    """
    x = _c(c)
    expr = None
    for i in range(1, len(edges)):
        cond = (x > F.lit(edges[i - 1])) & (x <= F.lit(edges[i]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    if open_top:
        expr = expr.when(x > F.lit(edges[-1]), F.lit(len(edges)))
    return expr


def binary_label(cond: Column) -> Column:
    """Boolean predicate as an int 0/1 label."""
    return cond.cast("int")


def clip(c, lo, hi) -> Column:
    """Clamp to [lo, hi] (NULL stays NULL)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.greatest(lo_c, F.least(hi_c, _c(c)))


def residual_columns(pred, real) -> dict[str, Column]:
    """err = pred - real, abs_err, sq_err."""
    e = _c(pred) - _c(real)
    return {"err": e, "abs_err": F.abs(e), "sq_err": e * e}


def log_positive(c) -> Column:
    """ln(x) for x > 0, NULL otherwise."""
    x = _c(c)
    return F.when(x > 0, F.log(x))


def finite_or_null(c) -> Column:
    """NaN and ±inf become NULL (Spark treats NaN as a value)."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def null_policy(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B13 on many columns at once."""
    return df.withColumns({c: finite_or_null(c) for c in cols})


def allow_list(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Project to an allow-list (identifiers and after-the-fact columns never pass)."""
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise ValueError(f"allow-list columns missing: {missing}")
    return df.select(*keep)


# --- B20-B23 ----------------------------------------------------------------

def candidate_key(params: Sequence[str]) -> Column:
    """Canonical id of a parameter set: ``name=value`` pairs sorted by name.

    Doubles are printed with ``format_string('%s')``, NULL as ``null``.
    """
    pairs = [F.concat(F.lit(p + "="), F.coalesce(F.col(p).cast("string"), F.lit("null"))) for p in sorted(params)]
    return F.concat_ws("|", *pairs)


def strip_param_prefix(m, prefix: str = "model__") -> Column:
    """Drop a prefix from every map key."""
    return F.transform_keys(_c(m), lambda k, v: F.regexp_replace(k, "^" + prefix, ""))


def category_index(c, levels: Sequence[str]) -> Column:
    """Position of a category in a fixed order (0-based), NULL if unknown."""
    pos = F.array_position(F.array(*[F.lit(x) for x in levels]), _c(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def round_half_up(c, digits: int) -> Column:
    """HALF_UP rounding (Spark ``round``)."""
    return F.round(_c(c), digits)
