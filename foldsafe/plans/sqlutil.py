"""Helpers shared by the oracle SQL texts."""

from foldsafe.functions.keys import sql_seeded_hash


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


def stratified_split_sql(src: str, key: str, stratum: str, frac: float = 0.2, seed: int = 42,
                         out: str = "is_test") -> str:
    """CTE text: exact stratified split (largest remainder), as ``{src}_split``."""
    h = sql_seeded_hash(key, seed)
    return f"""{src}_q0 AS (SELECT {stratum}, count(*) AS c FROM {src} GROUP BY {stratum}),
{src}_q1 AS (SELECT {stratum}, c, sum(c) OVER () AS n, ceil(sum(c) OVER () * {frac}) AS t FROM {src}_q0),
{src}_q2 AS (SELECT *, t * c / n AS ex, floor(t * c / n) AS fl FROM {src}_q1),
{src}_q3 AS (SELECT *, t - sum(fl) OVER () AS lft,
                    row_number() OVER (ORDER BY ex - fl DESC, {stratum} ASC NULLS FIRST) AS rk FROM {src}_q2),
{src}_quota AS (SELECT {stratum}, fl + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS quota FROM {src}_q3),
{src}_pos AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY {h}, {key}) - 1 AS __pos FROM {src}),
{src}_split AS (SELECT p.* EXCLUDE (__pos), CAST(p.__pos < q.quota AS INTEGER) AS {out}
                FROM {src}_pos p JOIN {src}_quota q ON p.{stratum} IS NOT DISTINCT FROM q.{stratum})"""


def random_split_sql(src: str, key: str, frac: float = 0.2, seed: int = 42, out: str = "is_test") -> str:
    h = sql_seeded_hash(key, seed)
    return f"""{src}_rsplit AS (SELECT * EXCLUDE (__pos, __n), CAST(__pos < ceil(__n * {frac}) AS INTEGER) AS {out}
  FROM (SELECT *, row_number() OVER (ORDER BY {h}, {key}) - 1 AS __pos, count(*) OVER () AS __n FROM {src}))"""


def kfold_sql(src: str, key: str, k: int = 5, seed: int = 42, out: str = "fold", order: str | None = None) -> str:
    o = order if order else f"{sql_seeded_hash(key, seed)}, {key}"
    return f"""{src}_kf AS (SELECT * EXCLUDE (__pos, __n, __q, __r),
   CAST(CASE WHEN __pos < __r * (__q + 1) THEN floor(__pos / (__q + 1))
             ELSE __r + floor((__pos - __r * (__q + 1)) / __q) END AS INTEGER) AS {out}
  FROM (SELECT *, floor(__n / {k}) AS __q, __n - floor(__n / {k}) * {k} AS __r
        FROM (SELECT *, row_number() OVER (ORDER BY {o}) - 1 AS __pos, count(*) OVER () AS __n FROM {src})))"""
