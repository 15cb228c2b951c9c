"""Seeded, partition-invariant randomness.

Every "random" decision (splits, folds, permutations, noise, draws) is a
function of a row key and a seed: the md5 of ``"<seed>:<key>"``, first 32
bits as an unsigned integer.  The same value is recomputed on a task retry,
does not depend on partitioning, and DuckDB computes it identically
(``('0x' || substr(md5(...), 1, 8))::BIGINT``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TWO_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_hash(key, seed: int = 42, salt: str | None = None) -> Column:
    """Unsigned 32-bit hash of (seed, [salt], key) as bigint in [0, 2^32)."""
    parts = [F.lit(str(seed))]
    if salt is not None:
        parts.append(F.lit(str(salt)))
    parts.append(_col(key).cast("string"))
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def seeded_uniform(key, seed: int = 42, salt: str | None = None) -> Column:
    """Uniform in [0, 1) derived from :func:`seeded_hash`."""
    return seeded_hash(key, seed, salt) / F.lit(TWO_32)


def sql_seeded_hash(key_sql: str, seed: int = 42, salt: str | None = None) -> str:
    """DuckDB text of :func:`seeded_hash` (used by the oracle SQL)."""
    pre = f"'{seed}:" + (f"{salt}:" if salt is not None else "") + "'"
    return f"('0x' || substr(md5({pre} || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"
