"""Ranges of an order whose number follows the rows.

Two-level sums and positions need every group cut into ranges that one task can sort.
Here the cut points come from mergeable quantile sketches, one per group that is too
large, and every range that is still too large is cut again.  A value that holds too
many rows is a range of its own and is cut along the next key, so that ties do not meet
in one task; the whole order key takes part.  A range is an array of integers: arrays
compare as the order does, inside their group.

Only the largeness of a group decides how often it is cut.  The sketches stay tables;
the driver learns whether a range is left to cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from foldsafe.operators.broadcast import bounded
from foldsafe.session import scratch_path

ROWS_PER_RANGE = 1 << 20
# Cut points of one step are taken from this many quantiles; the sketch's rank error (k) is well below their distance.
_FAN, _SKETCH_K = 1024, 8192
_CHUNK = 6  # bytes of a string that are compared in one step; with their number they fit a double
_NAN, _NULL = 1 << 20, 1 << 21
_MAX_SENT = 4_000_000  # numbers of a table of cut points that is broadcast


@dataclass(frozen=True)
class Key:
    """A column of an order; nulls stand as in Spark (first ascending, last descending) unless said otherwise."""

    name: str
    descending: bool = False
    nulls_last: bool | None = None

    def sort(self) -> Column:
        c, last = F.col(self.name), self.descending if self.nulls_last is None else self.nulls_last
        if self.descending:
            return c.desc_nulls_last() if last else c.desc_nulls_first()
        return c.asc_nulls_last() if last else c.asc_nulls_first()


def as_keys(order: Sequence) -> list[Key]:
    return [k if isinstance(k, Key) else Key(k) for k in order]


def _steps(dtype: T.DataType, c: Column, step: Column, value: Column) -> tuple[Column, Column, bool]:
    """A key's part in a step as a double, whether rows of one ``value`` of it may differ in the next step, and whether the steps tell all values apart."""
    once = F.lit(False)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double") + F.lit(0.0)), once, True
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
        return c.cast("int").cast("double"), once, True
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double"), once, True
    if isinstance(dtype, T.DecimalType):
        return c.cast("double"), once, dtype.precision <= 15
    if isinstance(dtype, (T.LongType, T.TimestampType, T.TimestampNTZType)):
        n = c
        if isinstance(dtype, T.TimestampType):
            n = F.unix_micros(c)
        elif isinstance(dtype, T.TimestampNTZType):
            seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)
            n = F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + (seconds * 1_000_000).cast("long")
        # whole numbers past 2 ** 53 share a double with their neighbours: what it leaves is the second step
        left = n.cast("decimal(20,0)") - n.cast("double").cast("decimal(20,0)")
        return F.when(step == 0, n.cast("double")).otherwise(left.cast("double")), (step == 0) & (F.abs(value) >= 2.0 ** 53), True
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        part = F.substring(c.cast("binary"), step * _CHUNK + 1, F.lit(_CHUNK))
        number = F.conv(F.rpad(F.hex(part), 2 * _CHUNK, "0"), 16, 10).cast("long")
        return (number * 8 + F.octet_length(part)).cast("double"), F.abs(value) % 8 == _CHUNK, True
    raise TypeError(f"an order by {dtype.simpleString()} is not cut into ranges")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Order:
    """The step of every row's key that its range is cut by (``__r_key``, ``__r_step``), and what follows a step."""

    def __init__(self, schema: T.StructType, keys: Sequence[Key]):
        self.keys = keys
        self.steps = [_steps(schema[k.name].dataType, F.col(k.name), F.col("__r_step"), F.col("__r_x")) for k in keys]

    def part(self) -> Column:
        """The value of the step, ascending in the order; null where the key is null or not a number."""
        out = F.lit(None).cast("double")
        for i, (k, (x, _, _)) in enumerate(zip(self.keys, self.steps)):
            out = F.when(F.col("__r_key") == i, F.lit(0.0) - x if k.descending else x).otherwise(out)
        return out

    def outside(self) -> Column:
        """The place of rows without a value: far before or behind the others."""
        out = F.lit(0)
        for i, k in enumerate(self.keys):
            last = k.descending if k.nulls_last is None else k.nulls_last
            place = F.when(F.col(k.name).isNull(), _NULL if last else -_NULL).otherwise(-_NAN if k.descending else _NAN)
            out = F.when(F.col("__r_key") == i, place).otherwise(out)
        return out

    def following(self) -> tuple[Column, Column]:
        """Key and step by which the range ``__r_cut`` of rows ``__r_x`` is cut next; one past the last key: no more."""
        at, step, cut = F.col("__r_key"), F.col("__r_step"), F.col("__r_cut")
        value = (cut >= 0) & (cut <= 2 * _FAN)
        mixed = value & (cut % 2 == 0)
        more, stop = F.lit(False), F.lit(False)
        for i, (_, goes_on, exact) in enumerate(self.steps):
            more = F.when(at == i, value & goes_on).otherwise(more)
            stop = F.when(at == i, value & ~mixed & F.lit(not exact)).otherwise(stop)
        key = F.when(mixed | more, at).when(stop, len(self.keys)).otherwise(at + 1)
        return key, F.when(mixed, step).when(more, step + 1).otherwise(0)


def _below(points: Column, x: Column) -> Column:
    """How many of at most _FAN - 1 sorted points are below ``x``."""
    halves = F.array(*[F.lit(_FAN >> i) for i in range(1, _FAN.bit_length())])
    return F.aggregate(halves, F.lit(0), lambda n, h: F.when(F.get(points, n + h - 1) < x, n + h).otherwise(n))


def _cut_points(here: DataFrame, out: str, limit: int) -> DataFrame:
    """``__r_points`` of every open range: quantiles of a sketch, as many as its rows ask for."""
    quantiles = F.kll_sketch_get_quantile_double("__r_sketch", F.expr(f"array({', '.join(f'{i / _FAN}D' for i in range(1, _FAN))})"))
    every = F.greatest(F.least(F.floor(F.lit(_FAN * limit // 2) / F.col("__r_n")), F.lit(_FAN // 2)), F.lit(1))
    points = F.array_distinct(F.filter(F.when(F.col("__r_n") > 0, quantiles), lambda _, i: (i + 1) % F.col("__r_every") == 0))
    return (here.groupBy("__r_group", out, "__r_key", "__r_step")
            .agg(F.kll_sketch_agg_double("__r_x", F.lit(_SKETCH_K)).alias("__r_sketch"), F.count("__r_x").alias("__r_n"))
            .withColumn("__r_every", every)
            .select("__r_group", out, "__r_key", "__r_step", F.coalesce(points, F.array().cast("array<double>")).alias("__r_points")))


def elastic_ranges(df: DataFrame, group_cols: Sequence[str], order: Sequence, out: str = "__range",
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``df`` with ``out``, an array of integers that grows with the order inside the group and holds at most ``rows_per_range`` rows.

    Rows that are equal in all keys share a range, whatever their number, as do those of
    a decimal key of over 15 digits that differ only beyond a double's precision (keys
    after it take no part then).  Groups may hold nulls; an empty table stays empty.  Rows
    of groups that are cut are written and read again, once a step; others are not.
    """
    keys, none = as_keys(order), F.array().cast("array<int>")
    plan = _Order(df.schema, keys)
    group = F.struct(*[F.col(c) for c in group_cols]) if group_cols else F.struct(F.lit(0).alias("all"))
    rows = df.withColumn("__r_group", group).withColumn(out, none)
    large = rows.groupBy("__r_group").agg(F.count(F.lit(1)).alias("__r_n")).where(F.col("__r_n") > rows_per_range)
    state = _written(large.select("__r_group", none.alias(out), F.lit(0).alias("__r_key"), F.lit(0).alias("__r_step")), "ranges")
    done = None
    while not state.isEmpty():
        at = ["__r_group", out]
        rest = rows.join(bounded(state.select(*at)), at, "left_anti").select(*df.columns, out)
        done = rest if done is None else done.unionByName(rest)
        points = _written(_cut_points(rows.join(bounded(state), at).withColumn("__r_x", plan.part()), out, rows_per_range), "cut-points")
        sent = points.agg(F.sum(F.size("__r_points") + 8)).first()[0] <= _MAX_SENT
        x, below = F.col("__r_x"), _below(F.col("__r_points"), F.col("__r_x"))
        cut = F.when(x.isNull(), plan.outside()).otherwise(2 * below + F.coalesce(F.get("__r_points", below) == x, F.lit(False)).cast("int"))
        split = rows.join(F.broadcast(points) if sent else points, at).withColumn("__r_x", plan.part()).withColumn("__r_cut", cut.cast("int"))
        split = _written(split.withColumn(out, F.concat(out, F.array("__r_cut"))).drop("__r_points"), "ranged-rows")
        same = [F.first(c).alias(c) for c in ("__r_key", "__r_step", "__r_cut", "__r_x")]  # equal in a range, but for mixed values
        sizes = split.groupBy(*at).agg(F.count(F.lit(1)).alias("__r_n"), *same).where(F.col("__r_n") > rows_per_range)
        key, step = plan.following()
        state = _written(sizes.select(*at, key.alias("__r_next"), step.alias("__r_step")).withColumnRenamed("__r_next", "__r_key")
                         .where(F.col("__r_key") < len(keys)), "ranges")
        rows = split.drop("__r_key", "__r_step", "__r_cut", "__r_x")
    last = rows.select(*df.columns, out)
    return last if done is None else done.unionByName(last)
