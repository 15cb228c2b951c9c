"""Elastic ranges: in the order's order, small however many rows tie, and of no effect on any answer."""

import datetime as dt
import decimal
import random
from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from foldsafe.operators import curves, filters
from foldsafe.operators.positions import group_rank, ordered_positions, ordered_sum
from foldsafe.operators.ranges import Key, elastic_ranges
from foldsafe.session import read_table
from tests.conftest import MEDIUM

LIMIT = 20


def check(spark, df, group, order, limit=LIMIT, largest=None):
    """No row lost, ranges ascend with the order in each group, none passes the limit; returns the number of ranges by group."""
    keys = [k if isinstance(k, Key) else Key(k) for k in order]
    w = Window.partitionBy(*[F.col(c) for c in group]).orderBy(*[k.sort() for k in keys])
    got = elastic_ranges(df, group, order, "r", limit).withColumn("ok", F.coalesce(F.lag("r").over(w) <= F.col("r"), F.lit(True))).collect()
    assert Counter(repr(tuple(r)[:-2]) for r in got) == Counter(repr(tuple(r)) for r in df.collect())
    assert all(r["ok"] for r in got)
    sizes = Counter((tuple(r[c] for c in group), tuple(r["r"])) for r in got)
    assert max(sizes.values()) <= (largest or limit)
    return Counter(g for g, _ in sizes)


VALUES = {
    "double": [0.0, -0.0, 1.5, -2.5, float("inf"), -float("inf"), float("nan"), None],
    "float": [0.5, float("nan"), None, -3.25],
    "long": [2 ** 53, 2 ** 53 + 1, -(2 ** 63), 2 ** 63 - 1, 0, None, -1],
    "int": [1, 2, None, -(2 ** 31)],
    "boolean": [True, False, None],
    "string": ["", "a", "a\0", "abcdef", "abcdef\0", "abcdefg", "abcdefghijklm", "abcdefghijkln", "é", "z" * 40, "z" * 41, None],
    "date": [dt.date(1960, 1, 1), dt.date(2024, 2, 29), None],
    "timestamp_ntz": [dt.datetime(1960, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 1, 1, 23, 59, 59, 999999), dt.datetime(2024, 1, 1, 23, 59, 59, 999998), None],
    "decimal(12,2)": [decimal.Decimal("1.25"), decimal.Decimal("-7.00"), None],
    "binary": [b"", b"\xff\xfe", b"\x00", None],
}


@pytest.mark.parametrize("kind,descending", [*((k, i % 2 == 1) for i, k in enumerate(sorted(VALUES))), ("double", True), ("string", True)])
def test_every_type_in_both_directions(spark, kind, descending):
    """Few values, many ties: only the second key tells the rows of one value apart."""
    rng = random.Random(kind)
    rows = [(i, rng.choice(VALUES[kind])) for i in range(60 * len(VALUES[kind]))]
    df = spark.createDataFrame(rows, f"id long, v {kind}").coalesce(2)
    check(spark, df, [], [Key("v", descending, not descending if kind in ("double", "string") else None), "id"])


def test_a_hot_group_is_many_ranges_and_small_groups_are_one(spark):
    rows = [(None if i % 3 == 0 else i % 50, 5.0 if i % 2 else float(i % 7), f"run-{i:06d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "g long, cost double, run string").repartition(4)
    n = check(spark, df, ["g"], ["cost", "run"], 40)
    assert n[None,] >= 500 / 40 and all(v == 1 for k, v in n.items() if k != (None,))
    # the number follows the rows
    assert check(spark, df, ["g"], ["cost", "run"], 10)[None,] > 2 * n[None,]
    assert set(check(spark, df, ["g"], ["cost", "run"], 10 ** 6, 1500).values()) == {1}


def test_equal_rows_and_keys_without_double_precision(spark):
    df = spark.createDataFrame([(1, "x")] * 90 + [(2, "y")] * 5, "a int, b string")
    check(spark, df, [], ["a", "b"], 20, largest=90)
    wide = spark.createDataFrame([(decimal.Decimal(10 ** 30 + i % 4), i) for i in range(100)], "d decimal(38,0), i int")
    check(spark, wide, [], ["d", "i"], 20, largest=100)
    assert elastic_ranges(df.limit(0), ["b"], ["a"]).isEmpty()
    with pytest.raises(TypeError):
        elastic_ranges(df.select(F.array("a").alias("a")), [], ["a"])


@pytest.mark.parametrize("limit", [50, 10 ** 6])
def test_answers_do_not_depend_on_the_ranges(spark, limit):
    e = read_table(spark, MEDIUM, "events").select("event_id", "event_type", F.round("value", 0).alias("value"), "user_id").withColumn(
        "g", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") % 5 + 1))
    w = Window.partitionBy("g").orderBy("value", F.desc("event_id"))
    ref = {r["event_id"]: r for r in e.select("event_id", (F.row_number().over(w) - 1).alias("pos"), F.rank().over(
        Window.partitionBy("g").orderBy("value")).alias("rank"), F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sum")).collect()}
    order = ["value", Key("event_id", descending=True)]
    pos = ordered_positions(e, order, ["g"], total_out="n", rows_per_range=limit).collect()
    assert len(pos) == len(ref) and all(r["pos"] == ref[r["event_id"]]["pos"] for r in pos)
    total = ordered_sum(e, ["g"], order, "value", "s", limit).collect()
    assert len(total) == len(ref) and all(abs(r["s"] - ref[r["event_id"]]["sum"]) < 1e-6 for r in total)
    rank = group_rank(e, ["g"], "value", rows_per_range=limit).collect()
    assert len(rank) == len(ref) and all(r["rank"] == ref[r["event_id"]]["rank"] for r in rank)


def test_curve_counts_at_any_number_of_ranges(spark):
    e = read_table(spark, MEDIUM, "events").select("value", (F.col("event_type") == "purchase").cast("int").alias("label"))
    st = curves.score_table(e, "value", "label").cache()
    whole, cut = (sorted(tuple(r) for r in curves.suffix_counts(st, n).collect()) for n in (10 ** 6, 37))
    assert whole == cut and max(r[3] for r in whole) == e.where("label = 1").count()


def test_one_search_of_equal_costs(spark):
    """A third of all runs are one search, and all of its runs cost the same."""
    rows = [("hot", i, 1.0) if i % 3 == 0 else (f"s{i % 11}", i, float(i % 4)) for i in range(900)]
    df = spark.createDataFrame(rows, "search_id string, run_id long, seconds double")
    check(spark, df, ["search_id"], ["seconds", "run_id"], 30)
    got = {r["run_id"]: r for r in filters.budget_cutoff(df, "seconds", 100.0, rows_per_range=30).collect()}
    assert len(got) == 900 and all(got[i]["clock"] == i // 3 + 1 and got[i]["inside_cap"] == (i // 3 + 1 <= 100) for i in range(0, 900, 3))
