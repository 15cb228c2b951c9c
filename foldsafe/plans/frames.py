"""Stand-in frames derived from the driver tables, in Spark and in DuckDB SQL.

* ``districts``: the regression table (orders joined to customer): row key,
  numeric features with constructed missing values, two categoricals and a
  target in model units.
* ``runs``: a run registry (events as measured runs of many searches).
* ``points``: 2-D coordinates and a label from the embeddings table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldsafe.functions.scalars import cut_bins, to_model_units
from foldsafe.operators.splits import split_random
from foldsafe.session import read_table, scratch_path

# Every 97th order has its balance missing (constructed NULLs,
# identical in the oracle).
MISSING_EVERY = 97


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                                    "o_orderpriority", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    d = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return d.select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_orderkey") % MISSING_EVERY == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.dayofyear("o_orderdate").cast("int").alias("doy"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("c_nationkey").cast("int").alias("nation"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"),
        to_model_units("o_totalprice").alias("target"),
    )


def districts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``districts`` with a fifth flagged ``is_test``, written to the shared folder: learners
    read it many times, and would join and rank all rows anew each time."""
    d = split_random(districts(spark, sf_dir), "row_id", 0.2, 42)
    path = scratch_path(spark, f"districts-{uuid.uuid4().hex}")
    d.write.parquet(path)
    return spark.read.schema(d.schema).parquet(path)


def districts_banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return districts(spark, sf_dir).withColumn("band", cut_bins("target"))


SQL_DISTRICTS = f"""districts AS (
  SELECT o.o_orderkey AS row_id,
         CASE WHEN o.o_orderkey % {MISSING_EVERY} = 0 THEN NULL ELSE c.c_acctbal END AS acctbal,
         CAST(dayofyear(o.o_orderdate) AS INTEGER) AS doy,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(c.c_nationkey AS INTEGER) AS nation,
         o.o_orderpriority AS priority,
         c.c_mktsegment AS segment,
         o.o_orderstatus AS status,
         o.o_totalprice / 100000.0 AS target
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def sql_cut_bins(x: str, edges=(0.0, 1.5, 3.0, 4.5, 6.0)) -> str:
    parts = [f"WHEN {x} > {edges[i - 1]} AND {x} <= {edges[i]} THEN {i}" for i in range(1, len(edges))]
    parts.append(f"WHEN {x} > {edges[-1]} THEN {len(edges)}")
    return "CASE " + " ".join(parts) + " END"


SQL_BANDED = SQL_DISTRICTS + f""",
banded AS (SELECT *, {sql_cut_bins('target')} AS band FROM districts)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a run registry: a search per user, a run per event.

    kernel = event type, C = the ``k`` property, gamma = (hour + 1) / 10,
    seconds = value, status FAILED for error events, cv_rmse derived
    deterministically from the value."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("search_id"),
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("kernel"),
        F.get_json_object("props", "$.k").cast("double").alias("c"),
        ((F.hour("ts") + 1) / F.lit(10.0)).alias("gamma"),
        F.col("value").alias("seconds"),
        F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("FINISHED")).alias("status"),
        (F.lit(0.4) + F.pmod(F.col("value") * 100, F.lit(37.0)) / F.lit(100.0)).alias("cv_rmse"),
        F.col("ts"),
    )


SQL_RUNS = """runs AS (
  SELECT user_id AS search_id, event_id AS run_id, event_type AS kernel,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS c,
         (hour(ts) + 1) / 10.0 AS gamma,
         value AS seconds,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
         0.4 + fmod(value * 100, 37.0) / 100.0 AS cv_rmse,
         ts
  FROM events)"""
