"""Registered queries: sources and sinks (A1-A11).  Each query writes data
Spark derives from the driver tables to the shared folder, reads it back
through the operator and returns what was read."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from foldsafe.functions.scalars import category_index, quantize_vector
from foldsafe.sources import archives as AR
from foldsafe.sources import files as FS
from foldsafe.sources import registry as RG
from foldsafe.operators.broadcast import bounded
from foldsafe.operators.splits import split_random
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, SQL_RUNS, districts, runs
from foldsafe.plans.sqlutil import random_split_sql
from foldsafe.plans.q_scalars import PRIORITY_ORDER
from foldsafe.session import read_table, scratch_path

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _out(spark, sf, name):
    return scratch_path(spark, f"{name}-{FS.tag(os.path.abspath(sf))}")


@register("src_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_a1(spark, sf):
    path = _out(spark, sf, "csv-customer")
    FS.write_csv(read_table(spark, sf, "customer"), path)
    return FS.read_csv(spark, path, CUSTOMER_SCHEMA)


@register("src_cached_ingest", """
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_a2(spark, sf):
    def build():
        n, r = read_table(spark, sf, "nation"), read_table(spark, sf, "region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return FS.cached_ingest(spark, build, f"nation-region-{FS.tag(os.path.abspath(sf))}")


@register("src_parquet", f"""WITH {SQL_DISTRICTS}, {random_split_sql('districts', 'row_id', 0.2, 42)}
SELECT row_id, round(target, 9) AS target, is_test FROM districts_rsplit WHERE is_test = 1""")
def q_a3(spark, sf):
    path = _out(spark, sf, "split-parquet")
    d = split_random(districts(spark, sf), "row_id", 0.2, 42).select("row_id", F.round("target", 9).alias("target"), "is_test")
    FS.write_parquet(d, path, partition_by=["is_test"])
    return spark.read.parquet(path).where("is_test = 1").select("row_id", "target", F.col("is_test").cast("int").alias("is_test"))


@register("src_archive_members", """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size, CAST(length(text) AS INTEGER) AS n_chars FROM documents""")
def q_a4(spark, sf):
    root = _published(spark, sf, "archives", lambda out: AR.write_archives(
        read_table(spark, sf, "documents"), "doc_id", "text", out, n_archives=4))
    m = AR.read_archive_members(spark, os.path.join(root, "*.tar.gz"))
    return m.select(F.regexp_extract("member", r"(\d+)\.txt$", 1).cast("bigint").alias("doc_id"), "size",
                    F.length("text").cast("int").alias("n_chars"))


def _published(spark, sf, name, build) -> str:
    """Build a fixture folder once: write into a fresh sub-folder, then publish
    its name in a marker file, so a crashed build is never read half-done."""
    root = _out(spark, sf, name)
    marker = os.path.join(AR.local_path(root), "_PUBLISHED")
    if os.path.exists(marker):
        with open(marker) as f:
            return os.path.join(root, f.read().strip())
    sub = uuid.uuid4().hex
    build(os.path.join(root, sub))
    tmp = marker + "." + sub
    with open(tmp, "w") as f:
        f.write(sub)
    os.replace(tmp, marker)
    return os.path.join(root, sub)


@register("src_labelled_tree", """
SELECT l.doc_id, CAST(l.toxic AS INTEGER) AS label, CAST(strlen(d.text) AS BIGINT) AS size
FROM labels l JOIN documents d USING (doc_id)""")
def q_a5(spark, sf):
    def build(out):
        lab = read_table(spark, sf, "labels").join(read_table(spark, sf, "documents"), "doc_id")
        AR.write_labelled_tree(lab, "doc_id", "text", "toxic", out)
    root = _published(spark, sf, "tree", build)
    t = AR.read_labelled_tree(spark, root).where(F.col("name").endswith(".eml"))
    return t.select(F.regexp_extract("name", r"^(\d+)", 1).cast("bigint").alias("doc_id"),
                    F.col("label").cast("int").alias("label"), "size")


@register("src_dense_matrix", """
WITH q AS (SELECT CAST(label AS INTEGER) AS label,
                  list_transform(embedding, lambda x: CAST(greatest(0, least(255, round((x + 1.0) / 2.0 * 255))) AS SMALLINT)) AS px FROM embeddings)
SELECT label, count(*) AS n, CAST(min(list_min(px)) AS SMALLINT) AS px_min, CAST(max(list_max(px)) AS SMALLINT) AS px_max,
       CAST(min(len(px)) AS INTEGER) AS dim FROM q GROUP BY label""")
def q_a6(spark, sf):
    e = read_table(spark, sf, "embeddings").select(F.col("label").cast("int").alias("label"), quantize_vector("embedding").alias("px"))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min(F.array_min("px")).alias("px_min"),
                                  F.max(F.array_max("px")).alias("px_max"), F.min(F.size("px")).cast("int").alias("dim"))


@register("sink_registry", f"""WITH {SQL_RUNS}
SELECT kernel AS experiment, count(*) AS n_runs, CAST(count_if(status = 'FINISHED') AS BIGINT) AS n_finished, round(sum(seconds), 4) AS seconds
FROM runs GROUP BY kernel""")
def q_a7(spark, sf):
    reg = _logged_searches(spark, sf)
    nested = reg.read().where("parent_run_id is not null")
    return nested.groupBy("experiment").agg(F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("status") == "FINISHED").alias("n_finished"),
                                            F.round(F.sum(F.col("metrics")["seconds"]), 4).alias("seconds"))


def _logged_searches(spark, sf) -> RG.Registry:
    """Every search as a run of its own, its candidates as nested runs, in a registry of this call."""
    reg = RG.Registry(spark, _out(spark, sf, f"registry-{uuid.uuid4().hex}"))
    r = runs(spark, sf).withColumn("search", F.concat_ws(":", "kernel", "search_id"))
    reg.append(RG.as_runs(r, F.col("kernel"), F.col("run_id"), F.col("status"), ["c", "gamma"], ["cv_rmse", "seconds"], F.col("search")))
    whole = r.groupBy("kernel", "search").agg(F.min("cv_rmse").alias("cv_rmse"), F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("n_candidates"),
                                              F.bool_and(F.col("status") == "FINISHED").alias("all"))
    status = F.when(F.col("all"), "FINISHED").otherwise("FAILED")
    reg.append(RG.as_runs(whole, F.col("kernel"), F.col("search"), status, ["n_candidates"], ["cv_rmse", "seconds"]))
    return reg


@register("registry_best_runs", f"""WITH {SQL_RUNS},
p AS (SELECT kernel, kernel || ':' || search_id AS run_id, bool_and(status = 'FINISHED') AS fin, min(cv_rmse) AS best, count(*) AS n_candidates FROM runs GROUP BY ALL),
b AS (SELECT kernel, arg_min(run_id, (best, run_id)) AS run_id, min(best) AS cv_rmse, count(*) AS n_runs FROM p WHERE fin AND best IS NOT NULL GROUP BY kernel),
k AS (SELECT kernel, kernel || ':' || search_id AS run_id, arg_min(CAST(run_id AS VARCHAR), (cv_rmse, CAST(run_id AS VARCHAR))) AS candidate FROM runs
      WHERE status = 'FINISHED' AND cv_rmse IS NOT NULL GROUP BY ALL)
SELECT b.kernel AS experiment, run_id, round(cv_rmse, 6) AS cv_rmse, n_runs, n_candidates, candidate, c
FROM b JOIN p USING (kernel, run_id) JOIN k USING (kernel, run_id) JOIN (SELECT CAST(run_id AS VARCHAR) AS candidate, c FROM runs) USING (candidate)""")
def q_registry_best(spark, sf):
    """C3 on nested runs: the best search of each experiment, its candidates apart, and the best candidate in it."""
    log = _logged_searches(spark, sf).read()
    best = RG.best_runs(log, "cv_rmse").withColumn("n_candidates", F.col("params")["n_candidates"].cast("long")).drop("parent_run_id", "params")
    inner = log.join(bounded(best.select(F.col("run_id").alias("parent_run_id"))), "parent_run_id", "left_semi")
    cand = RG.best_runs(inner, "cv_rmse", nested=True)
    c = F.try_element_at("params", F.lit("c")).cast("double")
    return best.join(cand.select("experiment", F.col("run_id").alias("candidate"), c.alias("c")), "experiment").select(
        "experiment", "run_id", F.round("cv_rmse", 6).alias("cv_rmse"), "n_runs", "n_candidates", "candidate", "c")


@register("sink_atomic_state", f"""WITH {SQL_RUNS}
SELECT kernel, count(*) AS n, round(min(cv_rmse), 6) AS best FROM runs GROUP BY kernel""")
def q_a8(spark, sf):
    """Candidates are committed in batches; after a restart the state is read, only the
    candidates that it lacks are added, and the whole is put in its place as one commit."""
    path, schema = _out(spark, sf, f"state-{uuid.uuid4().hex}"), "kernel string, run_id long, cv_rmse double"
    r = runs(spark, sf)
    RG.Registry(spark, path, schema).append(r.where(F.crc32("kernel") % 2 == 0))
    state = RG.Registry(spark, path, schema)
    version = state.append(r.join(bounded(state.read().select("kernel").distinct()), "kernel", "left_anti"))
    state.replace(state.read(version), version)
    return state.read().groupBy("kernel").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("cv_rmse"), 6).alias("best"))


@register("sink_row_arrays", f"""WITH {SQL_DISTRICTS}
SELECT [round(CAST(doy AS DOUBLE), 3), round(acctbal, 3), round(target, 3),
        CAST(list_position({PRIORITY_ORDER!r}, priority) - 1 AS DOUBLE)] AS row FROM districts""")
def q_a9(spark, sf):
    path = _out(spark, sf, "row-arrays")
    d = districts(spark, sf).withColumn("priority_idx", category_index("priority", PRIORITY_ORDER))
    FS.row_arrays(d, ["doy", "acctbal", "target", "priority_idx"]).write.mode("overwrite").json(path)
    return spark.read.schema("row array<double>").json(path)


@register("sink_csv_predictions", f"""WITH {SQL_DISTRICTS}
SELECT row_id, round(target * 100000.0, 2) AS pred_usd FROM districts""")
def q_a10(spark, sf):
    path = _out(spark, sf, "pred-csv")
    d = districts(spark, sf).select("row_id", F.round(F.col("target") * 100000.0, 2).alias("pred_usd"))
    FS.write_csv(d, path)
    return FS.read_csv(spark, path, "row_id bigint, pred_usd double")


@register("src_optional_columns", """
SELECT c_custkey, c_acctbal, CAST(NULL AS DOUBLE) AS c_bonus, true AS has_c_acctbal, false AS has_c_bonus FROM customer""")
def q_a11(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return FS.with_optional(c, ["c_acctbal", "c_bonus"]).select("c_custkey", "c_acctbal", "c_bonus", "has_c_acctbal", "has_c_bonus")
