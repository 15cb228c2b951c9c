"""Registered queries: projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.functions import scalars as S
from foldsafe.functions.keys import sql_seeded_hash
from foldsafe.operators.prep import skewed_columns
from foldsafe.operators.quantiles import exact_quantile_dict
from foldsafe.plans.catalog import register
from foldsafe.plans.frames import SQL_DISTRICTS, districts, sql_cut_bins
from foldsafe.session import read_table

# The 8x8 view of a 64-element embedding and its quantisation range.
SIDE = 8
QLO, QHI = -1.0, 1.0
QSQL = "CAST(greatest(0, least(255, round((x - (-1.0)) / 2.0 * 255))) AS SMALLINT)"


def _li(spark, sf):
    return read_table(spark, sf, "lineitem")


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings")


@register("prj_rename_derive", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS line,
       round(CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END, 6) AS unit_price,
       round(l_extendedprice * (1 - l_discount) / 100000.0, 9) AS net_units
FROM lineitem""")
def q_b1(spark, sf):
    d = S.derive_ratios(_li(spark, sf), {"unit_price": ("l_extendedprice", "l_quantity")})
    return d.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("int").alias("line"),
                    F.round("unit_price", 6).alias("unit_price"),
                    F.round(S.to_model_units(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 9).alias("net_units"))


@register("prj_ratios", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS line,
       round(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 6) AS discount_per_tax,
       round(CASE WHEN l_extendedprice = 0 THEN NULL ELSE l_quantity / l_extendedprice END, 9) AS qty_per_price
FROM lineitem""")
def q_b2(spark, sf):
    d = S.derive_ratios(_li(spark, sf), {"discount_per_tax": ("l_discount", "l_tax"),
                                         "qty_per_price": ("l_quantity", "l_extendedprice")})
    return d.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("int").alias("line"),
                    F.round("discount_per_tax", 6).alias("discount_per_tax"),
                    F.round("qty_per_price", 9).alias("qty_per_price"))


@register("prj_unit_scale", """
SELECT o_orderkey, round(o_totalprice / 100000.0, 9) AS price_units,
       round((o_totalprice / 100000.0) * 100000.0, 4) AS price_usd FROM orders""")
def q_b3(spark, sf):
    o = read_table(spark, sf, "orders")
    u = S.to_model_units("o_totalprice")
    return o.select("o_orderkey", F.round(u, 9).alias("price_units"), F.round(S.to_usd(u), 4).alias("price_usd"))


@register("prj_vector_scale", f"""
SELECT vec_id, list_transform(list_transform(embedding, lambda x: {QSQL}), lambda q: round(q / 255.0, 6)) AS scaled
FROM embeddings""")
def q_b4(spark, sf):
    q = S.quantize_vector("embedding", QLO, QHI)
    return _emb(spark, sf).select("vec_id", F.transform(S.vector_scale(q), lambda x: F.round(x, 6)).alias("scaled"))


@register("prj_cut_bins", f"""WITH {SQL_DISTRICTS}
SELECT row_id, {sql_cut_bins('target')} AS band, {sql_cut_bins('acctbal / 1000.0', (-1.0, 0.0, 2.5, 5.0, 7.5))} AS balance_band
FROM districts""")
def q_b5(spark, sf):
    d = districts(spark, sf)
    return d.select("row_id", S.cut_bins("target").alias("band"),
                    S.cut_bins(F.col("acctbal") / 1000.0, (-1.0, 0.0, 2.5, 5.0, 7.5)).alias("balance_band"))


@register("prj_binary_labels", """
SELECT vec_id, CAST(label AS INTEGER) AS y, CAST(label >= 7 AS INTEGER) AS is_large,
       CAST(label % 2 = 1 AS INTEGER) AS is_odd, CAST(label = 5 AS INTEGER) AS is_five FROM embeddings""")
def q_b6(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", F.col("label").cast("int").alias("y"), S.binary_label(F.col("label") >= 7).alias("is_large"),
                    S.binary_label(F.col("label") % 2 == 1).alias("is_odd"), S.binary_label(F.col("label") == 5).alias("is_five"))


@register("prj_narrow_types", f"""
SELECT vec_id, list_transform(embedding, lambda x: {QSQL}) AS pixels,
       list_transform(embedding, lambda x: round(CAST(CAST(x AS FLOAT) AS DOUBLE), 6)) AS as_float
FROM embeddings""")
def q_b7(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", S.quantize_vector("embedding", QLO, QHI).alias("pixels"),
                    F.transform(S.narrow_vector("embedding", "float"), lambda x: F.round(x.cast("double"), 6)).alias("as_float"))


@register("prj_noise_clip", f"""
SELECT vec_id, list_transform(list_transform(embedding, lambda x: {QSQL}),
   lambda q, i: CAST(least(255, CAST(q AS INTEGER) + CAST({sql_seeded_hash("CAST(vec_id AS VARCHAR) || '/' || CAST(i - 1 AS VARCHAR)", 7)} % 100 AS INTEGER)) AS INTEGER)) AS noisy
FROM embeddings""")
def q_b8(spark, sf):
    e = _emb(spark, sf)
    q = S.quantize_vector("embedding", QLO, QHI)
    return e.select("vec_id", S.noise_clip(q, "vec_id", seed=7).alias("noisy"))


@register("prj_clip_range", f"""WITH {SQL_DISTRICTS},
b AS (SELECT quantile_cont(acctbal, 0.01) AS lo, quantile_cont(acctbal, 0.99) AS hi FROM districts)
SELECT row_id, round(greatest(b.lo, least(b.hi, acctbal)), 6) AS acctbal_clamped,
       round(greatest(0.5, least(4.5, target)), 9) AS target_clipped
FROM districts, b""")
def q_b9(spark, sf):
    d = districts(spark, sf)
    q = exact_quantile_dict(d, ["acctbal"], [0.01, 0.99])["acctbal"]
    lo, hi = q[0.01], q[0.99]
    return d.select("row_id", F.round(S.clip("acctbal", lo, hi), 6).alias("acctbal_clamped"),
                    F.round(S.clip("target", 0.5, 4.5), 9).alias("target_clipped"))


@register("prj_shift_matrix", f"""
SELECT vec_id, dy, dx, list_transform(range(0, {SIDE * SIDE}), lambda i:
   CASE WHEN i // {SIDE} - dy >= 0 AND i // {SIDE} - dy < {SIDE} AND i % {SIDE} - dx >= 0 AND i % {SIDE} - dx < {SIDE}
        THEN round(CAST(embedding[((i // {SIDE} - dy) * {SIDE} + (i % {SIDE} - dx)) + 1] AS DOUBLE), 6) ELSE 0.0 END) AS shifted
FROM embeddings, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) s(dy, dx)""")
def q_b10(spark, sf):
    e = _emb(spark, sf)
    outs = []
    for dy, dx in ((1, 0), (-1, 0), (0, 1), (0, -1)):
        outs.append(e.select("vec_id", F.lit(dy).alias("dy"), F.lit(dx).alias("dx"),
                             F.transform(S.shift_matrix("embedding", dy, dx, SIDE, SIDE), lambda x: F.round(x.cast("double"), 6)).alias("shifted")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@register("prj_residuals", f"""WITH {SQL_DISTRICTS},
m AS (SELECT priority, avg(target) AS pred FROM districts GROUP BY priority)
SELECT row_id, round(m.pred - target, 6) AS err, round(abs(m.pred - target), 6) AS abs_err,
       round((m.pred - target) * (m.pred - target), 6) AS sq_err
FROM districts JOIN m USING (priority)""")
def q_b11(spark, sf):
    d = districts(spark, sf)
    m = d.groupBy("priority").agg(F.avg("target").alias("pred"))
    s = d.join(bounded(m), "priority")
    res = S.residual_columns("pred", "target")
    return s.select("row_id", *[F.round(v, 6).alias(k) for k, v in res.items()])


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "boost"]
LI_BASE_SQL = "(SELECT *, exp(l_discount * 50) AS boost FROM lineitem)"


def _li_boost(spark, sf):
    return _li(spark, sf).withColumn("boost", F.exp(F.col("l_discount") * 50))


@register("prj_log_skewed", "WITH base AS " + LI_BASE_SQL + ", sk AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, skewness({c}) AS sk, min({c}) AS mn FROM base" for c in LI_NUM) + """),
sel AS (SELECT list(col) AS cols FROM sk WHERE abs(sk) > 1 AND mn > 0)
SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS line, """ + ", ".join(
    f"round(CASE WHEN list_contains(sel.cols, '{c}') THEN CASE WHEN {c} > 0 THEN ln({c}) END ELSE {c} END, 6) AS {c}"
    for c in LI_NUM) + " FROM base, sel")
def q_b12(spark, sf):
    d = _li_boost(spark, sf)
    chosen = {r["column"] for r in skewed_columns(d, LI_NUM).collect()}   # C5: bounded by column count
    return d.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("int").alias("line"),
                    *[F.round(S.log_positive(c) if c in chosen else F.col(c), 6).alias(c) for c in LI_NUM])


@register("prj_null_policy", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS line,
       CASE WHEN l_discount - 0.05 < 0 THEN NULL ELSE round(sqrt(l_discount - 0.05), 6) END AS root_excess,
       CASE WHEN l_tax = 0 THEN NULL ELSE round(l_discount / l_tax, 6) END AS ratio
FROM lineitem""")
def q_b13(spark, sf):
    d = _li(spark, sf)
    # sqrt of a negative number is NaN in Spark and a plain division by a zero
    # double gives inf/NaN outside ANSI; both must end up NULL.
    raw = d.select("l_orderkey", "l_linenumber", F.sqrt(F.col("l_discount") - 0.05).alias("root_excess"),
                   F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount") / F.col("l_tax")).alias("ratio"))
    clean = S.null_policy(raw, ["root_excess", "ratio"])
    return clean.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("int").alias("line"),
                        F.round("root_excess", 6).alias("root_excess"), F.round("ratio", 6).alias("ratio"))


@register("prj_drop_leaky", f"""WITH {SQL_DISTRICTS}
SELECT acctbal, doy, priority, segment, round(target, 9) AS target FROM districts""")
def q_b14(spark, sf):
    d = districts(spark, sf)
    return S.allow_list(d, ["acctbal", "doy", "priority", "segment", "target"]).withColumn("target", F.round("target", 9))


@register("prj_candidate_key", """
SELECT run_id, 'c=' || printf('%.6f', c) || '|gamma=' || printf('%.6f', gamma) || '|kernel=' || kernel AS cand_key
FROM (SELECT event_id AS run_id, event_type AS kernel, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS c,
             (hour(ts) + 1) / 10.0 AS gamma FROM events)""")
def q_b20(spark, sf):
    from foldsafe.plans.frames import runs
    r = runs(spark, sf)
    r = r.withColumn("c_s", F.format_string("%.6f", "c")).withColumn("gamma_s", F.format_string("%.6f", "gamma"))
    key = F.concat(F.lit("c="), F.col("c_s"), F.lit("|gamma="), F.col("gamma_s"), F.lit("|kernel="), F.col("kernel"))
    return r.select("run_id", key.alias("cand_key"))


@register("prj_param_names", """
SELECT event_id AS run_id, array_to_string(list_sort(map_keys(m)), ',') AS param_names,
       round(m['k'], 6) AS k_value
FROM (SELECT event_id, map_from_entries(list_transform(
        [{'key': 'model__k', 'value': CAST(json_extract_string(props, '$.k') AS DOUBLE)},
         {'key': 'model__hour', 'value': CAST(hour(ts) AS DOUBLE)},
         {'key': 'prep__scale', 'value': 1.0}],
        lambda e: {'key': regexp_replace(e.key, '^model__', ''), 'value': e.value})) AS m FROM events)""")
def q_b21(spark, sf):
    e = read_table(spark, sf, "events")
    m = F.create_map(F.lit("model__k"), F.get_json_object("props", "$.k").cast("double"),
                     F.lit("model__hour"), F.hour("ts").cast("double"),
                     F.lit("prep__scale"), F.lit(1.0))
    s = S.strip_param_prefix(m)
    return e.select(F.col("event_id").alias("run_id"), F.array_join(F.sort_array(F.map_keys(s)), ",").alias("param_names"),
                    F.round(s["k"], 6).alias("k_value"))


# The display order of the priority levels.
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("prj_category_index", f"""WITH {SQL_DISTRICTS}
SELECT row_id, CAST(list_position({PRIORITY_ORDER!r}, priority) - 1 AS INTEGER) AS priority_idx FROM districts""")
def q_b22(spark, sf):
    d = districts(spark, sf)
    return d.select("row_id", S.category_index("priority", PRIORITY_ORDER).alias("priority_idx"))


@register("prj_round_export", """
SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 3) + 0.0 AS lat, round(CAST(embedding[2] AS DOUBLE), 3) + 0.0 AS lon,
       round(CAST(embedding[3] AS DOUBLE) * 1000, 6) + 0.0 AS leaf FROM embeddings""")
def q_b23(spark, sf):
    e = _emb(spark, sf)
    x = lambda i: F.element_at("embedding", i).cast("double")
    return e.select("vec_id", S.round_half_up(x(1), 3).alias("lat"), S.round_half_up(x(2), 3).alias("lon"),
                    S.round_half_up(x(3) * 1000, 6).alias("leaf"))
