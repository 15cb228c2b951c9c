"""Registered queries: text."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldsafe.functions import text as T
from foldsafe.operators import text as TX
from foldsafe.operators.splits import split_hash
from foldsafe.plans.catalog import register
from foldsafe.session import read_table

TOK_SQL = r"regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}')"


@register("txt_normalize")
def q_b15(spark, sf):
    """No DuckDB oracle: its regex engine has ASCII-only \\b; checked against
    Python's ``re`` on the documents table in the tests."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", T.normalize_text("text").alias("normalized"))


@register("txt_strip_html", r"""
SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS text FROM pages""")
def q_b16(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", T.strip_html("html").alias("text"))


@register("txt_prefer_plain", r"""
WITH g AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user') AS p,
                  string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant') AS h
           FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN p IS NOT NULL THEN p ELSE regexp_replace(coalesce(h, ''), '<[^>]+>', ' ', 'g') END AS body FROM g""")
def q_b17(spark, sf):
    c = read_table(spark, sf, "conversations")
    return TX.prefer_plain(c, "conv_id", "turn", "role", "text", plain="user", html="assistant")


@register("txt_prepend_subject", r"""
SELECT page_id, coalesce(nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ''), '') || chr(10) ||
       regexp_replace(html, '<[^>]+>', ' ', 'g') AS message FROM pages""")
def q_b18(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", T.prepend_subject(T.html_title("html"), T.strip_html("html")).alias("message"))


@register("txt_tokens", f"""
SELECT doc_id, CAST(len({TOK_SQL}) AS INTEGER) AS n_tokens, array_to_string({TOK_SQL}, ' ') AS tokens FROM documents""")
def q_b19(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", T.tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("int").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


TF_SQL = f"""tok AS (SELECT doc_id, unnest({TOK_SQL}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 3)"""


@register("flt_min_df", f"WITH {TF_SQL} SELECT term, df FROM df")
def q_c7(spark, sf):
    d = read_table(spark, sf, "documents")
    return TX.min_df_terms(TX.term_counts(d, "doc_id", "text"), 3)


@register("prep_tfidf", f"""WITH {TF_SQL},
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.tf)) * (ln((1 + n.n) / (1 + df.df)) + 1) AS w FROM tf JOIN df USING (term), n),
nm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / norm, 6) AS weight FROM w JOIN nm USING (doc_id)""")
def q_k10(spark, sf):
    d = read_table(spark, sf, "documents")
    tf = TX.term_counts(d, "doc_id", "text").persist()      # tokenised once, used by fit and apply
    m = TX.fit_tfidf(d, "doc_id", "text", 3, tf=tf)
    m.idf.persist()
    return TX.apply_tfidf(d, "doc_id", "text", m, tf=tf).withColumn("weight", F.round("weight", 6))


NB_SQL = f"""lab AS (SELECT l.doc_id, d.text, CAST(l.toxic AS INTEGER) AS label,
                 CAST(('0x' || substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 8))::BIGINT < 0.2 * 4294967296.0 AS INTEGER) AS is_test
          FROM labels l JOIN documents d USING (doc_id)),
tr AS (SELECT * FROM lab WHERE is_test = 0),
tok AS (SELECT doc_id, unnest({TOK_SQL}) AS term FROM tr),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 3),
n AS (SELECT count(*) AS n FROM tr),
idf AS (SELECT term, ln((1 + n.n) / (1 + df.df)) + 1 AS idf FROM df, n),
wt0 AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.tf)) * idf.idf AS w FROM tf JOIN idf USING (term)),
wt AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM wt0),
v AS (SELECT count(*) AS V FROM idf),
pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM tr)) AS log_prior FROM tr GROUP BY label),
fc AS (SELECT tr.label, wt.term, sum(wt.weight) AS fc FROM wt JOIN tr USING (doc_id) GROUP BY 1, 2),
tot AS (SELECT label, sum(fc) AS tot FROM fc GROUP BY label),
lp AS (SELECT fc.label, fc.term, ln((fc.fc + 1.0) / (tot.tot + 1.0 * v.V)) AS log_prob FROM fc JOIN tot USING (label), v),
un AS (SELECT label, ln(1.0 / (tot + 1.0 * v.V)) AS log_unseen FROM tot, v),
te AS (SELECT * FROM lab WHERE is_test = 1),
ttok AS (SELECT doc_id, unnest({TOK_SQL}) AS term FROM te),
ttf AS (SELECT doc_id, term, count(*) AS tf FROM ttok GROUP BY 1, 2),
tw0 AS (SELECT ttf.doc_id, ttf.term, (1 + ln(ttf.tf)) * idf.idf AS w FROM ttf JOIN idf USING (term)),
tw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM tw0),
cls AS (SELECT label, log_prior, log_unseen FROM pr JOIN un USING (label)),
j AS (SELECT tw.doc_id, cls.label, sum(tw.weight * coalesce(lp.log_prob, cls.log_unseen)) + max(cls.log_prior) AS jll
      FROM tw CROSS JOIN cls LEFT JOIN lp ON lp.label = cls.label AND lp.term = tw.term GROUP BY 1, 2)"""


@register("fit_naive_bayes", f"""WITH {NB_SQL},
p AS (SELECT doc_id, arg_min(label, (-jll, label)) AS pred FROM j GROUP BY doc_id)
SELECT p.doc_id, CAST(p.pred AS INTEGER) AS pred, CAST(te.label AS INTEGER) AS label,
       round(max(CASE WHEN j.label = 0 THEN j.jll END), 6) AS jll_0, round(max(CASE WHEN j.label = 1 THEN j.jll END), 6) AS jll_1
FROM p JOIN te USING (doc_id) JOIN j USING (doc_id) GROUP BY p.doc_id, p.pred, te.label""")
def q_l11(spark, sf):
    """TF-IDF fitted on the training documents only, multinomial NB on its
    weights, test documents scored with the training vocabulary.  All
    documents are tokenised once; the split flag rides along."""
    from pyspark import StorageLevel
    lab = read_table(spark, sf, "labels").join(read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    lab = split_hash(lab.withColumn("label", F.col("toxic").cast("int")), "doc_id", 0.2)
    lab = lab.select("doc_id", "text", "label", "is_test").persist(StorageLevel.MEMORY_AND_DISK)
    tf = TX.term_counts(lab, "doc_id", "text", carry=("is_test",)).persist(StorageLevel.MEMORY_AND_DISK)
    tr, te = lab.where("is_test = 0"), lab.where("is_test = 1")
    tr_tf = tf.where("is_test = 0").drop("is_test")
    te_tf = tf.where("is_test = 1").drop("is_test")
    tm = TX.fit_tfidf(tr, "doc_id", "text", 3, tf=tr_tf)
    tm.idf.persist(StorageLevel.MEMORY_AND_DISK)
    vocab_size = tm.idf.count()
    nb = TX.fit_naive_bayes(TX.apply_tfidf(tr, "doc_id", "text", tm, tf=tr_tf), tr, "label", vocab_size)
    jll = TX.predict_naive_bayes(TX.apply_tfidf(te, "doc_id", "text", tm, tf=te_tf), nb, tm.idf)
    pred = jll.groupBy("doc_id").agg(F.min_by("label", F.struct(-F.col("jll"), F.col("label"))).alias("pred"),
                                     F.round(F.max(F.when(F.col("label") == 0, F.col("jll"))), 6).alias("jll_0"),
                                     F.round(F.max(F.when(F.col("label") == 1, F.col("jll"))), 6).alias("jll_1"))
    return pred.join(te.select("doc_id", "label"), "doc_id").select("doc_id", F.col("pred").cast("int").alias("pred"),
                                                                   "label", "jll_0", "jll_1")


@register("txt_mime_pipeline", r"""
WITH g AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user') AS p,
                  string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant') AS h
           FROM conversations GROUP BY conv_id)
SELECT conv_id, 'conversation ' || CAST(conv_id AS VARCHAR) || chr(10) ||
       CASE WHEN p IS NOT NULL THEN p ELSE regexp_replace(coalesce(h, ''), '<[^>]+>', ' ', 'g') END AS message FROM g""")
def q_mime(spark, sf):
    """B17 + B18 end to end through real MIME: conversations are laid out as
    multipart messages (user turns text/plain, assistant turns text/html,
    system turns as an attachment type that is skipped), decoded per message
    in mapInPandas, plain preferred over HTML, subject prepended."""
    from foldsafe.sources.mime import build_multipart, decode_mime
    c = read_table(spark, sf, "conversations").withColumn(
        "ctype", F.when(F.col("role") == "user", "text/plain").when(F.col("role") == "assistant", "text/html")
                  .otherwise("application/octet-stream"))
    raw = build_multipart(c, "conv_id", "turn", "ctype", "text", F.concat(F.lit("conversation "), F.col("conv_id").cast("string")))
    parts = decode_mime(raw, "conv_id", "raw")  # a message without a text part is one row of nulls
    # the decoder returns each 8-bit part with its line terminator; strip exactly one
    parts = parts.withColumn("text", F.regexp_replace("text", "\n$", ""))
    body = TX.prefer_plain(parts, "msg_id", "part_idx", "content_type", "text", plain="text/plain", html="text/html")
    subj = parts.groupBy("msg_id").agg(F.first("subject").alias("subject"))
    return body.join(subj, "msg_id").select(F.col("msg_id").alias("conv_id"),
                                            T.prepend_subject("subject", "body").alias("message"))
