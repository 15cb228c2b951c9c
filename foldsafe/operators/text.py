"""Text features and the text learner in long format.

A document-term matrix is never materialised as vectors: it is the table
(doc, term, weight).  Term statistics are grouped aggregates (map-side
combined, so a term present in every document is still cheap).  Texts are
brought together by document before they are tokenised, so neither the counts nor
the norms move a row per term.  The vocabulary is sent to the rows while it is
bounded; above that it stays distributed, and joins on ``term`` rely on AQE to
split a hot term's partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from foldsafe.operators.broadcast import bounded

from foldsafe.functions.text import strip_html, tokens


def term_counts(docs: DataFrame, doc_id: str, text: str, carry: tuple = ()) -> DataFrame:
    """(doc, term, tf) from B19 tokens; ``carry`` keeps per-document columns
    (e.g. the split flag) so train and test come out of one tokenisation."""
    d = docs.select(F.col(doc_id).alias("doc_id"), *carry, F.col(text).alias("__text")).repartition("doc_id")
    t = d.select("doc_id", *carry, F.explode(tokens("__text")).alias("term"))
    return t.groupBy("doc_id", *carry, "term").agg(F.count(F.lit(1)).alias("tf"))


def min_df_terms(tf: DataFrame, min_df: int = 3) -> DataFrame:
    """Terms present in at least ``min_df`` documents, with their df."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)


@dataclass
class TfidfModel:
    idf: DataFrame        # (term, idf): the fitted vocabulary, kept distributed
    n_docs: int


def fit_tfidf(docs: DataFrame, doc_id: str, text: str, min_df: int = 3, tf: DataFrame | None = None) -> TfidfModel:
    """K10 fit: smooth idf = ln((1 + n) / (1 + df)) + 1 over terms with df >= min_df.
    Pass ``tf`` (from :func:`term_counts`) to avoid tokenising twice."""
    n = docs.count()
    tf = tf if tf is not None else term_counts(docs, doc_id, text)
    vocab = min_df_terms(tf, min_df)
    idf = vocab.select("term", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))
    return TfidfModel(idf, n)


def apply_tfidf(docs: DataFrame, doc_id: str, text: str, model: TfidfModel, tf: DataFrame | None = None) -> DataFrame:
    """K10 apply: (1 + ln tf) * idf on in-vocabulary terms, L2-normalised per
    document (a window per document: one shuffle by document, no join back)."""
    from pyspark.sql import Window
    tf = tf if tf is not None else term_counts(docs, doc_id, text)
    w = tf.join(bounded(model.idf), "term", "inner").select("doc_id", "term", ((1.0 + F.log("tf")) * F.col("idf")).alias("w"))

    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", (F.col("w") / norm).alias("weight"))


@dataclass
class NaiveBayesModel:
    log_prior: DataFrame   # (label, log_prior)
    log_prob: DataFrame    # (label, term, log_prob)


def fit_naive_bayes(weights: DataFrame, labels: DataFrame, label: str, vocab_size: int, alpha: float = 1.0) -> NaiveBayesModel:
    """Multinomial NB on (doc, term, weight): grouped weight sums per
    (class, term), smoothed by alpha over the whole vocabulary."""
    lab = labels.select("doc_id", F.col(label).alias("label"))
    prior = lab.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    n = lab.count()
    log_prior = prior.select("label", F.log(F.col("n") / F.lit(float(n))).alias("log_prior"))
    # kept, as the totals, the probabilities and the unseen terms each read it: a row per class and term
    fc = weights.join(lab, "doc_id").groupBy("label", "term").agg(F.sum("weight").alias("fc")).persist()
    tot = fc.groupBy("label").agg(F.sum("fc").alias("tot"))
    log_prob = fc.join(bounded(tot), "label").select(
        "label", "term", F.log((F.col("fc") + alpha) / (F.col("tot") + alpha * vocab_size)).alias("log_prob"))
    # terms never seen in a class still get alpha / (tot + alpha V)
    unseen = tot.select("label", F.log(F.lit(alpha) / (F.col("tot") + alpha * vocab_size)).alias("log_unseen"))
    return NaiveBayesModel(log_prior.join(unseen, "label"), log_prob)


def predict_naive_bayes(weights: DataFrame, model: NaiveBayesModel, vocab: DataFrame) -> DataFrame:
    """Joint log-likelihood per (doc, class) and the argmax (lowest class on ties)."""
    w = weights.join(bounded(vocab.select("term")), "term", "left_semi")
    classes = [r for r in model.log_prior.select("label", "log_prior", "log_unseen").collect() if r["label"] is not None]   # few
    kind = model.log_prior.schema["label"].dataType
    if not classes:
        return w.select("doc_id", F.lit(None).cast(kind).alias("label"), F.lit(None).cast("double").alias("jll")).limit(0)
    # one row per (doc, term): the classes' probabilities of a term are columns, so the weights aren't repeated per class
    probs = model.log_prob.groupBy("term").agg(*[F.max(F.when(F.col("label") == F.lit(c["label"]), F.col("log_prob"))).alias(f"__p{k}")
                                                 for k, c in enumerate(classes)])
    s = w.join(bounded(probs), "term", "left")
    s = s.groupBy("doc_id").agg(*[F.sum(F.col("weight") * F.coalesce(f"__p{k}", F.lit(c["log_unseen"]))).alias(f"__s{k}")
                                  for k, c in enumerate(classes)])
    jll = F.array(*[F.struct(F.lit(c["label"]).cast(kind).alias("label"), (F.col(f"__s{k}") + F.lit(c["log_prior"])).alias("jll"))
                    for k, c in enumerate(classes)])
    return s.select("doc_id", F.explode(jll).alias("__j")).select("doc_id", "__j.label", "__j.jll")


def prefer_plain(parts: DataFrame, msg_id: str, order: str, kind: str, text: str,
                 plain: str = "plain", html: str = "html") -> DataFrame:
    """A message's plain parts joined by newline; only when it has none,
    its HTML parts joined and stripped of tags.  Other part kinds are skipped; a
    message without a text part keeps its place with an empty body."""
    g = parts.groupBy(msg_id).agg(
        F.array_sort(F.collect_list(F.when(F.col(kind) == plain, F.struct(order, text)))).alias("__p"),
        F.array_sort(F.collect_list(F.when(F.col(kind) == html, F.struct(order, text)))).alias("__h"))
    join_ = lambda c: F.array_join(F.transform(c, lambda s: s[text]), "\n")
    return g.select(msg_id, F.when(F.size("__p") > 0, join_("__p")).otherwise(strip_html(join_("__h"))).alias("body"))
