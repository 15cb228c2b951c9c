"""Text statistics move texts once by document, not a row per term; class sums are made once."""

import math
import re

from foldsafe.operators import text as TX

ROWS = [(1, "aa bb aa"), (1, "bb cc"), (2, "aa cc"), (3, "aa bb"), (4, None)]


def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_document_are_counted_together(spark):
    tf = TX.term_counts(docs(spark), "doc_id", "text")
    assert {(r[0], r[1]): r[2] for r in tf.collect()} == {(1, "aa"): 2, (1, "bb"): 2, (1, "cc"): 1, (2, "aa"): 1, (2, "cc"): 1, (3, "aa"): 1, (3, "bb"): 1}
    assert re.search(r"hashpartitioning\(doc_id#\d+L?, \d+\)", plan(tf)) and not re.search(r"hashpartitioning\(doc_id#\d+L?, term", plan(tf))


def test_weights_move_no_row_per_term(spark):
    d = docs(spark)
    tf = TX.term_counts(d, "doc_id", "text")
    idf = {t: math.log(6 / (1 + n)) + 1 for t, n in {"aa": 3, "bb": 2, "cc": 2}.items()}
    w = TX.apply_tfidf(d, "doc_id", "text", TX.TfidfModel(spark.createDataFrame(list(idf.items()), "term string, idf double"), 5), tf=tf)
    assert "BroadcastHashJoin" in plan(w) and "SortMergeJoin" not in plan(w) and plan(w).count("hashpartitioning") == 1
    raw = {"aa": (1 + math.log(2)) * idf["aa"], "bb": (1 + math.log(2)) * idf["bb"], "cc": idf["cc"]}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    got = {r["term"]: r["weight"] for r in w.where("doc_id = 1").collect()}
    assert got.keys() == raw.keys() and all(abs(got[t] - raw[t] / norm) < 1e-12 for t in raw)


def test_class_sums_are_kept(spark):
    d = docs(spark)
    tf = TX.term_counts(d, "doc_id", "text")
    w = TX.apply_tfidf(d, "doc_id", "text", TX.fit_tfidf(d, "doc_id", "text", 2, tf=tf), tf=tf)
    lab = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, label int")
    nb = TX.fit_naive_bayes(w, lab, "label", 3)
    assert "InMemoryTableScan" in plan(nb.log_prob) and "InMemoryTableScan" in plan(nb.log_prior)


def test_scoring_repeats_no_weight_per_class(spark):
    prior = spark.createDataFrame([(0, -0.5, -4.0), (1, -1.0, -3.0), (None, -9.0, -9.0)], "label int, log_prior double, log_unseen double")
    probs = spark.createDataFrame([(0, "aa", -1.0), (1, "aa", -2.0), (1, "bb", -1.5)], "label int, term string, log_prob double")
    w = spark.createDataFrame([(1, "aa", 0.5), (1, "bb", 0.5), (2, "cc", 1.0), (3, "zz", 1.0)], "doc_id long, term string, weight double")
    vocab = spark.createDataFrame([("aa",), ("bb",), ("cc",)], "term string")
    jll = TX.predict_naive_bayes(w, TX.NaiveBayesModel(prior, probs), vocab)
    assert jll.columns == ["doc_id", "label", "jll"]
    assert {(r[0], r[1]): r[2] for r in jll.collect()} == {(1, 0): -3.0, (1, 1): -2.75, (2, 0): -4.5, (2, 1): -4.0}
    assert not re.search(r"keys=\[doc_id#\d+L?, label", plan(jll))
    assert TX.predict_naive_bayes(w, TX.NaiveBayesModel(prior.limit(0), probs), vocab).count() == 0
