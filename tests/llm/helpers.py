"""Brute-force versions and small tables shared by the tests of the operators."""

import re


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(text, k=5):
    w = words(text)
    return [tuple(w[i: i + k]) for i in range(max(len(w) - k + 1, 1))] if w else []


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in zip(ids if ids is not None else range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """Extra columns with names that operators use inside."""
    from pyspark.sql import functions as F
    for name in ("score", "words", "hash", "key", "node", "ids", "component", "deleted_lines", "value", "stats", "digest"):
        df = df.withColumn(name, F.lit("x"))
    return df
