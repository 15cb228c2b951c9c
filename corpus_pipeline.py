"""Corpus pipeline: quality classifier, line dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet under the
shared checkpoint folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldsafe.llm import bag_minhash, decontaminate, packing, quality_rules, winnow_lines
from foldsafe.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_SCORE = 0.3

# The stages learn a model, draw hashes and run a tokenizer: SQL cannot say them.
ORACLE_SQL = None


def row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of the training rows, does not reject."""
    labels = table(spark, sf_dir, "labels")
    model = quality_rules.fit(docs, labels.where(~quality_rules.held_out()))
    return quality_rules.score(docs, model).where(F.col("score") >= KEEP_SCORE).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their later repeated runs of lines; one that has no word left goes."""
    d = winnow_lines.dedup_every_run(docs)
    left = (F.col("deleted_lines") == 0) | F.col("text").rlike(r"\S")
    return d.where(left).withColumn("n_chars", F.when(F.col("deleted_lines") > 0, F.length("text")).otherwise(
        F.col("n_chars")).cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: of least doc_id (null: the last), then of least text hash.

    A document is its doc_id and text (its key is a 64-bit hash of both), so rows equal
    in these are one, rows that share only the doc_id are several, and those without a
    doc_id are classified by their texts like all others.
    """
    rest = [c for c in COLUMNS if c != "text"]
    # partial sums: many equal rows reach a task as one
    rows = docs.select(row_key().alias("key"), *COLUMNS).groupBy("key").agg(F.min(F.struct(*rest, "text")).alias("row"))
    rows = written(rows.select("key", *(F.col("row")[c].alias(c) for c in COLUMNS)), "near-rows")
    classes = bag_minhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))
    kept = (rows.select("key", "doc_id").join(classes.withColumnRenamed("doc_id", "key"), "key")
            .groupBy("class_id").agg(first.alias("first")).select(F.col("first.key").alias("key")))
    return rows.join(kept, "key", "left_semi").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; a document is its doc_id (or none) and text, as in ``near_dedup``."""
    keyed = docs.select(row_key().alias("key"), *COLUMNS)
    found = decontaminate.contaminated(keyed.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = found.select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(bad, "key", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most 2048."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminated), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
