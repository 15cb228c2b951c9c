"""The operators' queries over the given tables, with oracle SQL where SQL can say them."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldsafe.llm import (bag_minhash, collocations, decontaminate, hidden_markov, license_digest, packing, path_templates, pii_crf, prefix_trie, quality_rules, simple8b,
                          threshold_topk, winnow_lines)
from foldsafe.llm.common import table

TOKENIZER = "word_bpe_49k.json"
QUALITY_THRESHOLD = 0.3


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_rules.fit(docs, labels.where(~quality_rules.held_out()))
    scored = quality_rules.score(docs, model)
    return scored.select("doc_id", quality_rules.held_out().alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan_licenses(table(spark, sf_dir, "documents"), license_digest.known_digests(spark))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find_pii(table(spark, sf_dir, "documents"), pii_crf.labelled_table(spark))
    base = F.filter("spans", lambda s: s["base"])

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii_crf.KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text("spans").alias("spans"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = simple8b.token_file_path(spark)
    simple8b.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return simple8b.token_index(spark, path)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow_lines.dedup_every_run(table(spark, sf_dir, "documents")).select("doc_id", "text", "deleted_lines")


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = path_templates.filter_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("block_rate", 9).alias("block_rate"))


def op11_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_OP6 = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

QUERIES = {
    "op1_decontaminate": op1_decontaminate, "op2_quality": op2_quality, "op3_licenses": op3_licenses,
    "op4_packing": op4_packing, "op5_near_duplicates": op5_near_duplicates, "op6_threshold_topk": op6_threshold_topk,
    "op7_pii": op7_pii, "op8_token_files": op8_token_files, "op9_line_dedup": op9_line_dedup,
    "op10_url_templates": op10_url_templates, "op11_hidden_markov": op11_hidden_markov, "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations, "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_decontaminate": decontaminate.oracle(), "op3_licenses": license_digest.oracle(), "op6_threshold_topk": ORACLE_OP6,
    "op12_prefix_trie": prefix_trie.oracle(), "op13_collocations": collocations.oracle(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
