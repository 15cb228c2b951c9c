"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow random trees propose rules (the conjunction of splits on each path); a
lasso logistic regression over the rules' indicators weighs them, most to zero;
the rest compile to one Spark column expression, so scoring is a single scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from foldsafe.llm.common import empty_text, written

STATISTICS = ("n_chars_log", "word_length", "distinct_words", "repeated_next", "upper_share", "digit_share",
              "mark_share", "symbol_share", "stop_share", "line_words", "distinct_lines")
# Largest number of labelled rows that a fit reads, chosen by the least hash of the doc_id.
MAX_TRAIN = 20_000
MAX_BINS = 64


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``stats`` over the whole text (null: empty); a share of nothing is 0."""
    text = empty_text()
    d = docs.withColumn("__t", text)
    words = F.filter(F.split("__t", r"\s+"), lambda w: w != "")
    d = d.withColumn("__w", words).withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x != ""))
    n, chars = F.size("__w"), F.length("__t")

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("__t", pattern, ""))

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")

    following = F.slice("__w", 2, F.greatest(n - 1, F.lit(0)))
    same = F.zip_with(following, F.slice("__w", 1, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b)
    letters_digits = left(r"[^\p{L}\p{N}]+")
    stats = F.struct(
        F.log1p(chars.cast("double")).alias("n_chars_log"),
        share(letters_digits, n).alias("word_length"),
        share(F.size(F.array_distinct("__w")), n).alias("distinct_words"),
        share(F.size(F.filter(same, lambda x: x)), n).alias("repeated_next"),
        share(left(r"[^\p{Lu}]+"), chars).alias("upper_share"),
        share(left(r"[^0-9]+"), chars).alias("digit_share"),
        share(left(r"[^!?|]+"), chars).alias("mark_share"),
        share(left(r"[\p{L}\p{N}\s.,!?]+"), chars).alias("symbol_share"),
        share(left(r"[^.]+"), n).alias("stop_share"),
        share(n, F.size("__l")).alias("line_words"),
        share(F.size(F.array_distinct("__l")), F.size("__l")).alias("distinct_lines"))
    return d.withColumn("stats", stats).drop("__t", "__w", "__l")


@dataclass
class RuleModel:
    """Weighted rules; a rule is a tuple of (statistic, "<=" or ">", threshold)."""

    intercept: float
    rules: list[tuple[tuple, float]] = field(default_factory=list)

    def score(self, stats: str = "stats") -> Column:
        """Probability of label 1 as one expression over the statistics."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).cast("double")


def holds(rule: tuple, stats: str = "stats") -> Column:
    out = F.lit(True)
    for name, side, at in rule:
        c = F.col(f"{stats}.{name}")
        out = out & ((c <= F.lit(at)) if side == "<=" else (c > F.lit(at)))
    return out


def tree_rules(description: str) -> set[tuple]:
    """Every path from the root, whole or partial, of a tree's debug string, as a rule with one bound per side."""
    path, found = [], set()
    for line in description.splitlines():
        m = re.match(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.Ee]+)\)$", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (STATISTICS[int(m[2])], m[3], float(m[4])))]
        tight: dict[tuple, float] = {}
        for _, (name, side, at) in path:
            key = (name, side)
            tight[key] = min(tight.get(key, at), at) if side == "<=" else max(tight.get(key, at), at)
        found.add(tuple(sorted((n, s, a) for (n, s), a in tight.items())))
    return found


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", trees: int = 12, depth: int = 3,
        penalty: float = 0.0005, max_train: int = MAX_TRAIN, seed: int = 7) -> RuleModel:
    """Fit on the labelled rows of ``docs``: at most ``max_train`` (those of least hashed doc_id), a bounded sample.

    A doc_id with several labels takes the lowest; null labels and labels of
    unknown documents are ignored.  With one class only, the score is constant
    (0.5 without any label).
    """
    marks = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(F.col(label).cast("double")).alias("__label"))
             .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_train))
    marks = written(marks, "quality-labels")
    known = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")  # max_train rows at most
    rows = written(with_statistics(known).select("__label", "stats").repartition(4), "quality-train")
    seen = {r["__label"]: r["n"] for r in rows.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return RuleModel({0.0: -4.0, 1.0: 4.0}.get(next(iter(seen), None), 0.0))
    flat = rows.select("__label", *(F.col(f"stats.{s}").alias(s) for s in STATISTICS))
    data = VectorAssembler(inputCols=list(STATISTICS), outputCol="__x").transform(flat).cache()
    forest = RandomForestClassifier(featuresCol="__x", labelCol="__label", numTrees=trees, maxDepth=depth, maxBins=MAX_BINS,
                                    subsamplingRate=0.7, featureSubsetStrategy="0.6", seed=seed).fit(data)
    data.unpersist()
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    marked = rows.select("__label", *(holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    data = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="__x").transform(marked).select(
        "__label", "__x").cache()
    lasso = LogisticRegression(featuresCol="__x", labelCol="__label", elasticNetParam=1.0, regParam=penalty,
                               standardization=False, maxIter=60).fit(data)
    data.unpersist()
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), [(r, w) for r, w in zip(rules, weights) if abs(w) > 1e-9])


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``score`` (a column of that name is replaced); every row gets one, empty texts too."""
    d = docs.drop("score", "stats")
    return with_statistics(d).withColumn("score", model.score()).drop("stats")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learnt from: crc32 of the doc_id as text, remainder 0 by 5 (a null id: not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
