"""URL filter by per-host path-template trees.

Level by level, to the last segment, every path of a host is generalised: a segment
value that looks generated becomes a wildcard, and branches whose labelled block
rates do not differ from what their siblings have together (two-proportion z test)
are merged into it; where a side has no labels, those of too small a share are.
A template is rejected if it has labelled pages of its own and its block rate,
smoothed towards its host's, which is smoothed towards the host's parent domain and
the whole, passes a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldsafe.llm.common import row_total, written

# The rules of the contract, (host suffix, path prefix, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text (``net/``) and its verdict; null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for suffix, prefix, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        text = F.when(fits, F.lit(suffix + prefix)).otherwise(text)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return text, verdict


def _generated(segment: Column) -> Column:
    """Numbers, dates, long hexadecimal or digit-bearing names: variable by their shape."""
    return segment.rlike(r"^[0-9][0-9._-]*(\.[A-Za-z]{2,5})?$") | segment.rlike(r"^[0-9a-fA-F-]{12,}$") | (
        segment.rlike(r"[0-9]{3,}"))


def templates(paths: DataFrame, min_share: float = 0.02, z: float = 1.96) -> DataFrame:
    """Template of each (host, path) of ``paths`` (host, path, n, n_labelled, n_block), one row per input row.

    A branch of a node (host, template so far) with labels inside and in its siblings
    is literal if their block rates differ, whatever its share; without labels on both
    sides, if it holds ``min_share`` of the node and two pages.  A round takes what all
    paths of a node begin with at once, then branches on the next segment; rounds go on
    until no path has a segment left, so they follow the branchings, not the depth.
    Counts are grouped and joined back: a hot host is only ever seen as partial sums
    and a splittable join.
    """
    counts, node = ["n", "n_labelled", "n_block"], ["host", "template"]
    sums = [F.sum(c).alias(c) for c in counts]
    segments = F.transform(F.split(F.regexp_replace("path", "^/|/$", ""), "/"), lambda x: F.when(_generated(x), "*").otherwise(x))
    d = written(paths.select("host", "path", *counts, segments.alias("segments"), F.lit("").alias("template")), "template-paths")
    done = d.where("size(segments) = 0").drop("segments")
    while d.where("size(segments) > 0").limit(1).count():
        d = d.where("size(segments) > 0")
        # what the least and the greatest path of a node begin with, all of its paths do
        ends = d.groupBy(*node).agg(F.min("segments").alias("lo"), F.max("segments").alias("hi"), F.sum("n").alias("node_n"))
        apart = F.array_position(F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y)), False)
        ends = ends.withColumn("common", F.when(apart == 0, F.size("lo")).otherwise(apart - 1).cast("int"))
        begins = F.transform(F.slice("lo", F.lit(1), F.col("common")),
                             lambda x: F.concat(F.lit("/"), F.when(F.col("node_n") >= 2, x).otherwise("*")))
        ends = written(ends.select(*node, "common", F.array_join(begins, "").alias("begins")), "template-ends")
        d = written(d.join(ends, node).select(
            "host", "path", *counts, F.concat("template", "begins").alias("template"),
            F.slice("segments", F.col("common") + 1, F.greatest(F.size("segments") - F.col("common"), F.lit(0))).alias("segments")), "template-paths")
        done = done.union(d.where("size(segments) = 0").select(*done.columns))
        d = d.where("size(segments) > 0").withColumn("segment", F.col("segments")[0])
        by = written(d.groupBy(*node, "segment").agg(*sums), "template-branches")
        # a node's shares are of all its segments, those of a variable shape too; written, so that the join can split a hot node
        total = written(by.groupBy(*node).agg(*(F.sum(c).alias(f"all_{c}") for c in counts)), "template-nodes")
        rest_n, rest_b = F.col("all_n_labelled") - F.col("n_labelled"), F.col("all_n_block") - F.col("n_block")
        both = (F.col("n_labelled") > 0) & (rest_n > 0)
        pooled = F.col("all_n_block") / F.nullif(F.col("all_n_labelled"), F.lit(0))
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(F.col("n_labelled"), F.lit(0)) + 1 / F.nullif(rest_n, F.lit(0))))
        gap = F.abs(F.col("n_block") / F.nullif(F.col("n_labelled"), F.lit(0)) - rest_b / F.nullif(rest_n, F.lit(0)))
        shared = (F.col("n") >= min_share * F.col("all_n")) & (F.col("n") >= 2)
        literal = (by.where("segment <> '*'").join(total, node).where(F.when(both, gap > z * spread).otherwise(shared))
                   .select(*node, "segment", F.lit(True).alias("literal")))
        step = F.concat(F.lit("/"), F.when(F.col("literal"), F.col("segment")).otherwise("*"))
        d = written(d.join(literal, [*node, "segment"], "left").select(
            "host", "path", *counts, F.concat("template", step).alias("template"),
            F.slice("segments", F.lit(2), F.size("segments")).alias("segments")), "template-paths")
        done = done.union(d.where("size(segments) = 0").select(*done.columns))
    return done


def judge(pages: DataFrame, labelled: Column, blocked: Column, prior: float = 10.0, threshold: float = 0.5,
          min_share: float = 0.02, z: float = 1.96) -> DataFrame:
    """Add host, path, template, block_rate and judged (allow or block) to ``pages`` (with a ``url`` column).

    ``labelled`` and ``blocked`` are boolean expressions over the columns of
    ``pages`` with host and path: which rows carry a label, and whether it is
    block; null counts as no.  ``prior`` is the weight of the parent's rate.
    Null or broken urls have the empty host and path and are judged as that
    template.  Repeated rows are each returned.  Columns of ``pages`` with a name
    that is added here are replaced.  A template without a label is allowed.
    """
    host, path = host_and_path(F.col("url"))
    added = ["host", "path", "template", "block_rate", "judged"]
    d = pages.drop(*added).withColumn("host", host).withColumn("path", path)
    say = F.coalesce(labelled, F.lit(False))
    flagged = d.select("host", "path", say.cast("long").alias("n_labelled"),
                       (say & F.coalesce(blocked, F.lit(False))).cast("long").alias("n_block"))
    paths = written(flagged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("n_labelled").alias("n_labelled"),
                                                        F.sum("n_block").alias("n_block")), "paths")
    t = written(templates(paths, min_share, z), "templates")
    sums = [F.sum(c).alias(c) for c in ("n_labelled", "n_block")]
    parent = F.substring_index("host", ".", -2)
    whole = t.agg(*sums).first()
    rate = (whole["n_block"] or 0) / whole["n_labelled"] if whole["n_labelled"] else 0.0

    def smoothed(above: Column) -> Column:
        return (F.col("n_block") + prior * above) / (F.col("n_labelled") + prior)

    domain = t.groupBy(parent.alias("parent")).agg(*sums).select("parent", smoothed(F.lit(rate)).alias("parent_rate"))
    host_rate = (t.groupBy("host").agg(*sums).withColumn("parent", parent).join(domain, "parent")
                 .select("host", smoothed(F.col("parent_rate")).alias("host_rate")))
    rates = (t.groupBy("host", "template").agg(*sums).join(host_rate, "host")
             .select("host", "template", smoothed(F.col("host_rate")).alias("block_rate"), (F.col("n_labelled") > 0).alias("__own")))
    known = t.select("host", "path", "template").join(rates, ["host", "template"])
    # the rate of a template without labels is its host's: no evidence of its own
    judged = F.when(F.col("__own") & (F.col("block_rate") > threshold), "block").otherwise("allow")
    return d.join(known, ["host", "path"]).withColumn("judged", judged).drop("__own")


def filter_urls(pages: DataFrame, rules=RULES, **options) -> DataFrame:
    """``pages`` with host, path, rule, verdict, template and block_rate: a rule's verdict where one fits, else the template's.

    The trees learn from the urls on which the rules speak.
    """
    d = pages.drop("rule", "verdict")
    text, said = rule_of(F.col("host"), F.col("path"), rules)
    out = judge(d, said.isNotNull(), said == "block", **options)
    return out.withColumn("rule", text).withColumn("verdict", F.coalesce(said, F.col("judged"))).drop("judged")


def count_templates(pages: DataFrame, **options) -> int:
    return row_total(filter_urls(pages, **options).select("host", "template").distinct())
