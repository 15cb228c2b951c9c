"""Licence scan by canonical digest.

A text is canonical when it is lower-cased, without copyright lines, with one
spelling of words that licences spell in several ways, and with every run of
other characters than letters and digits as one space.  The digest of that is
joined to the digests of known licence texts, for the whole text of a document,
for each of its lines as a text of its own, and for the runs of lines that have the
first word and the number of words of a known text, however it is wrapped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldsafe.llm.common import empty_text, row_total
from foldsafe.llm.license_texts import TEXTS

# Words with several spellings in licence texts, and the one kept.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing",
    "sublicence": "sublicense", "sublicenced": "sublicensed", "authorisation": "authorization",
    "authorised": "authorized", "organisation": "organization", "favour": "favor", "honour": "honor",
    "judgement": "judgment", "programme": "program", "whilst": "while", "v": "version", "ver": "version",
}
# Whole notices and the licence that each names.
KNOWN = (
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", "Apache-2.0"),
    ("Released under the MIT License.", "MIT"),
    ("Licensed under the MIT License.", "MIT"),
    ("This project is licensed under the MIT License.", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("Licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause"),
    ("Licensed under the BSD 2-Clause License.", "BSD-2-Clause"),
    ("Licensed under the Mozilla Public License, version 2.0.", "MPL-2.0"),
    ("All rights reserved.", "Proprietary"),
)
COPYRIGHT_LINE = r"(?im)^[ \t]*(copyright|\(c\)|©)[^\n]*"


BROADCAST_ROWS = 100_000


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, as an array; lines without a letter or digit are left out."""
    c = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, ""))
    c = F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}\n]+", " "), r" ?\n[ \n]*", " \n ")
    one = F.create_map(*(F.lit(x) for pair in SPELLINGS.items() for x in pair))
    words = F.transform(F.split(c, " "), lambda w: F.coalesce(F.element_at(one, w), w))
    return F.filter(F.transform(F.split(F.array_join(words, " "), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _words(line: Column) -> Column:
    return F.size(F.split(line, " "))


def known_digests(spark: SparkSession, known=KNOWN, texts=TEXTS) -> DataFrame:
    """``digest, license, first, words`` (first word, number of words); equal canonical texts under several names keep the first name."""
    d = spark.createDataFrame(list(known), "text string, license string")
    d = d.select(F.array_join(canonical_lines(F.col("text")), " ").alias("whole"), "license")
    d = d.select(F.sha2("whole", 256).alias("digest"), "license", F.substring_index("whole", " ", 1).alias("first"), _words(F.col("whole")).alias("words"))
    more = spark.createDataFrame([(digest, name, first, words) for name, first, words, digest in texts], d.schema)
    return d.union(more).groupBy("digest").agg(F.min("license").alias("license"), F.min("first").alias("first"), F.min("words").alias("words"))


def _runs(known: DataFrame) -> Column:
    """The runs of two lines or more of ``lines`` with the first word and the number of words of a known text: text, at, n."""
    shapes = known.where("words > 1").groupBy("first").agg(F.array_sort(F.collect_set("words")).alias("words")).collect()
    none = F.array().cast("array<struct<text:string,at:int,n:int>>")
    if not shapes:
        return none
    wanted = F.create_map(*(x for r in shapes for x in (F.lit(r["first"]), F.array(*map(F.lit, r["words"])))))

    def run(at: Column, words: Column) -> Column:
        # a line has a word at least, so a run of some words has as many lines at most
        step = lambda s, n: F.when(s["left"] > 0, F.struct((s["left"] - n).alias("left"), (s["n"] + 1).alias("n"))).otherwise(s)
        end = F.aggregate(F.slice("counts", at + 1, words), F.struct(words.alias("left"), F.lit(0).alias("n")), step)
        return F.struct(at.alias("at"), F.when(end["left"] == 0, end["n"]).alias("n"))

    starts = F.transform("lines", lambda x, i: F.struct(i.alias("at"), F.element_at(wanted, F.substring_index(x, " ", 1)).alias("words")))
    found = F.flatten(F.transform(F.filter(starts, lambda s: s["words"].isNotNull()), lambda s: F.transform(s["words"], lambda w: run(s["at"], w))))
    return F.transform(F.filter(found, lambda r: r["n"] > 1), lambda r: F.struct(
        F.array_join(F.slice("lines", r["at"] + 1, r["n"]), " ").alias("text"), r["at"].alias("at"), r["n"].alias("n")))


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per doc_id: license (of the whole text, null if unknown), notices (names of the known texts among its lines and runs
    of lines, sorted, comma-joined) and n_notice_lines (the lines in them, each once).

    Whole texts, lines and runs are digested in the scan and joined to ``known`` by
    hash; partial sums by document, then by doc_id, come before a shuffle.  The first
    words and lengths of ``known`` go through the driver.  Rows that repeat a
    doc_id are pooled (the least whole-text name), a null doc_id is a document of
    its own, null and empty texts match nothing, other columns are ignored.
    """
    d = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), canonical_lines(empty_text()).alias("lines"))
    d = d.withColumn("counts", F.transform("lines", _words))
    unit = lambda text, at, n: F.struct(text.alias("text"), at.cast("int").alias("at"), n.cast("int").alias("n"))
    whole = F.array(unit(F.array_join("lines", " "), F.lit(None), F.lit(0)))
    units = F.concat(whole, F.transform("lines", lambda x, i: unit(x, i, F.lit(1))), F.transform(_runs(known), lambda r: unit(r["text"], r["at"], r["n"])))
    u = d.select("doc_id", "row", F.explode(units).alias("u")).select("doc_id", "row", "u.at", "u.n", F.sha2("u.text", 256).alias("digest"))
    small = row_total(known) <= BROADCAST_ROWS
    names = known.select("digest", "license")
    hit = u.join(F.broadcast(names) if small else names, "digest", "left")
    notice = F.col("at").isNotNull() & F.col("license").isNotNull()
    by_row = hit.groupBy("doc_id", "row").agg(
        F.min(F.when(F.col("at").isNull(), F.col("license"))).alias("license"),
        F.array_sort(F.collect_set(F.when(notice, F.col("license")))).alias("names"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when(notice, F.sequence("at", F.col("at") + F.col("n") - 1)))))).alias("n"))
    return by_row.groupBy("doc_id").agg(
        F.min("license").alias("license"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))), ",").alias("notices"),
        F.sum("n").cast("long").alias("n_notice_lines"))


def oracle(known=KNOWN) -> str:
    """DuckDB SQL of the scan of ``documents`` by one-line notices (no whole text, no run of lines)."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(t)}, {quote(n)})" for t, n in known)
    spell = "MAP {" + ", ".join(f"{quote(a)}: {quote(b)}" for a, b in SPELLINGS.items()) + "}"

    def lines(text: str) -> str:
        c = f"lower(regexp_replace({text}, '{COPYRIGHT_LINE}', '', 'g'))"
        c = f"regexp_replace(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), ' ?\\n[ \\n]*', ' \n ', 'g')"
        w = f"list_transform(string_split({c}, ' '), lambda w: coalesce({spell}[w], w))"
        return f"list_filter(list_transform(string_split(array_to_string({w}, ' '), '\n'), lambda x: trim(x)), lambda x: x <> '')"

    return f"""WITH known AS (
  SELECT sha256(array_to_string({lines('col0')}, ' ')) AS digest, min(col1) AS license FROM (VALUES {rows}) GROUP BY 1),
d AS (SELECT doc_id, {lines("coalesce(text, '')")} AS lines FROM documents),
u AS (SELECT doc_id, true AS whole, sha256(array_to_string(lines, ' ')) AS digest FROM d
      UNION ALL SELECT doc_id, false, sha256(line) FROM (SELECT doc_id, unnest(lines) AS line FROM d))
SELECT doc_id, min(license) FILTER (whole) AS license,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (NOT whole), '') AS notices,
       count(license) FILTER (NOT whole) AS n_notice_lines
FROM u LEFT JOIN known USING (digest) GROUP BY doc_id""".replace("\\n", "\n")
