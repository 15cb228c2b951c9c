"""Line dedup by winnowing over line hashes, in DataFrame operations only.

A gram is the shortest run of lines from a line on that holds GRAM_WORDS words.
Of the grams that start within RUN_WORDS - GRAM_WORDS words of each other, the one
of least hash is a fingerprint, so any repeated run of RUN_WORDS words has one.  A
fingerprint's first place in a document is tied to its first place in the corpus,
its later places to the one before them; each tie, a pair of documents and an
offset, is extended both ways as far as lines are equal, and the later run goes.
A tie is one partner, so a run that shares only a part with it can be missed: the
shortest runs of RUN_WORDS words from every line on are grouped by hash as well, and
every place but the least of each goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldsafe.llm.common import empty_text, written

GRAM_WORDS, RUN_WORDS = 25, 50
_LEAST = -(1 << 63)
_DOC, _SOURCE = ["doc", "version"], ["source", "source_version"]


def _hash(text: Column) -> Column:
    """60 bits of the md5, which any SQL engine has."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _keys(docs: DataFrame) -> DataFrame:
    """A document is its doc_id (null: the least) and its text; the order of documents is that of these."""
    d = docs.withColumn("__text", empty_text())
    return d.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))).withColumn("__version", F.xxhash64("__text"))


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc, version, seq, pos, hash, words`` of the lines that have words; repeated rows once."""
    line = F.col("line")
    d = _keys(docs).select(F.col("__doc").alias("doc"), F.col("__version").alias("version"),
                           F.posexplode(F.split("__text", "\n")).alias("pos", "line"))
    d = d.select("doc", "version", "pos", _hash(F.trim(line)).alias("hash"),
                 F.regexp_count(line, F.lit(r"[^ \t\n\r\f]+")).cast("long").alias("words"))
    d = d.where("words > 0").repartition(*_DOC)
    again = F.row_number().over(Window.partitionBy("doc", "version", "pos").orderBy("hash"))
    d = d.withColumn("again", again).where("again = 1").drop("again")
    return d.withColumn("seq", F.row_number().over(Window.partitionBy(*_DOC).orderBy("pos")))


def fingerprints(lines: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """``doc, version, key, seq, before``: the selected grams, and the place of the same key before it in the document."""
    by = Window.partitionBy(*_DOC).orderBy("seq")
    d = lines.withColumn("at", F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    along = Window.partitionBy(*_DOC).orderBy("at")
    gram = along.rangeBetween(0, gram_words - 1)
    key = _hash(F.array_join(F.collect_list(F.col("hash").cast("string")).over(gram), ","))
    d = d.withColumn("key", F.when(F.sum("words").over(gram) >= gram_words, key))
    least = F.min(F.when(F.col("key").isNotNull(), F.struct("key", "seq"))).over(along.rangeBetween(0, run_words - gram_words - 1))
    d = d.withColumn("least", least).where("least is not null").select(*_DOC, "least.key", "least.seq").distinct()
    same = Window.partitionBy(*_DOC, "key").orderBy("seq")
    return d.withColumn("before", F.lag("seq").over(same))


def ties(found: DataFrame) -> DataFrame:
    """``doc, version, source, source_version, shift, anchors``: where a fingerprint occurred earlier."""
    inside = found.where("before is not null").select(
        *_DOC, F.col("doc").alias("source"), F.col("version").alias("source_version"), (F.col("before") - F.col("seq")).alias("shift"), "seq")
    firsts = found.where("before is null").select(*_DOC, "key", "seq")
    head = (firsts.groupBy("key").agg(F.min(F.struct("doc", "version", "seq")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select("key", F.col("h.doc").alias("source"), F.col("h.version").alias("source_version"), F.col("h.seq").alias("source_seq")))
    across = (firsts.join(head, "key").where("doc <> source or version <> source_version")
              .select(*_DOC, *_SOURCE, (F.col("source_seq") - F.col("seq")).alias("shift"), "seq"))
    return inside.union(across).groupBy(*_DOC, *_SOURCE, "shift").agg(F.collect_set("seq").alias("anchors"))


def repeated_runs(lines: DataFrame, tied: DataFrame) -> DataFrame:
    """``doc, version, first, last`` (positions): the runs that ties extend to."""
    theirs = lines.select(F.col("doc").alias("source"), F.col("version").alias("source_version"), F.col("seq").alias("source_seq"), "hash")
    mine = lines.join(tied, _DOC).withColumn("source_seq", F.col("seq") + F.col("shift"))
    equal = mine.join(theirs, [*_SOURCE, "source_seq", "hash"])
    tie = [*_DOC, *_SOURCE, "shift"]
    place = F.row_number().over(Window.partitionBy(*tie).orderBy("seq"))
    runs = equal.withColumn("run", F.col("seq") - place).groupBy(*tie, "run").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.max(F.array_contains("anchors", F.col("seq"))).alias("anchored"))
    return runs.where("anchored").select(*_DOC, "first", "last")


def equal_runs(lines: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """``doc, version, first, last`` (positions): the shortest runs of ``run_words`` words, but for the least place of each."""
    by = Window.partitionBy(*_DOC).orderBy("seq")
    d = lines.withColumn("at", F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    run = Window.partitionBy(*_DOC).orderBy("at").rangeBetween(0, run_words - 1)
    key = _hash(F.array_join(F.collect_list(F.col("hash").cast("string")).over(run), ","))
    d = d.select(*_DOC, F.col("pos").alias("first"), F.max("pos").over(run).alias("last"), key.alias("key"), F.sum("words").over(run).alias("n"))
    d = written(d.where(F.col("n") >= run_words).drop("n"), "runs")
    place = F.struct(*_DOC, "first")
    least = d.groupBy("key").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "least")
    # a table of its own, so that the join can split a hot key
    return d.join(written(least, "least-runs"), "key").where(place != F.col("least")).select(*_DOC, "first", "last")


def united(runs: DataFrame) -> DataFrame:
    """The runs of a document that overlap as one."""
    before = Window.partitionBy(*_DOC).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    d = runs.withColumn("new", F.coalesce(F.col("first") > F.max("last").over(before), F.lit(True)).cast("long"))
    d = d.withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*_DOC, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def _winnowed(lines: DataFrame, gram_words: int, run_words: int) -> DataFrame:
    return repeated_runs(lines, written(ties(written(fingerprints(lines, gram_words, run_words), "fingerprints")), "ties"))


def _without(d: DataFrame, runs: DataFrame) -> DataFrame:
    """``d`` with ``text`` less ``runs``, and ``deleted_lines``."""
    runs = united(runs.distinct()).groupBy(*_DOC).agg(F.collect_list(F.struct("first", "last")).alias("__runs"))
    runs = runs.select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), "__runs")
    out = _keys(d).join(runs, ["__doc", "__version"], "left")
    kept = F.filter(F.split("__text", "\n"), lambda x, i: ~F.exists("__runs", lambda r: (i >= r["first"]) & (i <= r["last"])))
    out = out.withColumn("__kept", F.when(F.col("__runs").isNotNull(), kept))
    gone = F.size(F.split("__text", "\n")) - F.size("__kept")
    out = out.withColumn("deleted_lines", F.when(F.col("__kept").isNull(), 0).otherwise(gone))
    out = out.withColumn("text", F.when(F.col("__kept").isNull(), F.col("text")).otherwise(F.array_join("__kept", "\n")))
    return out.select(*d.columns, "deleted_lines")


def dedup_lines(docs: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with ``text`` less the later repeated runs of lines that winnowing ties, and ``deleted_lines``.

    Lines are compared without outer spaces; blank lines never count, and go with a
    run that they stand in.  The first place, by doc_id (null first), text hash and
    line, stays.  A fingerprint has one partner, so a run of ``run_words`` words can
    stay if that partner shares only a part of it: ``dedup_every_run`` has no such gap.
    Rows equal in doc_id and text are one document and get the same result.  A null
    text stays null; other columns stay (``deleted_lines`` is replaced).
    """
    d = docs.drop("deleted_lines")
    return _without(d, _winnowed(written(lines_of(d), "lines"), gram_words, run_words))


def dedup_every_run(docs: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """As ``dedup_lines``, and every repeated run of ``run_words`` words or more, in the document or across documents, goes."""
    d = docs.drop("deleted_lines")
    lines = written(lines_of(d), "lines")
    return _without(d, _winnowed(lines, gram_words, run_words).union(equal_runs(lines, run_words)))
