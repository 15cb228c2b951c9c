"""Run registry with atomic commits.

A registry is a folder of numbered commits, each a Parquet folder of its own.  A
writer fills a staging folder through Spark's commit protocol and then renames it
to the next number, which fails if another writer was first: it is the only step
that others can see, so a killed writer leaves nothing but an unread staging folder.
The state is the commits from the last replacing one on.  Nothing is rewritten in
place: a reader keeps the version it has opened, and after a restart the version is
simply the last number in the folder.  The file system's rename of a folder must be
atomic, as on HDFS or a shared mount.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RUN_SCHEMA = "run_id string, parent_run_id string, experiment string, status string, params map<string,string>, metrics map<string,double>"
RETRIES = 50
REPLACES = "_replaces"          # marks a commit that takes the place of all before it


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was to make."""


class Registry:
    """The registry in the folder ``path``, which all executors must reach; ``schema`` is that of its rows."""

    def __init__(self, spark: SparkSession, path: str, schema: str = RUN_SCHEMA):
        self.spark, self.path, self.schema = spark, path, schema
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at(path).getFileSystem(self._conf)
        self._fs.mkdirs(self._at(path, "commits"))

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path(os.path.join(*parts))

    def _commit(self, version: int) -> str:
        return os.path.join(self.path, "commits", f"{version:020d}")

    def version(self) -> int:
        """The number of the last commit; 0 without any."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path, "commits"))]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The state at ``version`` (default: now).  Later commits do not change a frame once it is made."""
        last = self.version() if version is None else version
        if not 0 <= last <= self.version():
            raise ValueError(f"there is no version {last}")
        paths = []
        for v in range(last, 0, -1):
            paths.append(self._commit(v))
            if self._fs.exists(self._at(paths[-1], REPLACES)):
                break
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def append(self, rows: DataFrame) -> int:
        """Add rows in one commit and return its version.  Appends of several writers do not
        conflict: one that comes second takes the next number, its files are not written again."""
        staged = self._stage(rows, replaces=False)
        for _ in range(RETRIES):
            try:
                return self._publish(staged, self.version() + 1)
            except Conflict:
                continue
        raise Conflict(f"{RETRIES} other commits came first")

    def replace(self, rows: DataFrame, expected: int) -> int:
        """Put rows in the place of the whole state, if it is still at version ``expected``; else :class:`Conflict`
        and no change.  ``rows`` may be made from the state itself."""
        if self.version() != expected:
            raise Conflict(f"version {expected} was expected, {self.version()} found")
        return self._publish(self._stage(rows, replaces=True), expected + 1)

    def _stage(self, rows: DataFrame, replaces: bool) -> str:
        staged = os.path.join(self.path, "staging", f"_stage-{uuid.uuid4().hex}")
        shape = self.spark.createDataFrame([], self.schema).schema
        rows.select(*[F.col(f.name).cast(f.dataType) for f in shape]).write.parquet(staged)
        self._fs.create(self._at(staged, self._token(staged))).close()
        if replaces:
            self._fs.create(self._at(staged, REPLACES)).close()
        return staged

    @staticmethod
    def _token(staged: str) -> str:
        return "_token" + os.path.basename(staged)

    def _publish(self, staged: str, version: int) -> int:
        """Rename to the version's name; the token tells whose commit stands there."""
        target = self._commit(version)
        if not self._fs.exists(self._at(target)):
            self._fs.rename(self._at(staged), self._at(target))
        if not self._fs.exists(self._at(target, self._token(staged))):
            # where a rename onto a folder moves into it, the rows come back out of the other writer's commit
            inside = self._at(target, os.path.basename(staged))
            if self._fs.exists(inside):
                self._fs.rename(inside, self._at(staged))
            raise Conflict(f"version {version} is another writer's")
        return version


def _entries(cols: Mapping[str, Column] | Sequence[str], kind: str) -> Column:
    """A map of the columns that are not null."""
    cols = cols if isinstance(cols, Mapping) else {c: F.col(c) for c in cols}
    if not cols:
        return F.expr(f"cast(map() as map<string,{kind}>)")
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), c.cast(kind).alias("value")) for k, c in cols.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def as_runs(df: DataFrame, experiment: Column, run_id: Column, status: Column, params: Mapping[str, Column] | Sequence[str] = (),
            metrics: Mapping[str, Column] | Sequence[str] = (), parent: Column | None = None) -> DataFrame:
    """Rows as runs: parameters as strings, metrics as doubles, nulls left out of both; ``parent`` is the run
    they belong to (none: a run of its own)."""
    up = parent if parent is not None else F.lit(None)
    return df.select(run_id.cast("string").alias("run_id"), up.cast("string").alias("parent_run_id"), experiment.cast("string").alias("experiment"),
                     status.cast("string").alias("status"), _entries(params, "string").alias("params"), _entries(metrics, "double").alias("metrics"))


def best_runs(runs: DataFrame, metric: str, lower: bool = True, nested: bool = False) -> DataFrame:
    """Per experiment the finished run of best ``metric``, ties to the least run_id; runs of their own,
    or with ``nested`` those that have a parent.  Runs without the metric, or with NaN, take no part."""
    value = F.try_element_at("metrics", F.lit(metric))
    level = F.col("parent_run_id").isNotNull() if nested else F.col("parent_run_id").isNull()
    able = runs.where(level & (F.col("status") == "FINISHED")).withColumn("__value", value).where("__value is not null and not isnan(__value)")
    order = F.struct(F.col("__value") if lower else -F.col("__value"), F.col("run_id"))
    return able.groupBy("experiment").agg(F.min_by(F.struct("run_id", "parent_run_id", "params", F.col("__value").alias(metric)), order).alias("b"),
                                          F.count(F.lit(1)).alias("n_runs")).select("experiment", "b.*", "n_runs")
