"""File sources and sinks on the shared storage.

Every path lives under the cluster's shared checkpoint folder (or a path the
caller gives); nothing is written to a machine-local directory on a cluster.
Writes go through Spark's commit protocol, so a lost executor never leaves a
half-written table behind.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from foldsafe.session import scratch_path


def tag(*parts: str) -> str:
    """Stable short name for an intermediate derived from its inputs."""
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:12]


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A1: headered CSV with an explicit schema (never inferSchema)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """A10: scored rows to headered CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def cached_ingest(spark: SparkSession, build, name: str) -> DataFrame:
    """A2: materialise a raw source once under the shared folder; later calls
    reuse it.  ``mode('ignore')`` makes concurrent first runs safe."""
    path = scratch_path(spark, f"ingest/{name}")
    if not _exists(spark, path):
        build().write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS")))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """A3: Parquet table, optionally partitioned (later filters prune folders)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_registry(runs: DataFrame, path: str, partition_by: Sequence[str] = ("experiment",)) -> None:
    """Append runs (or one-candidate batches) to the registry table.
    Each append is one atomic job commit; the state is never rewritten."""
    runs.write.mode("append").partitionBy(*partition_by).parquet(path)


def with_optional(df: DataFrame, optional: Sequence[str], fill_type: str = "double") -> DataFrame:
    """A missing optional column becomes NULL (its branch then drops out)
    and ``has_<col>`` records whether the source had it.  Plan-time check."""
    present = set(df.columns)
    out = df
    for c in optional:
        out = out.withColumn(f"has_{c}", F.lit(c in present))
        if c not in present:
            out = out.withColumn(c, F.lit(None).cast(fill_type))
    return out


def row_arrays(df: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Positional export rows: doubles rounded, NaN -> NULL, in column order."""
    def cell(c):
        x = F.col(c).cast("double")
        return F.when(F.isnan(x), F.lit(None)).otherwise(F.round(x, digits))
    return df.select(F.array(*[cell(c) for c in cols]).alias("row"))
