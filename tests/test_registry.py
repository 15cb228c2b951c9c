"""The run registry: atomic commits, writers at the same time, killed writers, restarts, nested runs."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from foldsafe.sources import registry as RG

SCHEMA = "k string, v long"


def rows(spark, *values):
    return spark.createDataFrame([(f"k{v}", v) for v in values], SCHEMA)


def values(df):
    return sorted(r["v"] for r in df.collect())


@pytest.fixture(params=["", "file://"])
def path(request, tmp_path):
    return f"{request.param}{tmp_path}/reg"


def test_commits_versions_and_a_restart(spark, path):
    reg = RG.Registry(spark, path, SCHEMA)
    assert reg.version() == 0 and reg.read().count() == 0 and reg.read().columns == ["k", "v"]
    assert reg.append(rows(spark, 1, 2)) == 1
    held = reg.read()
    assert reg.append(rows(spark, 3)) == 2 and reg.append(rows(spark)) == 3
    again = RG.Registry(spark, path, SCHEMA)
    assert again.version() == 3 and values(again.read()) == [1, 2, 3] and values(again.read(1)) == [1, 2]
    assert again.replace(again.read().where("v > 1"), 3) == 4
    assert values(reg.read()) == [2, 3] and values(reg.read(2)) == [1, 2, 3] and values(held) == [1, 2]
    assert again.append(rows(spark, 9)) == 5 and values(reg.read()) == [2, 3, 9]
    with pytest.raises(ValueError):
        reg.read(6)


def test_a_replacement_of_an_old_version_changes_nothing(spark, path, monkeypatch):
    one, two = (RG.Registry(spark, path, SCHEMA) for _ in range(2))
    seen = one.append(rows(spark, 1))
    two.append(rows(spark, 2))
    with pytest.raises(RG.Conflict):
        one.replace(rows(spark, 7), seen)
    monkeypatch.setattr(one, "version", lambda: seen)              # the other commits between the check and the rename
    with pytest.raises(RG.Conflict):
        one.replace(rows(spark, 7), seen)
    assert values(two.read()) == [1, 2]


def test_a_rename_onto_another_commit_is_seen_and_undone(spark, path):
    reg = RG.Registry(spark, path, SCHEMA)
    reg.append(rows(spark, 1))
    staged = reg._stage(rows(spark, 2), replaces=False)
    reg._fs.rename(reg._at(staged), reg._at(reg._commit(1), os.path.basename(staged)))      # as a lost race leaves it
    assert values(reg.read()) == [1]
    with pytest.raises(RG.Conflict):
        reg._publish(staged, 1)
    assert reg._publish(staged, 2) == 2 and values(reg.read()) == [1, 2]


def test_a_killed_writer_leaves_no_rows(spark, path):
    reg = RG.Registry(spark, path, SCHEMA)
    reg.append(rows(spark, 1))
    reg._stage(rows(spark, 5), replaces=True)                      # killed before its rename
    with pytest.raises(Exception):
        reg.append(rows(spark, 6, 7).withColumn("v", F.expr("if(v = 7, raise_error('killed'), v)")))
    assert reg.version() == 1 and values(RG.Registry(spark, path, SCHEMA).read()) == [1]
    assert reg.append(rows(spark, 8)) == 2 and values(reg.read()) == [1, 8]


def test_writers_at_the_same_time_lose_nothing(spark, path):
    def write(start):
        reg = RG.Registry(spark, path, SCHEMA)
        for v in range(start, start + 4):
            reg.append(rows(spark, v))
    threads = [threading.Thread(target=write, args=(s,)) for s in (0, 100, 200)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    reg = RG.Registry(spark, path, SCHEMA)
    assert reg.version() == 12 and values(reg.read()) == [s + i for s in (0, 100, 200) for i in range(4)]
    assert not glob.glob(path.removeprefix("file://") + "/commits/*/_stage*")


def test_nested_runs_and_the_best(spark, path):
    df = spark.createDataFrame([("a", 1, "s", 0.5, None), ("a", 2, "s", 0.3, 4.0), ("a", 3, "s", float("nan"), 1.0), ("a", 4, "s", None, 1.0)],
                               "e string, id long, up string, score double, c double")
    reg = RG.Registry(spark, path)
    reg.append(RG.as_runs(df, F.col("e"), F.col("id"), F.lit("FINISHED"), ["c"], ["score"], F.col("up")))
    top = spark.createDataFrame([("a", "s", 0.4), ("a", "r", 0.4), ("a", "t", 0.1)], "e string, id string, score double")
    reg.append(RG.as_runs(top, F.col("e"), F.col("id"), F.when(F.col("id") == "t", "FAILED").otherwise("FINISHED"), (), {"score": F.col("score")}))
    log = reg.read()
    assert {r["run_id"]: (r["parent_run_id"], r["params"], r["metrics"]) for r in log.where("run_id in ('1', '4', 's')").collect()} == {
        "1": ("s", {}, {"score": 0.5}), "4": ("s", {"c": "1.0"}, {}), "s": (None, {}, {"score": 0.4})}
    assert [tuple(r) for r in RG.best_runs(log, "score").collect()] == [("a", "r", None, {}, 0.4, 2)]
    assert [tuple(r) for r in RG.best_runs(log, "score", nested=True).collect()] == [("a", "2", "s", {"c": "4.0"}, 0.3, 2)]
    assert RG.best_runs(log, "score", lower=False, nested=True).first()["run_id"] == "1"
    assert RG.best_runs(log.limit(0), "score").count() == 0
