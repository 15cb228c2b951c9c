"""Learners read the split table; the join and the ranking that make it don't run again for each of their passes."""

import pytest

from foldsafe.operators.splits import split_random
from foldsafe.plans import q_learners, q_scoring
from foldsafe.plans.frames import districts, districts_split
from tests.conftest import SMALL


def test_written_split_is_the_split(spark):
    want = split_random(districts(spark, SMALL), "row_id", 0.2, 42)
    got = districts_split(spark, SMALL)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("frame", [lambda s: q_learners._features(s, SMALL)[0], lambda s: q_scoring._raw_split(s, SMALL)])
def test_learners_start_from_the_written_split(spark, frame):
    plan = frame(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_booster_reads_rows_made_once(spark, monkeypatch):
    seen = []

    def fit(self, rows, params=None):
        seen.append((rows.storageLevel.useMemory, rows))
        return real(self, rows, params)

    real = q_scoring.GBTRegressor.fit
    monkeypatch.setattr(q_scoring.GBTRegressor, "fit", fit)
    d, m = q_scoring._pipeline_model(spark, SMALL)
    assert [kept for kept, _ in seen] == [True] and not seen[0][1].storageLevel.useMemory
    assert "prediction" in m.transform(d).columns and len(m.stages) == 5
