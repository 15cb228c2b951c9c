"""Size-checked broadcast.

A broadcast hint is only given after the table's row count is checked (one
small job that stops at ``max_rows + 1``); above the bound the join is left
to the planner (sort-merge, or AQE's own runtime size check).  Tables that
are bounded by construction (folds, histogram bins, ranges built on the
driver) use ``F.broadcast`` directly, with the bound stated next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
