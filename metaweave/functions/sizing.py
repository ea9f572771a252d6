"""Broadcast only behind a size check; numbers of tasks that follow the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold; beyond it the join is left to the planner
# (sort-merge or shuffled hash, AQE may still broadcast on measured size).
BROADCAST_MAX_ROWS = 1_000_000


def at_most(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (one counting job, stops early)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df``.

    The check is one counting job over ``df``; use it for sides that come from
    a small input (a query list, a key list), not for the big fact side.
    """
    return F.broadcast(df) if at_most(df, max_rows) else df


#: Bytes of the files read for which a job gets one more task.  Sorts of well-compressed rows take some fifty times that.
TASK_BYTES = 4 << 20
#: Sizes from here on are the planner's word for "unknown" (rows that lie in no file).
_UNKNOWN_BYTES = 1 << 60
#: Buckets of a saved table are limited; so many tasks are plenty.
MAX_TASKS = 50_000


def read_bytes(*dfs: DataFrame) -> int:
    """Sizes of the files that the scans of ``dfs`` read, as the planner lists them; runs nothing.  Rows from elsewhere count as none."""
    total = 0
    for df in dfs:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total += sum(s for s in sizes if s < _UNKNOWN_BYTES)
    return total


def tasks_for(*dfs: DataFrame, task_bytes: int | None = None) -> int:
    """Number of tasks to deal rows made from ``dfs`` among: the cluster's parallelism, or more, so that what one task sorts
    does not grow with the input.  (Adaptive execution merges shuffled partitions up to a size after compression, and
    aggregates over texts sort their whole input before the shuffle; both grow with the files.)"""
    return min(MAX_TASKS, max(dfs[0].sparkSession.sparkContext.defaultParallelism, -(-read_bytes(*dfs) // (task_bytes or TASK_BYTES))))


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it from the sizes of its files; runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
