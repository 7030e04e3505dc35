"""Iterative fits of many short steps over packed blocks that stay in the executors.

A step is one small job: each task goes through its blocks and hands on fixed-size sums. The blocks are read from the shared
folder once and persisted, so that a step costs neither planning nor a scan; a lost executor reads its blocks again.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that keep a task busy: below that, starting another one costs more than it saves.
ROWS_PER_TASK = 8_192
#: Rows of a task at most.
MOST_ROWS = 1 << 20


def tasks_for(blocks: DataFrame) -> int:
    """Tasks for the rows of the blocks (``n`` each): as many as run at once, if the rows keep them busy, and more for very many rows."""
    rows = blocks.agg(F.sum("n")).first()[0] or 0
    return max(1, min(-(-rows // ROWS_PER_TASK), max(blocks.sparkSession.sparkContext.defaultParallelism, -(-rows // MOST_ROWS))))


def held(blocks: DataFrame, key: str | None = None) -> RDD:
    """The blocks dealt evenly to ``tasks_for`` partitions; with ``key`` by its hash and in its order, so that sums are the same to the bit in every run."""
    tasks = tasks_for(blocks)
    return (blocks.repartition(tasks) if key is None else blocks.repartition(tasks, key).sortWithinPartitions(key)).rdd


def added(rows: RDD, work: Callable[[object], list[np.ndarray]]) -> list[np.ndarray]:
    """The arrays that ``work`` returns for an element, added up over all (one list per task goes to the driver)."""
    def run(elements):
        total = None
        for e in elements:
            got = work(e)
            total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
        return [] if total is None else [total]

    out: list[np.ndarray] = []
    for got in rows.mapPartitions(run).collect():
        out = [a + b for a, b in zip(out, got, strict=True)] if out else got
    return out


def run_parallel(tasks, parallelism: int) -> list:
    """Run independent fit/evaluate closures on a thread pool, results in order.

    Each closure submits its own Spark jobs; running a few at once keeps the
    cluster busy during the small, sequential steps of every fit (the same
    knob as ``CrossValidator(parallelism=...)``).
    """
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        return list(pool.map(lambda t: t(), tasks))
