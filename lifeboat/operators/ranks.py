"""Exact ranks inside groups without a task per group.

A window ``partitionBy(group)`` puts a whole group into one task. Here the
rows are range-partitioned by (group, order), so a hot group spreads over as many
partitions as its rows need; one small table of sums per (partition, group)
gives every partition its offset, and the running sum is taken inside
(partition, group). Rows with equal keys always share a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifeboat.operators.layout import stage


def rank_in_groups(df: DataFrame, groups, order, weight: str | None = None, name: str = "rank", total: str | None = None) -> DataFrame:
    """Add ``name``: rows (or the sum of ``weight``) before this row in its group, by ``order``; and ``total``, that of the group.

    The ranged rows are staged once, which fixes the partition each row is in.
    """
    groups, order = list(groups), list(order)
    one = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    ranged = stage(df.withColumn("_w", one).repartitionByRange(*groups, *order)
                   .withColumn("_pid", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_pid", *groups).agg(F.sum("_w").alias("_s"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) if groups else None
    if before is None:
        before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    every = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    offsets = sums.select(F.sum("_s").over(every).alias("_total"), F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                          F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    same = F.col("_pid") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    run = Window.partitionBy("_pid", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumn("_run", F.coalesce(F.sum("_w").over(run), F.lit(0))).join(offsets, same)
    out = out.withColumn(name, F.col("_run") + F.col("_off"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_w", "_pid", "_run", "_p", "_off", "_total", *[f"_g{i}" for i in range(len(groups))])
