"""Attaching per-key statistics back to rows.

A statistics table (one row per key) is staged once; Spark then knows its
size in bytes and broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``,
otherwise it plans a shuffle join, whose skewed partitions AQE splits. Rows
with a null key match nothing; they are spread over the shuffle by a salt
instead of meeting in one partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat.operators.layout import stage

NULL_SALTS = 1_024


def bounded_rows(df: DataFrame, limit: int):
    """Rows of ``df`` if it has at most ``limit`` rows, else None (one bounded action)."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def attach(df: DataFrame, stats: DataFrame, keys) -> DataFrame:
    """Left-join per-key statistics onto ``df``; null keys get null statistics."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salted = df.withColumn("_salt", F.when(no_key, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS))).otherwise(0).cast("int"))
    side = stage(stats, "statistics").withColumn("_salt", F.lit(0))
    order = df.columns + [c for c in stats.columns if c not in df.columns]
    return salted.join(side, on=[*keys, "_salt"], how="left").select(*[f"`{c}`" for c in order])


def literal_map(pairs) -> F.Column:
    """A ``map`` literal from (key, value) pairs (for small, collected dictionaries)."""
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)
