"""Partition layout for iterative fits, and staging of tables that several steps scan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lifeboat.session import scratch_path

#: Partitions a model is fitted on at least: a setting, not a function of cores.
FIT_PARTITIONS = 16
#: Rows of such a partition, about: more rows are fitted on more partitions.
FIT_ROWS = 25_000


def partitions_for(rows: int, least: int = FIT_PARTITIONS) -> int:
    """Partitions that ``rows`` rows are fitted on, by their number alone."""
    return max(least, -(-rows // FIT_ROWS))


def spread(df: DataFrame, partitions: int = FIT_PARTITIONS, key: str = "id") -> DataFrame:
    """Rows of an iterative fit in a fixed layout: hashed by ``key`` into ``partitions``, sorted inside.

    Spark's bagging draws per partition, so a model depends on which rows share
    a partition and in what order. Both are fixed here by the keys and one
    number (``partitions_for``: a setting, or more for many rows), so
    the same rows and seed give the same model on any cluster.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    A join of big tables runs once, every later scan reads only the columns
    it needs, and the lineage is cut, so a lost executor costs a re-read
    from shared storage instead of a recompute.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
