"""Small helpers shared by the operators: tables, row identity, staging, Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeboat.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, underscored until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    The lineage ends at the written table, so a lost executor costs a re-read
    and values such as row numbers stay what they were.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_row(df: DataFrame) -> Column | None:
    """A row number of a table read from parquet files as it is (selected or filtered at most): file and place in the file.

    It does not depend on how the files are split into tasks, so jobs that run
    apart, on other numbers of executors, number a row alike. The upper half is a hash of
    the file's path; the paths (the driver lists them to read the table) are checked
    for clashes, and another salt is taken until there are none. None if 100 salts
    clash (over some 100,000 files) or ``df`` is no such table: ``numbered`` then stages the rows with their numbers.
    """
    try:
        paths = [r[0] for r in df.select("_metadata.file_path").distinct().collect()]
    except AnalysisException:
        return None
    for salt in map(str, range(100)):
        if len({xxhash.xxh64_intdigest((salt + p).encode(), 42) >> 33 for p in paths}) == len(paths):
            # Spark's xxhash64 is XXH64 with seed 42; 31 bits of it, then 32 bits of the place (a file has fewer rows).
            file = F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(salt), F.col("_metadata.file_path"))), 33)
            return F.shiftleft(file, 32) + F.col("_metadata.row_index")
    return None


def numbered(df: DataFrame, row: Column | None, name: str, columns: list[Column] | None = None) -> DataFrame:
    """``df`` (or ``columns`` over it) and a long column ``name`` that stays the same in every job over it.

    ``row`` is an expression that says so by itself (``file_row``); without one
    the rows are staged together with their numbers, once.
    """
    columns = [F.col("*")] if columns is None else columns
    if row is not None:
        return df.select(*columns, row.alias(name))
    return stage(df.select(*columns, F.monotonically_increasing_id().alias(name)), "rows")


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def map_columns(df: DataFrame, columns: list[Column], schema: str,
                fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` over the named expressions only, so the scan reads no others."""
    return df.select(*columns).mapInArrow(fn, schema)
