"""Row identity: jobs of one operator that run on other numbers of cores must speak about the same rows."""

import pytest
from llm_helpers import edge_docs, prose
from pyspark.sql import functions as F

from lifeboat.llm import exact_dedup, simhash, substring_dedup
from lifeboat.llm.common import file_row, numbered, table

SF = "/root/testdata/sf0.1"
KEY = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture()
def twice(spark):
    docs = table(spark, SF, "documents")
    return docs.unionByName(docs)


@pytest.mark.parametrize("first,then", [(1, 16), (16, 1), (3, 7)])
def test_drops_after_a_change_of_cores(spark, twice, first, then):
    """The plan is made on some cores and its last job runs on others, as after a lost executor."""
    texts = twice.select(F.coalesce("text", F.lit(""))).distinct().count()
    try:
        spark.conf.set(KEY, first)
        left = exact_dedup.drop_copies(twice)
        spark.conf.set(KEY, then)
        assert left.count() == texts
    finally:
        spark.conf.unset(KEY)


def test_file_rows_do_not_depend_on_splits(spark, tmp_path):
    path = f"{tmp_path}/docs.parquet"
    edge_docs(spark).unionByName(edge_docs(spark)).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    row = file_row(docs)

    def numbers():
        return sorted((r["n"], r["text"] or "") for r in spark.read.parquet(path).select("text", row.alias("n")).collect())

    want = numbers()
    assert len({n for n, _ in want}) == docs.count()
    try:
        for cores, split in ((1, "1k"), (9, "100m"), (4, "64k")):
            spark.conf.set(KEY, cores)
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            assert numbers() == want
            kept = [r["id"] for r in exact_dedup.exact_dedup(docs, row=row).filter("kept").collect()]
            assert len(kept) == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    finally:
        spark.conf.unset(KEY)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_near_and_substring_rows(spark):
    rows = [(i % 3 or None, prose(i % 7, 200)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    try:
        spark.conf.set(KEY, 2)
        left, cut = simhash.keep_one(df), substring_dedup.remove_repeats(df)
        spark.conf.set(KEY, 11)
        assert left.count() == 7
        assert sorted(r["n_removed"] for r in cut.collect()) == [0] * 7 + [200] * 33
    finally:
        spark.conf.unset(KEY)


def test_numbered_keeps_names(spark):
    df = edge_docs(spark)
    assert numbered(df, None, "n_").columns == [*df.columns, "n_"]
