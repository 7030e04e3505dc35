"""Corpus pipeline: five stages over ``documents``, each calling one operator of ``lifeboat.llm``.

Every stage takes what its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.

1. toxicity: rows that the ordinal model rates toxic go (model fitted on ``labels``);
2. exact dedup: of equal texts the row with the largest doc_id stays;
3. SimHash near-dedup (words in threes, three bits): the row with the smallest doc_id of each component stays;
4. decontamination: rows that contain an item of ``benchmark`` go;
5. best-fit packing: one row per piece with its bin, offset and capacity.

An empty table passes through every stage as an empty result; null texts
count as empty (see the operators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeboat.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from lifeboat.llm.common import file_row, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.col("toxic"))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, row=file_row(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, row=file_row(docs))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"), row=file_row(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]

# The fitted model, the fingerprints, the latent retrieval and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}
