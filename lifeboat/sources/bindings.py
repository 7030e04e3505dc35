"""Bindings from the shared parquet tables to the passenger schema.

The test tables are generic (orders, customers, documents, ...). ``subjects``
reshapes ``orders JOIN customer`` into the passenger schema the feature rules
expect, with deterministic nulls and title-less names so every edge rule is
exercised. Every row of ``orders`` becomes one subject; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding: title by ``o_orderkey % 17`` (13-15 -> Mr,
# 16 -> a name without any title).
BINDING_TITLES = (
    "Mr", "Mrs", "Miss", "Master", "Dr", "Rev", "the Countess", "Mlle", "Ms", "Mme",
    "Jonkheer", "Dona", "Capt",
)

PASSENGER_COLUMNS = (
    "id", "label", "is_train", "pclass", "name", "sex", "age", "sibsp", "parch",
    "ticket", "fare", "cabin", "embarked",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as passengers: (id, label, is_train, pclass, name, sex, age, ...)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = F.col("o_orderkey")
    title_idx = (k % 17).cast("int")
    title = F.when(title_idx < len(BINDING_TITLES),
                   F.element_at(F.array(*[F.lit(t) for t in BINDING_TITLES]), title_idx + 1)
                   ).otherwise(F.lit("Mr"))
    name = F.when(k % 17 == 16, F.col("c_name")).otherwise(
        F.concat(F.col("c_name"), F.lit(", "), title, F.lit(". J")))
    cust = F.col("o_custkey").cast("string")
    return j.select(
        k.alias("id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        (k % 10 < 7).alias("is_train"),
        (F.col("c_nationkey") % 3 + 1).cast("int").alias("pclass"),
        name.alias("name"),
        F.when(k % 3 == 0, "female").otherwise("male").alias("sex"),
        F.when(k % 5 == 0, F.lit(None).cast("double"))
        .otherwise(((k * 7919 + F.col("o_custkey")) % 800).cast("double") / 10).alias("age"),
        (k % 4).cast("int").alias("sibsp"),
        (F.col("o_custkey") % 3).cast("int").alias("parch"),
        F.when(k % 3 == 0, cust).otherwise(F.concat(
            F.substring("o_orderpriority", 1, 1), F.lit("/"), F.col("c_mktsegment"),
            F.lit(". "), cust)).alias("ticket"),
        F.when(k % 97 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice") / 4000).alias("fare"),
        F.when(k % 4 != 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("cabin"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.substring("c_mktsegment", 1, 1)).alias("embarked"),
    )


def labelled_unlabelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two input sides of a run: labelled rows and unlabelled rows (no label)."""
    s = subjects(spark, sf_dir)
    labelled = s.filter(F.col("is_train")).drop("is_train")
    unlabelled = s.filter(~F.col("is_train")).drop("is_train", "label")
    return labelled, unlabelled


def document_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a labelled table with signal: ``quality`` is the label.

    Features are counted over the whole text. Documents without a label row
    are the unlabelled side (``is_train`` false, label null).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    words = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    lines = F.size(F.split(F.col("text"), "\n"))
    return j.select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("label"),
        F.col("quality").isNotNull().alias("is_train"),
        F.col("n_chars").cast("double").alias("n_chars"),
        words.cast("double").alias("n_words"),
        lines.cast("double").alias("n_lines"),
        F.col("lang"),
    )


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a train/query tag: every tenth vector is a query point."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("label"),
        (F.col("vec_id") % 10 != 0).alias("is_train"),
        F.transform("embedding", lambda v: v.cast("double")).alias("features"),
    )
