"""Deterministic stratified split, stratified folds and class weights.

Each row gets a seeded hash key ``u`` in [0, 1) from its id. Inside every
label, rows are ordered by (u, id); the first ceil(ratio * n_label) rows are
the validation part (exact per-label sizes, like a stratified split). The
ranks come from ``ranks.rank_in_groups`` over (id, label) only, for all labels
together, so no task sorts a whole label (a binary label would otherwise put
half of the table into a single window partition). The rows at the cuts, one
per label and cut, are joined to the table, and comparing with a cut is a
per-row expression: the table itself is not shuffled.

Ids must be present and unique; null or repeated ids raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.operators.lookup import attach
from lifeboat.operators.ranks import rank_in_groups

_TWO_52 = float(2 ** 52)


def split_key(id_col: str, seed: int) -> Column:
    """Seeded uniform key in [0, 1): first 52 bits of md5('<id>:<seed>')."""
    h = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(_TWO_52)


def _ranked(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """(label, _u, id, rank, _n) of every labelled row; raises on null or repeated ids."""
    slim = df.select(F.col(label).alias("_label"), F.col(id_col).alias("_id"))
    bad = slim.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("_id").isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"{id_col}: the value {bad[0]['_id']!r} is on {bad[0]['n']} rows; a split needs one id per row")
    slim = slim.where(F.col("_label").isNotNull()).withColumn("_u", split_key("_id", seed))
    return rank_in_groups(slim, ["_label"], ["_u", "_id"], total="_n")


def _cut_table(ranked: DataFrame, label: str, at: Column, names: list[str]) -> DataFrame:
    """One row per label: for each name a struct (u, id) of the first row past that cut, null where all rows are before it.

    ``at`` is the array of the cuts' ranks in the label.
    """
    past = [F.min(F.when(F.col("rank") == at[i], F.struct("_u", "_id"))).alias(n) for i, n in enumerate(names)]
    return ranked.where(F.array_contains(at, F.col("rank"))).groupBy(F.col("_label").alias(label)).agg(*past)


def _after(name: str, id_col: str) -> Column:
    """Is the row at or past the cut ``name``?"""
    here = F.struct(F.col("_u"), F.col(id_col).alias("_id"))
    return F.coalesce(here >= F.col(name), F.lit(False)).cast("int")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "id", seed: int = 45,
                     ratio: float = 0.2, name: str = "is_val") -> DataFrame:
    """V1: add ``name`` (0/1); exactly ceil(ratio * n_c) validation rows per class; rows without a label get 0."""
    ranked = _ranked(df, label, id_col, seed)
    k = F.array(F.ceil(F.col("_n") * F.lit(ratio)).cast("long"))
    out = attach(df, _cut_table(ranked, label, k, ["_cut"]), label).withColumn("_u", split_key(id_col, seed))
    part = F.when(F.col(label).isNull(), 0).otherwise(1 - _after("_cut", id_col))
    return out.withColumn(name, part.cast("int")).drop("_u", "_cut")


def ntile_sizes(n: int, buckets: int) -> list[int]:
    q, rem = divmod(n, buckets)
    return [q + 1 if i < rem else q for i in range(buckets)]


def stratified_folds(df: DataFrame, label: str = "label", id_col: str = "id", seed: int = 45,
                     folds: int = 3, name: str = "fold") -> DataFrame:
    """V2: per class, contiguous (u, id)-ordered blocks of ntile sizes -> fold 0..folds-1; rows without a label get 0."""
    ranked = _ranked(df, label, id_col, seed)
    n, q = F.col("_n"), F.floor(F.col("_n") / folds)
    at = F.array(*[(F.lit(i) * q + F.least(F.lit(i).cast("long"), n % folds)).cast("long") for i in range(1, folds)])
    names = [f"_cut{i}" for i in range(1, folds)]
    out = attach(df, _cut_table(ranked, label, at, names), label).withColumn("_u", split_key(id_col, seed))
    fold = sum((_after(c, id_col) for c in names), F.lit(0))
    return out.withColumn(name, F.when(F.col(label).isNull(), 0).otherwise(fold).cast("int")).drop("_u", *names)


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """V6: ``class_weight='balanced'``: n / (n_classes * n_c) per row; rows without a label get null."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total, classes = counts.agg(F.sum("_n"), F.count(F.lit(1))).first()
    weights = counts.select(label, (F.lit(float(total or 0)) / (F.lit(int(classes)) * F.col("_n"))).alias(name))
    return attach(df.drop(name), weights, label)
