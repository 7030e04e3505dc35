"""Exact distributed quantiles, stratified split and folds, class weights (V1, V2, V6)."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lifeboat.operators import quantile, split


def _np_quantile(vals, p):
    return float(np.quantile(np.asarray(vals, dtype=float), p))


def test_quantiles_match_numpy_with_forced_bracketing(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.normal(size=3000)) + [0.5] * 500 + [2.0] * 500
    df = spark.createDataFrame([(float(v),) for v in vals], "x DOUBLE")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    # local_limit small -> the sketch/verify/narrow path runs, not just a local sort
    got = quantile.quantiles(df, "x", probs, local_limit=100)
    assert got == [_np_quantile(vals, p) for p in probs]


def test_quantiles_all_ties(spark):
    df = spark.createDataFrame([(1.0,)] * 1000, "x DOUBLE")
    assert quantile.quantiles(df, "x", [0.25, 0.5], local_limit=10) == [1.0, 1.0]


def test_quantiles_ignore_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (4.0,), (2.0,)], "x DOUBLE")
    assert quantile.median(df, "x") == 3.0
    assert quantile.median(df.where("x > 10"), "x") is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60))
def test_median_property(spark, xs):
    df = spark.createDataFrame([(float(v),) for v in xs], "x DOUBLE")
    assert quantile.median(df, "x", local_limit=4) == _np_quantile(xs, 0.5)


def _labelled(spark, n0, n1):
    rows = [(i, 0) for i in range(n0)] + [(n0 + i, 1) for i in range(n1)]
    return spark.createDataFrame(rows, "id BIGINT, label INT")


def test_stratified_split_sizes_and_determinism(spark):
    d = _labelled(spark, 103, 41)
    a = split.stratified_split(d, seed=45, ratio=0.2)
    sizes = {r["label"]: r["n"] for r in a.where("is_val = 1").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: math.ceil(103 * 0.2), 1: math.ceil(41 * 0.2)}
    b = split.stratified_split(d, seed=45, ratio=0.2)
    key = lambda df: sorted(r["id"] for r in df.where("is_val = 1").collect())
    assert key(a) == key(b)
    assert key(a) != key(split.stratified_split(d, seed=2025, ratio=0.2))
    assert a.count() == 144


def test_stratified_folds_sizes(spark):
    d = _labelled(spark, 10, 8)
    f = split.stratified_folds(d, seed=7, folds=3)
    got = sorted((r["label"], r["fold"], r["n"]) for r in
                 f.groupBy("label", "fold").agg(F.count("*").alias("n")).collect())
    assert got == [(0, 0, 4), (0, 1, 3), (0, 2, 3), (1, 0, 3), (1, 1, 3), (1, 2, 2)]


def test_class_weights_balanced(spark):
    w = {r["label"]: r["weight"] for r in split.class_weights(_labelled(spark, 30, 10)).distinct().collect()
         if True}
    assert w[0] == 40 / (2 * 30) and w[1] == 40 / (2 * 10)


def test_order_statistics_heavy_ties_at_both_ends(spark):
    # the sketch cannot narrow an interval whose ends are huge ties: the bisection path runs
    vals = [0.0] * 400 + [float(i) for i in range(1, 41)] + [100.0] * 400
    df = spark.createDataFrame([(v,) for v in vals], "x DOUBLE")
    srt = sorted(vals)
    ranks = [0, 399, 400, 420, 439, 440, 839]
    got = quantile.order_statistics(df, "x", ranks, local_limit=5, accuracy=10)
    assert got == {r: srt[r] for r in ranks}
    # with room for the 42 distinct values the stuck item is resolved grouped instead
    got = quantile.order_statistics(df, "x", ranks, local_limit=50, accuracy=10)
    assert got == {r: srt[r] for r in ranks}


def test_split_rejects_null_and_repeated_ids(spark):
    import pytest
    for rows in ([(None, 0), (1, 1)], [(1, 0), (1, 1), (2, 0)]):
        with pytest.raises(ValueError):
            split.stratified_split(spark.createDataFrame(rows, "id BIGINT, label INT"))


def test_split_folds_and_weights_of_many_labels(spark):
    d = spark.range(4_500).selectExpr("id", "concat('c', id % 1500) AS label")
    a = split.stratified_split(d, ratio=0.5)
    assert a.where("is_val = 1").groupBy("label").count().where("count <> 2").isEmpty()
    f = split.stratified_folds(d, folds=3)
    assert f.groupBy("label", "fold").count().where("count <> 1").isEmpty() and f.count() == 4_500
    assert split.class_weights(d).where("weight <> 1.0").isEmpty()


def test_split_keeps_rows_without_a_label_out_of_validation(spark):
    d = spark.createDataFrame([(i, None if i > 5 else i % 2) for i in range(10)], "id BIGINT, label INT")
    a = split.stratified_split(d, ratio=0.5)
    assert a.where("label IS NULL AND is_val <> 0").isEmpty() and a.count() == 10


def test_ranks_spread_a_hot_group(spark):
    from lifeboat.operators.ranks import rank_in_groups
    d = spark.range(3_000).selectExpr("CASE WHEN id % 10 < 9 THEN 'hot' WHEN id % 20 = 9 THEN NULL ELSE 'cold' END AS g", "(id * 7) % 3001 AS v")
    got = rank_in_groups(d, ["g"], ["v"])
    want = {}
    for r in d.collect():
        want.setdefault(r["g"], []).append(r["v"])
    assert sorted((str(r["g"]), r["v"], r["rank"]) for r in got.collect()) == sorted(
        (str(g), v, i) for g, vs in want.items() for i, v in enumerate(sorted(vs)))


def test_split_takes_few_jobs(spark):
    tracker, group = spark.sparkContext.statusTracker(), "split-jobs"
    d = _labelled(spark, 300, 99)
    spark.sparkContext.setJobGroup(group, "split")
    split.stratified_split(d)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 12, jobs
