"""The booster against a search over all splits, on any partitioning, and its stop rule against an independent log-loss."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lifeboat.operators import boosting as B
from lifeboat.operators import metrics
from lifeboat.operators import together as T


def table(spark, n=160, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (n, d)), 1)
    x[:, 3] = rng.integers(0, 3, n)
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 3] + rng.normal(0, 0.7, n) > 0).astype(float)
    rows = [(i, float(y[i]), x[i].tolist(), i % 4) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, x array<double>, fold int").withColumn("features", array_to_vector("x"))
    return df, x, y


def force_tree(x, g, h, s, depth):
    """Every cut between distinct values of every column, by its gain; -> nested (column, cut, left, right) or a leaf value."""
    def gain(i):
        best = (1e-9, None)
        G, H = g[i].sum(), h[i].sum()
        for f in range(x.shape[1]):
            v = np.unique(x[i, f])
            all_v = np.unique(x[:, f])
            for a, b in zip(all_v, all_v[1:]):
                c = (a + b) / 2
                left, right = i[x[i, f] <= c], i[x[i, f] > c]
                if not len(left) or not len(right):
                    continue
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[right].sum(), h[right].sum()
                if s.kind == "newton":
                    if hl < s.min_child or hr < s.min_child:
                        continue
                    value = gl ** 2 / (hl + s.lam) + gr ** 2 / (hr + s.lam) - G ** 2 / (H + s.lam)
                else:
                    if min(len(left), len(right)) < s.min_leaf or len(i) < s.min_split:
                        continue
                    value = len(left) * len(right) / len(i) * (gl / len(left) - gr / len(right)) ** 2
                if value > best[0] + 1e-9:
                    best = (value, (f, c, left, right))
            del v
        return best[1]

    def grow(i, level):
        found = gain(i) if level < depth else None
        if not found:
            low = h[i].sum() + (s.lam if s.kind == "newton" else 0)
            return -s.step * g[i].sum() / low
        f, c, left, right = found
        return f, c, grow(left, level + 1), grow(right, level + 1)

    return grow(np.arange(len(x)), 0)


def nested(tree, node=0):
    f = tree["feature"][node]
    return tree["value"][node] if f < 0 else (f, tree["cut"][node], nested(tree, 2 * node + 1), nested(tree, 2 * node + 2))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-8)
    return a[0] == b[0] and math.isclose(a[1], b[1]) and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("s", [B.Booster(rounds=4, step=0.3, subsample=1.0, columns=1.0), B.Booster(rounds=4, step=0.3, subsample=1.0, columns=1.0, lam=0.0, min_child=3.0),
                               B.Booster(rounds=4, step=0.2, subsample=1.0, columns=1.0, kind="friedman", min_split=20, min_leaf=4, prior=True)])
def test_every_split_is_the_best(spark, s):
    df, x, y = table(spark)
    cuts = B.feature_cuts(df, 4)
    got = B.boost(B.pack(df, cuts, 1), cuts, [s], restage=2)[0]
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())) if s.prior else 0.0)
    assert got.base == pytest.approx(margin[0], abs=1e-9) and len(got.trees) == 4
    for tree in got.trees:
        p = 1 / (1 + np.exp(-margin))
        assert same(nested(tree), force_tree(x, p - y, p * (1 - p), s, s.depth))
        margin += B.tree_values(tree, lambda f: x[:, f], len(x), "cut")
    assert got.margins(x) == pytest.approx(margin)


def test_same_trees_on_any_partitioning(spark, monkeypatch):
    df, x, _ = table(spark, 300)
    s = B.Booster(rounds=12, step=0.1, subsample=0.7, columns=0.5, seed=5)
    cuts = B.feature_cuts(df, 4)
    one = B.boost(B.pack(df, cuts, 1), cuts, [s])[0]
    monkeypatch.setattr(B, "BLOCK_BYTES", 2_000)
    blocks = B.pack(df.repartition(7), cuts, 1)
    assert blocks.count() > 3
    many = B.boost(blocks, cuts, [s], restage=5)[0]
    assert many.trees == one.trees


def test_stop_keeps_the_best_prefix(spark):
    df, x, y = table(spark, 400, seed=3)
    fold = np.arange(400) % 4
    s = B.Booster(rounds=300, step=0.4, depth=3, patience=6, fold=0, seed=1)
    cuts = B.feature_cuts(df, 4)
    got = B.boost(B.pack(df, cuts, 1, F.col("fold")), cuts, [s])[0]
    val = [(r, loss) for r, side, loss, _ in got.history if side == "val"]
    losses = [loss for _, loss in val]
    best = int(np.argmin(losses))
    assert [r for r, _ in val] == list(range(1, len(val) + 1))
    assert len(got.trees) == best + 1 and got.fitted == len(val) == best + 1 + s.patience       # trees fitted = rounds run
    scored = B.score(got, df.filter("fold = 0").select("id", "label", "features"))
    assert metrics.log_loss(scored).first()["log_loss"] == pytest.approx(losses[best], abs=1e-6)
    assert (fold == 0).sum() == scored.count()


def test_models_in_step_equal_single_ones(spark):
    df, x, _ = table(spark, 200, seed=9)
    cuts = B.feature_cuts(df, 4)
    specs = [B.Booster(rounds=r, depth=k, step=0.2, subsample=0.8, columns=1.0, kind="friedman", min_split=m, prior=True, fold=f, seed=2)
             for r, k, m, f in ((5, 2, 2, 0), (8, 3, 30, 1), (3, 4, 2, -1))]
    together = B.boost(B.pack(df, cuts, 3, F.col("fold")), cuts, specs, restage=3)
    for s, t in zip(specs, together, strict=True):
        alone = B.boost(B.pack(df, cuts, 1, F.col("fold")), cuts, [s])[0]
        assert alone.trees == t.trees and alone.base == t.base
        assert [h[:2] for h in alone.history] == [h[:2] for h in t.history]
        assert [h[2] for h in alone.history] == pytest.approx([h[2] for h in t.history])


def test_cuts(spark):
    df, x, _ = table(spark, 500)
    few = B.feature_cuts(df, 4)
    for j in range(4):
        v = np.unique(x[:, j])
        assert few[j] == pytest.approx(((v[1:] + v[:-1]) / 2).tolist())
    coarse = B.feature_cuts(df, 4, max_bins=8)
    assert all(len(c) <= 7 and c == sorted(set(c)) for c in coarse) and coarse[3] == pytest.approx([0.5, 1.5])


def test_rows_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """Rows of few bytes are work for several tasks, and the trees stay the same; blocks were one task for every 8 MB before."""
    df, x, _ = table(spark, 300)
    s = B.Booster(rounds=25, step=0.1, subsample=0.7, columns=0.5, seed=5)
    cuts = B.feature_cuts(df, 4)
    one = B.boost(B.pack(df, cuts, 1), cuts, [s])[0]
    monkeypatch.setattr(B, "BLOCK_ROWS", 20)
    monkeypatch.setattr(T, "ROWS_PER_TASK", 60)
    blocks = B.pack(df, cuts, 1)
    assert blocks.count() == 15 and T.held(blocks).getNumPartitions() == min(5, spark.sparkContext.defaultParallelism)
    many = B.boost(blocks, cuts, [s])[0]
    assert many.trees == one.trees and len(many.trees) == 25


def test_whole_fits_equal_boosting_level_by_level(spark, monkeypatch):
    """A task that holds all rows grows the same trees as the jobs over levels, and is not asked for a job a level; models that differ in what may be split share trees."""
    df, x, _ = table(spark, 240, seed=4)
    cuts = B.feature_cuts(df, 4)
    specs = [B.Booster(rounds=r, depth=k, step=0.2, subsample=u, columns=1.0, kind="friedman", min_split=m, min_leaf=l, prior=True, fold=f, seed=2)
             for r, k, u, m, l, f in ((5, 2, 0.8, 2, 1, 0), (8, 2, 0.8, 2, 1, 0), (8, 4, 0.8, 30, 2, 1), (8, 4, 0.8, 2, 1, 1), (3, 3, 1.0, 2, 1, -1))]
    specs += [B.Booster(rounds=60, step=0.4, depth=3, patience=6, fold=0, seed=1, subsample=0.9, columns=0.5), B.Booster(rounds=7, step=0.3, fold=2, lam=0.5, min_child=2.0)]
    blocks = B.pack(df, cuts, len(specs), F.col("fold"))
    jobs = []
    monkeypatch.setattr(B, "level_sums", lambda *a, own=B.level_sums: jobs.append(1) or own(*a))
    whole = B.fit(blocks, cuts, specs)
    assert not jobs
    for w, b in zip(whole, B.boost(blocks, cuts, specs), strict=True):
        assert w.trees == b.trees and w.base == b.base and w.fitted == b.fitted
        assert [h[:2] for h in w.history] == [h[:2] for h in b.history]
        assert [v for h in w.history for v in h[2:]] == pytest.approx([v for h in b.history for v in h[2:]])
    few = B.fit(blocks, cuts, specs[:2], at={3, 5}, trees=False)
    assert [h[0] for h in few[1].history if h[1] == "val"] == [3, 5] and not few[1].trees
    monkeypatch.setattr(B, "WHOLE_BYTES", 0)
    assert [m.trees for m in B.fit(blocks, cuts, specs, in_step=3)] == [m.trees for m in whole] and jobs
