"""Model families and selection, checked by properties (no library to compare numbers with).

Documents joined with their quality label carry signal (length, words, lines,
language), so a forest must beat the majority class there.
"""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from lifeboat import config as C
from lifeboat.plans import features as FE
from lifeboat.plans import selection as S
from lifeboat.plans.models import early_stop_index, predict_unlabelled, train_model
from lifeboat.sources import bindings as B

FAST = C.TrainingConfig(
    fit_partitions=4, age_forest_trees=10, rf_trees=20, xgb_rounds=30, early_stopping_rounds=5,
    gb_grid={"maxIter": (5, 40), "stepSize": (0.1,), "maxDepth": (3, 4), "minInstancesPerNode": (1,),
             "subsamplingRate": (1.0,)},
    svm_grid={"C": (1.0,), "gamma": ("scale",)}, rff_dim=64, svm_max_iter=60,
    knn_grid={"k": (3, 7), "weights": ("uniform", "distance"), "p": (1, 2)},
    mlp_epochs=28,
)


@pytest.fixture(scope="module")
def docs(spark):
    d, _ = FE.prepare_numeric(B.document_subjects(spark, SF_MID), ["n_chars", "n_words", "n_lines"], ["lang"])
    return d.cache()


def _majority_pct(docs):
    counts = [r["count"] for r in docs.where("is_train").groupBy("label").count().collect()]
    return 100.0 * max(counts) / sum(counts)


def test_forest_beats_majority_and_is_deterministic(docs):
    a = train_model("random_forest", docs, FAST)
    assert a.val_acc > _majority_pct(docs)
    b = train_model("random_forest", docs, FAST)
    pa = sorted(tuple(r) for r in predict_unlabelled(a, docs).collect())
    pb = sorted(tuple(r) for r in predict_unlabelled(b, docs).collect())
    assert pa == pb
    n_unl = docs.where(~F.col("is_train")).count()
    assert len(pa) == n_unl
    assert all(0.0 <= p1 <= 1.0 and pred in (0, 1) for _, pred, p1 in pa)


@pytest.mark.parametrize("family", ["gradient_boosting", "xgboost", "logistic_regression", "svm", "knn", "mlp"])
def test_family_beats_majority_and_repeats(docs, family):
    f = train_model(family, docs, FAST)
    if family in ("logistic_regression", "svm"):
        # trained with balanced class weights, so plain accuracy is not their goal: the classes must be told apart
        scored = f.scorer(docs.where("is_train"))
        means = {r["label"]: r["m"] for r in scored.groupBy("label").agg(F.avg("p1").alias("m")).collect()}
        assert means[1] > means[0]
    else:
        assert f.val_acc >= _majority_pct(docs)
    rows = sorted(tuple(r) for r in predict_unlabelled(f, docs).collect())
    assert len(rows) == docs.where(~F.col("is_train")).count()
    assert all(0.0 <= p1 <= 1.0 for *_, p1 in rows)
    again = sorted(tuple(r) for r in predict_unlabelled(train_model(family, docs, FAST), docs).collect())
    assert [(i, y, round(p, 9)) for i, y, p in rows] == [(i, y, round(p, 9)) for i, y, p in again]
    if family in ("gradient_boosting", "svm", "knn"):
        assert f.search and all(0.0 <= acc <= 100.0 for _, acc in f.search)
    if family == "xgboost":
        from lifeboat.operators import metrics
        assert 1 <= f.params["rounds"] <= FAST.xgb_rounds and f.history
        kept = next(loss for step, _, loss, _ in f.history if step == f.params["rounds"])
        assert kept == pytest.approx(metrics.log_loss(f.validation).first()["log_loss"], abs=1e-6)
    if family == "mlp":
        assert {s for _, s, _, _ in f.history} == {"train", "val"}


def test_forest_does_not_depend_on_how_the_rows_are_laid_out(docs):
    a = train_model("random_forest", docs.repartition(1), FAST)
    b = train_model("random_forest", docs.repartition(7, "features"), FAST)
    assert sorted(map(tuple, predict_unlabelled(a, docs).collect())) == sorted(map(tuple, predict_unlabelled(b, docs).collect()))


def test_rfxgb_forest_is_seeded_by_its_split(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(S, "train_model", lambda name, data, cfg, seed=None: seen.append((name, cfg.model_seed, seed)) or S.Fitted(name, seed, 50.0, None, None))
    S.seed_sweep("random_forest", docs, FAST, (45, 2025), seed_model=True)
    assert sorted(seen) == [("random_forest", 45, 45), ("random_forest", 2025, 2025)]


def test_unknown_model_raises(docs):
    with pytest.raises(ValueError):
        train_model("nope", docs, FAST)


def test_early_stop_index():
    assert early_stop_index([5, 4, 3, 3.5, 3.6, 3.7, 2.0], patience=3) == 2
    assert early_stop_index([5, 4, 3, 3.5, 2.0], patience=3) == 4
    assert early_stop_index([1.0, 1.0, 1.0], patience=1) == 0


def test_best_fit_first_wins_ties():
    fits = [S.Fitted("a", 1, 80.0, None, None), S.Fitted("b", 2, 80.0, None, None), S.Fitted("c", 3, 79.0, None, None)]
    assert S.best_fit(fits).name == "a"


def test_ensemble_top3(docs):
    pred, board, top, summary = S.ensemble_top3(docs, FAST)
    accs = sorted((r["val_acc"] for r in board.collect()), reverse=True)
    assert len(top) == 3 and [t.val_acc for t in top] == accs[:3]
    assert summary["mean_member_acc"] == pytest.approx(sum(accs[:3]) / 3)
    assert pred.count() == docs.where(~F.col("is_train")).count()


def test_rfxgb_over_seeds(docs):
    pred, acc, best, fits = S.rfxgb(docs, FAST, seeds=(45, 2025))
    assert len(fits) == 4 and acc == pytest.approx((best[0].val_acc + best[1].val_acc) / 2)
    assert pred.count() == docs.where(~F.col("is_train")).count()


@pytest.mark.parametrize("family", ["knn", "svm", "mlp", "xgboost"])
def test_saved_models_predict_the_same(spark, docs, tmp_path, family):
    from lifeboat.plans.saved import load_scorer, save_fitted
    f = train_model(family, docs, FAST)
    path = save_fitted(f, str(tmp_path / family), spark)
    rows = docs.where(~F.col("is_train")).select("id", "features")
    assert sorted(map(tuple, load_scorer(spark, path)(rows).collect())) == sorted(map(tuple, f.predict(rows).collect()))


def test_run_end_to_end(spark, tmp_path):
    from lifeboat.plans.run import run
    from lifeboat.plans.saved import load_scorer
    from conftest import SF_SMALL
    lab, unl = B.labelled_unlabelled(spark, SF_SMALL)
    truth = B.subjects(spark, SF_SMALL).where(~F.col("is_train")).select(
        F.col("id").alias("PassengerId"), F.col("label").alias("Survived"))
    tpath = str(tmp_path / "truth")
    truth.write.option("header", True).csv(tpath)
    out = tmp_path / "out"
    res = run(spark, lab, unl, "RandomForest", str(out), cfg=FAST, ground_truth=tpath, seeds=(45, 2025))
    rows = res.rows
    assert [r[0] for r in rows] == [45, 2025] and sum(r[5] for r in rows) == 1
    assert all(r[4] == unl.count() and 0.0 <= r[2] <= 1.0 for r in rows)
    assert res.val_acc == max(r[1] for r in rows)
    made = {p.name for p in out.iterdir()}
    assert {f"random_forest_seed45_{x}" for x in ("submission", "model", "report", "confusion")} | {"random_forest_summary"} <= made
    load_scorer(spark, res.model_path)
    run(spark, lab, unl, "rfxgb", str(out), cfg=FAST, seeds=(45,))
    made = {p.name for p in out.iterdir()}
    assert {"rfxgb_best_model", "rfxgb_best_submission", "rfxgb_leaderboard", "rfxgb_best_xgboost_submission", "xgboost_rfxgb_best_history"} <= made
    load_scorer(spark, str(out / "rfxgb_best_model"))
    with pytest.raises(ValueError):
        run(spark, lab, unl, "nope", str(tmp_path / "x"))


def test_fitted_report_names(docs):
    f = train_model("logistic_regression", docs, FAST)
    names = {r["row_name"] for r in f.report().collect()}
    assert {"Did Not Survive", "Survived", "accuracy", "macro avg", "weighted avg"} <= names
    cm = f.confusion().collect()
    assert sum(r["pred_0"] + r["pred_1"] for r in cm) == f.validation.count()


def test_logistic_regression_is_at_its_penalised_optimum(docs):
    """The gradient of weighted loss and penalty, the intercept's included, vanishes at the coefficients."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from lifeboat.plans.models import fit_logistic
    lab = docs.where("is_train").select("id", F.col("label").cast("double").alias("label"), "features")
    _, model, params = fit_logistic(lab, FAST, 1)
    rows = lab.select("label", vector_to_array("features").alias("x")).collect()
    x = np.array([[*r["x"], 1.0] for r in rows])
    y = np.array([r["label"] for r in rows])
    weight = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    w = np.array(model.coefficients)
    assert len(w) == x.shape[1] and model.intercept == 0.0 and params["regParam"] == 1 / len(y)
    p = 1 / (1 + np.exp(-x @ w))
    scale = np.maximum(x.std(0), 1.0)                   # per unit of each feature's spread
    grad = ((weight * (p - y)) @ x / len(y) + w / len(y)) / scale
    assert np.abs(grad).max() < 1e-6


def test_fits_take_more_partitions_for_more_rows(docs, monkeypatch):
    """Four partitions held all rows of a fit before, however many."""
    from lifeboat.operators import layout
    from lifeboat.plans.models import split_labelled
    assert layout.partitions_for(6_300_000, 4) == 252 and layout.partitions_for(90, 4) == 4
    monkeypatch.setattr(layout, "FIT_ROWS", 20)
    rows = docs.where("is_train").count()
    sp = split_labelled(docs, 1, 0.2, 4)[2]
    assert sp.rdd.getNumPartitions() == -(-rows // 20) > 4
    sp.unpersist()


def test_svm_query_searches_the_whole_grid():
    """Two of the twelve combinations were searched before."""
    assert C.QUERY_CONFIG.svm_grid == C.SVM_GRID


def test_boosting_queries_search_the_whole_grid():
    """Two of the 324 combinations were searched before."""
    from lifeboat.plans.models import grid_combinations
    assert C.QUERY_CONFIG.gb_grid == C.GB_GRID and len(grid_combinations(C.QUERY_CONFIG.gb_grid)) == 324


def _svm_rows(docs):
    return docs.where("is_train").select("id", F.col("label").cast("double").alias("label"), "features").repartition(2, "id").cache()


def test_svm_search_takes_the_jobs_of_one_fit(docs):
    """Each of 36 fits ran its own hundred and more jobs before (8,212 in all at sf0.1)."""
    from dataclasses import replace
    from lifeboat.plans.models import fit_svm
    scheduler = docs.sparkSession.sparkContext._jsc.sc().dagScheduler()
    rows, before = _svm_rows(docs), scheduler.numTotalJobs()
    _, _, params, search = fit_svm(rows, replace(FAST, svm_grid=C.SVM_GRID), 45)
    assert scheduler.numTotalJobs() - before < 1_000
    assert len(search) == 12 and max(a for _, a in search) == next(a for p, a in search if p["C"] == params["C"] and (
        p["gamma"] == params["gamma"] or p["gamma"] == "scale"))


def test_svm_machine_is_that_of_linear_svc(spark):
    """Coefficients, intercept and Platt scaling of several C. Without class weights: balanced ones make the intercept's first
    gradient zero but for rounding, whose sign then sets the path of either (and of ``LinearSVC`` by its partitions)."""
    import numpy as np
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from lifeboat.operators import hinge as H, vectors as V
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) * [1, 10, 0.1]
    y = (x[:, 0] + x[:, 1] / 10 + rng.normal(size=300) > 0.8).astype(int)
    kernel = H.Kernel(-1, x.mean(0), x.std(0), *V.rff_weights(3, 16, 0.1, 3))
    z, fold = kernel.map(x), np.zeros(300, int)
    rows = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(y, z, strict=True)], "label double, z array<double>")
    rows = rows.withColumn("features", array_to_vector("z")).cache()
    for reg in (0.01, 0.001):
        fit = H.machine(z.mean(0), z.std(0, ddof=1), 300.0, reg, 15, 1e-4)
        point, kept = next(fit), None
        while kept is None:
            hinge, platt = H.loss_sums([kernel], [np.ones(2)], [[point]])(None, y, fold, x)
            try:
                point = fit.send((hinge if point.scale is None else platt)[0])
            except StopIteration as end:
                kept = end.value
        svc = LinearSVC(regParam=reg, maxIter=15, tol=1e-4, standardization=False).fit(rows)
        margin = svc.transform(rows).select("label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("features"))
        platt = LogisticRegression(regParam=0.0).fit(margin)
        assert kept.coef == pytest.approx(np.array(svc.coefficients), rel=1e-7, abs=1e-7) and kept.intercept == pytest.approx(svc.intercept, rel=1e-7)
        assert list(kept.scale) == pytest.approx([platt.coefficients[0], platt.intercept], rel=1e-3, abs=1e-3)


def test_svm_machine_of_one_class_and_constant_columns():
    """No division by a deviation of zero or by a class that is absent; the scaling of separable margins ends."""
    from unittest import mock
    import numpy as np
    from lifeboat.operators import hinge as H
    rng = np.random.default_rng(1)
    x = np.c_[rng.normal(size=90), np.full(90, 3.0)]
    fold = np.arange(90) % 3
    kernel = H.Kernel(0, x.mean(0), x.std(0), np.array([[1.0, 0.5], [0.0, 0.0], [0.3, 0.1]]), np.array([0.1, 0.2, 0.3]))
    for y in (np.ones(90, int), (kernel.map(x)[:, 2] > 0.8).astype(int)):
        sums = H.moment_sums([kernel])(None, y, fold, x)
        assert [s[0, 0] for s in sums] == [float(((fold != 0) & (y == c)).sum()) for c in (0, 1)]
        assert kernel.map(x)[:, 1].std() < 1e-15
        with mock.patch.object(H, "added", lambda rows, work: work(mock.Mock(arrays=rows))):
            (fitted,), (acc,) = H.fit((None, y, fold, x), [kernel], (1.0,), 100, 1e-4)
        assert np.isfinite([*fitted[0].coef, fitted[0].intercept, *fitted[0].scale]).all() and fitted[0].coef[1] == 0
        assert 0 <= acc[0] <= 100 and (y.min() == 0 or acc[0] == 100)
