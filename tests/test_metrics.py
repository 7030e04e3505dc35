"""Metrics (E1-E4) against the sample report of the original run."""

import pytest

from lifeboat.operators import metrics


def _pairs(spark, cm):
    rows = []
    for (a, p), n in cm.items():
        rows += [(a, p)] * n
    return spark.createDataFrame(rows, "label INT, prediction INT")


def test_classification_report_golden(spark):
    # confusion [[100, 10], [15, 54]] -> the published precision / recall / F1
    df = _pairs(spark, {(0, 0): 100, (0, 1): 10, (1, 0): 15, (1, 1): 54})
    rep = {r["row_name"]: r for r in metrics.classification_report(df).collect()}
    assert (rep["0"]["precision"], rep["0"]["recall"], rep["0"]["f1"], rep["0"]["support"]) == (0.8696, 0.9091, 0.8889, 110)
    assert (rep["1"]["precision"], rep["1"]["recall"], rep["1"]["f1"], rep["1"]["support"]) == (0.8438, 0.7826, 0.812, 69)
    assert rep["accuracy"]["f1"] == 0.8603 and rep["accuracy"]["support"] == 179
    assert rep["macro avg"]["support"] == 179


def test_zero_division_is_zero(spark):
    df = _pairs(spark, {(0, 0): 3, (1, 0): 2})
    rep = {r["row_name"]: r for r in metrics.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["f1"] == 0.0


def test_accuracy_and_confusion(spark):
    df = _pairs(spark, {(0, 0): 3, (0, 1): 1, (1, 1): 4})
    a = metrics.accuracy(df).first()
    assert (a["accuracy"], a["matches"], a["total"]) == (87.5, 7, 8)
    cm = {r["actual"]: (r["pred_0"], r["pred_1"]) for r in metrics.confusion_matrix(df).collect()}
    assert cm == {0: (3, 1), 1: (0, 4)}


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.4)], "label INT, p1 DOUBLE")
    import math
    assert metrics.log_loss(df).first()["log_loss"] == pytest.approx(-(math.log(0.8) + math.log(0.6)) / 2)


def test_confusion_matrix_takes_its_classes_from_the_data(spark):
    df = _pairs(spark, {(0, 0): 1, (0, 2): 2, (1, 1): 1, (0, 3): 1})
    cm = {r["actual"]: tuple(r[f"pred_{c}"] for c in range(4)) for r in metrics.confusion_matrix(df).collect()}
    assert cm == {0: (1, 0, 2, 1), 1: (0, 1, 0, 0), 2: (0, 0, 0, 0), 3: (0, 0, 0, 0)}


def test_vote_needs_the_same_rows(spark):
    from lifeboat.operators.vote import soft_vote
    a = spark.createDataFrame([(1, 0.5), (2, 1.0)], "id LONG, p1 DOUBLE")
    ok = {r["id"]: (r["p1"], r["prediction"]) for r in soft_vote([a, a]).collect()}
    assert ok == {1: (0.5, 0), 2: (1.0, 1)}
    twice = spark.createDataFrame([(1, 0.5), (1, 0.5)], "id LONG, p1 DOUBLE")
    for other in (a.where("id = 1"), twice):
        with pytest.raises(Exception, match="same rows"):
            soft_vote([a, other]).collect()
