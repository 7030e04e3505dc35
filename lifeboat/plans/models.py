"""Model families and the split -> fit -> validate -> predict harness (M1-M8, V3, V5, E5).

Input of every trainer: a DataFrame with ``id``, ``label`` (numeric, 0/1),
``is_train`` and an ML vector column ``features`` (see ``features.prepare``).
Each trainer returns a :class:`Fitted`: the validation accuracy, a scorer
that maps any frame with ``features`` to (id, prediction, p1), the fitted
Spark ML model(s) for persisting, and the search / training history.

Forests and linear models are Spark ML estimators. Boosting (``operators.boosting``), the perceptron
(``operators.perceptron``) and the search of the SVM (``operators.hinge``) are chains of jobs that add up fixed-size sums over partitions; the RBF
kernel is random Fourier features as array expressions, and neighbours are exact (``operators.knn``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product
from typing import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat import config as C
from lifeboat.operators import boosting as BO
from lifeboat.operators import hinge as H
from lifeboat.operators import knn as K
from lifeboat.operators import metrics, split
from lifeboat.operators import perceptron as NN
from lifeboat.operators import vectors as V
from lifeboat.operators.layout import partitions_for, spread, stage
from lifeboat.operators.together import run_parallel
from lifeboat.session import checkpoint_root

Scorer = Callable[[DataFrame], DataFrame]


@dataclass
class Fitted:
    name: str
    seed: int
    val_acc: float
    scorer: Scorer
    model: object
    params: dict = field(default_factory=dict)
    history: list = field(default_factory=list)  # (step, split, loss, acc) rows
    search: list = field(default_factory=list)  # (params, mean cv accuracy) rows
    validation: DataFrame | None = None  # (id, label, prediction, p1)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.scorer(df)

    def report(self) -> DataFrame:
        """E2 on the validation rows, with the class names."""
        return metrics.classification_report(self.validation, "label", "prediction", names=C.CLASS_NAMES)

    def confusion(self) -> DataFrame:
        """E3 on the validation rows."""
        return metrics.confusion_matrix(self.validation, "label", "prediction")


# --- shared helpers ----------------------------------------------------------------

def ml_scorer(model, prep: Callable[[DataFrame], DataFrame] | None = None) -> Scorer:
    """(id, prediction int, p1) from a Spark ML classification model."""
    def score(df: DataFrame) -> DataFrame:
        d = prep(df) if prep else df
        out = model.transform(d)
        return out.select("id", *_label_of(df), F.col("prediction").cast("int").alias("prediction"),
                          vector_to_array("probability")[1].alias("p1"))
    return score


def _label_of(df: DataFrame) -> list[str]:
    """Scorers hand the label on where there is one, so validating needs no join."""
    return ["label"] if "label" in df.columns else []


def split_labelled(data: DataFrame, seed: int, ratio: float,
                   partitions: int = C.TrainingConfig.fit_partitions) -> tuple[DataFrame, DataFrame, DataFrame]:
    """V1 on the labelled rows: (train, validation, the persisted table of both, to free after the fit)."""
    lab = data.where(F.col("is_train")).select("id", F.col("label").cast("double").alias("label"), "features")
    lab = stage(lab, "labelled")
    sp = spread(split.stratified_split(lab, seed=seed, ratio=ratio), partitions_for(lab.count(), partitions)).persist(StorageLevel.MEMORY_AND_DISK)
    return sp.where(F.col("is_val") == 0).drop("is_val"), sp.where(F.col("is_val") == 1).drop("is_val"), sp


def validate(scorer: Scorer, val: DataFrame) -> tuple[float, DataFrame]:
    """E1 on the validation rows: accuracy in % and the scored rows."""
    scored = scorer(val)
    acc = metrics.accuracy(scored, "label", "prediction").first()["accuracy"]
    return float(acc or 0.0), scored.select("id", F.col("label").cast("int").alias("label"),
                                            "prediction", "p1")


# --- M1 random forest --------------------------------------------------------------

def fit_random_forest(train: DataFrame, cfg: C.TrainingConfig, seed: int) -> tuple[Scorer, object, dict]:
    rf = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=cfg.rf_trees, maxDepth=cfg.rf_max_depth,
        minInstancesPerNode=cfg.rf_min_instances, impurity="gini", featureSubsetStrategy="sqrt",
        subsamplingRate=1.0, bootstrap=True, seed=cfg.model_seed,
        maxMemoryInMB=cfg.tree_memory_mb, cacheNodeIds=True)
    checkpoint_root(train.sparkSession)  # node-id cache checkpoints go to the shared folder
    model = rf.fit(train)
    return ml_scorer(model), model, {"numTrees": cfg.rf_trees, "maxDepth": cfg.rf_max_depth}


# --- M2 gradient boosting under grid search (V2, V3) ----------------------------------

def _dimensions(rows: DataFrame) -> int:
    return rows.select(F.size(vector_to_array("features"))).first()[0]


def boosted_scorer(parts: dict) -> Scorer:
    """(id, prediction int, p1) from the trees of ``operators.boosting``."""
    model = BO.Boosted(parts["base"], parts["trees"])
    return lambda df: BO.score(model, df.select("id", *_label_of(df), "features"))


def _parts(model: BO.Boosted) -> dict:
    return {"base": model.base, "trees": model.trees}


GRID_ORDER = ("maxIter", "stepSize", "maxDepth", "minSamplesSplit", "minInstancesPerNode", "subsamplingRate")
_GRID_DEFAULTS = {"minSamplesSplit": (2,), "minInstancesPerNode": (1,), "subsamplingRate": (1.0,)}


def grid_combinations(grid: dict) -> list[dict]:
    """Every combination, in the order that breaks ties: the last parameter changes fastest."""
    values = {**_GRID_DEFAULTS, **grid}
    return [dict(zip(GRID_ORDER, c)) for c in product(*(values[k] for k in GRID_ORDER))]


def fit_gradient_boosting(train: DataFrame, cfg: C.TrainingConfig, seed: int):
    """Grid search by nested prefixes: combinations that differ in the number of rounds only are one run, whose validation
    accuracy after each of those numbers is read off; all other combinations and all folds are dealt to tasks (``BO.fit``), or over very many rows
    boosted in step, ``models_in_step`` at a time."""
    folded = split.stratified_folds(train, seed=seed, folds=cfg.cv_folds)
    d = _dimensions(train)
    cuts = BO.feature_cuts(train, d, cfg.max_bins)
    combos = grid_combinations(cfg.gb_grid)

    def booster(c: dict, rounds: int, fold: int) -> BO.Booster:
        return BO.Booster(rounds=rounds, step=c["stepSize"], depth=c["maxDepth"], subsample=c["subsamplingRate"], columns=1.0, kind="friedman",
                          min_split=c["minSamplesSplit"], min_leaf=c["minInstancesPerNode"], prior=True, fold=fold, seed=seed)

    rest = lambda c: tuple(c[k] for k in GRID_ORDER[1:])
    longest: dict[tuple, dict] = {}
    for c in combos:
        if rest(c) not in longest or c["maxIter"] > longest[rest(c)]["maxIter"]:
            longest[rest(c)] = c
    runs = [(c, f) for c in longest.values() for f in range(cfg.cv_folds)]
    blocks = BO.pack(folded, cuts, cfg.models_in_step, F.col("fold"))
    fits = BO.fit(blocks, cuts, [booster(c, c["maxIter"], f) for c, f in runs], at={c["maxIter"] for c in combos}, trees=False, in_step=cfg.models_in_step)
    after = {(rest(c), f): {r: acc for r, side, _, acc in m.history if side == "val"}       # accuracy by number of rounds
             for (c, f), m in zip(runs, fits, strict=True)}
    search = [(c, sum(after[rest(c), f].get(c["maxIter"], 0.0) for f in range(cfg.cv_folds)) / cfg.cv_folds) for c in combos]
    best = max(enumerate(search), key=lambda t: (t[1][1], -t[0]))[1][0]
    model = _parts(BO.fit(BO.pack(train, cuts, 1), cuts, [booster(best, best["maxIter"], -1)], at=set())[0])
    return boosted_scorer(model), model, best, search


# --- M3 boosting with early stopping (V5) --------------------------------------------

def early_stop_index(losses, patience: int) -> int:
    """0-based index of the best (lowest) loss, scanning until ``patience``
    iterations pass without a strict improvement (first best wins)."""
    best_i, best = 0, float("inf")
    for i, v in enumerate(losses):
        if v < best:
            best_i, best = i, v
        elif i - best_i >= patience:
            break
    return best_i


def fit_boosting_early_stop(train: DataFrame, val: DataFrame, cfg: C.TrainingConfig, seed: int):
    """Regularised second-order boosting, round by round on staged margins, until the validation
    log-loss has not fallen for ``early_stopping_rounds`` rounds; the best prefix is kept. No round is fitted twice."""
    d = _dimensions(train)
    cuts = BO.feature_cuts(train, d, cfg.max_bins)
    rows = train.withColumn("fold", F.lit(0)).unionByName(val.withColumn("fold", F.lit(1)))
    spec = BO.Booster(rounds=cfg.xgb_rounds, step=cfg.xgb_step, depth=cfg.xgb_depth, subsample=cfg.xgb_subsample, columns=cfg.xgb_column_share,
                      lam=cfg.xgb_lambda, min_child=cfg.xgb_min_child, patience=cfg.early_stopping_rounds, fold=1, seed=seed)
    got = BO.fit(BO.pack(rows, cuts, 1, F.col("fold")), cuts, [spec])[0]
    history = [h for h in got.history if h[1] == "val"]
    return boosted_scorer(_parts(got)), _parts(got), {"rounds": len(got.trees), "fitted": got.fitted}, history


# --- M5 logistic regression (V6) ---------------------------------------------------

def fit_logistic(train: DataFrame, cfg: C.TrainingConfig, seed: int):
    """L2 logistic regression with balanced class weights; C = 1 -> regParam = 1 / n.

    The intercept is the weight of a constant feature and so inside the penalty.
    """
    weighted = with_constant(split.class_weights(train, "label", "weight"))
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", fitIntercept=False,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
                            maxIter=cfg.lr_max_iter, tol=1e-12, family="binomial")
    model = lr.fit(weighted)
    return ml_scorer(model, with_constant), model, {"regParam": 1.0 / max(n, 1)}


def with_constant(df: DataFrame) -> DataFrame:
    """``features`` with a constant 1 at the end."""
    return df.withColumn("features", array_to_vector(F.concat(vector_to_array("features"), F.array(F.lit(1.0)))))


# --- M6 RBF SVM by random Fourier features --------------------------------------------

def _svm_transform(df: DataFrame, means, stds, w, b) -> DataFrame:
    x = V.scale_array(vector_to_array("features"), means, stds)
    return df.withColumn("features", array_to_vector(V.rff_map(x, w, b)))


def _fit_svms(train: DataFrame, cs, gamma, cfg: C.TrainingConfig, seed: int) -> list:
    """(scorer, parts, params) for each C; they share the scaler, the weights and the mapped rows."""
    arr = train.select(vector_to_array("features").alias("x"))
    means, stds = V.fit_array_scaler(arr, "x")
    g = V.gamma_scale(stds) if gamma == "scale" else float(gamma)
    w, b = V.rff_weights(len(means), cfg.rff_dim, g, seed)
    mapped = split.class_weights(_svm_transform(train, means, stds, w, b), "label", "weight")
    mapped = mapped.persist(StorageLevel.MEMORY_AND_DISK)
    n, out = mapped.count(), []
    for c in cs:
        svc = LinearSVC(featuresCol="features", labelCol="label", weightCol="weight",
                        regParam=1.0 / (c * max(n, 1)), maxIter=cfg.svm_max_iter, tol=cfg.svm_tol,
                        standardization=False)
        svm = svc.fit(mapped)
        # Platt scaling: a 1-d logistic regression on the margin gives P(class 1).
        margin = svm.transform(mapped).select(
            "label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("margin"))
        platt = LogisticRegression(featuresCol="margin", labelCol="label", regParam=0.0, maxIter=100,
                                   predictionCol="_pp", rawPredictionCol="_pr", probabilityCol="_prob").fit(margin)
        parts = {"svm": svm, "platt": platt, "means": means, "stds": stds, "w": w, "b": b}
        out.append((svm_scorer(parts), parts, {"C": c, "gamma": g}))
    mapped.unpersist()
    return out


def svm_scorer(parts: dict) -> Scorer:
    svm, platt, means, stds = (parts[k] for k in ("svm", "platt", "means", "stds"))
    w, b = np.asarray(parts["w"]), np.asarray(parts["b"])

    def score(df: DataFrame) -> DataFrame:
        z = svm.transform(_svm_transform(df.select("id", "features", *_label_of(df)), means, stds, w, b))
        z = z.select("id", *_label_of(df), F.col("prediction").cast("int").alias("prediction"),
                     array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("margin"))
        return platt.transform(z).select("id", *_label_of(df), "prediction", vector_to_array("_prob")[1].alias("p1"))

    return score


def fit_svm(train: DataFrame, cfg: C.TrainingConfig, seed: int):
    """Grid over C x gamma by 3-fold CV, all machines of it fitted in step (``operators.hinge``); the best one is fitted again on all rows."""
    cs, gammas = cfg.svm_grid["C"], cfg.svm_grid["gamma"]
    folded = split.stratified_folds(train, seed=seed, folds=cfg.cv_folds).persist(StorageLevel.MEMORY_AND_DISK)
    scalers = [V.fit_array_scaler(folded.where(F.col("fold") != f).select(vector_to_array("features").alias("x")), "x") for f in range(cfg.cv_folds)]
    kernels = []
    for g in gammas:
        for f, (means, stds) in enumerate(scalers):
            w, b = V.rff_weights(len(means), cfg.rff_dim, V.gamma_scale(stds) if g == "scale" else float(g), seed)
            kernels.append(H.Kernel(f, np.array(means), np.array(stds), w, b))
    rows = H.hold(folded, len(kernels[0].means))
    _, accs = H.fit(rows, kernels, cs, cfg.svm_max_iter, cfg.svm_tol)
    rows.unpersist()
    folded.unpersist()
    search = [({"C": c, "gamma": g}, sum(accs[j * cfg.cv_folds + f][i] for f in range(cfg.cv_folds)) / cfg.cv_folds)
              for i, c in enumerate(cs) for j, g in enumerate(gammas)]
    best = max(enumerate(search), key=lambda t: (t[1][1], -t[0]))[1][0]
    scorer, model, params = _fit_svms(train, [best["C"]], best["gamma"], cfg, seed)[0]
    return scorer, model, params, search


# --- M7 k nearest neighbours --------------------------------------------------------

def _scaled_points(df: DataFrame, means, stds) -> DataFrame:
    return df.select("id", *([F.col("label")] if "label" in df.columns else []),
                     V.scale_array(vector_to_array("features"), means, stds).alias("features"))


def fit_knn(train: DataFrame, cfg: C.TrainingConfig, seed: int):
    """Grid over k x weights x p by 3-fold CV; one neighbour search per (p, fold)
    serves every k and weighting (lists are computed for the largest k)."""
    ks, ws, ps = cfg.knn_grid["k"], cfg.knn_grid["weights"], cfg.knn_grid["p"]
    kmax = max(ks)
    folded = split.stratified_folds(train, seed=seed, folds=cfg.cv_folds).persist(StorageLevel.MEMORY_AND_DISK)
    combos = [(k, w) for k in ks for w in ws]

    def fold_task(f, p):
        def run():
            tr = folded.where(F.col("fold") != f)
            te = folded.where(F.col("fold") == f)
            means, stds = V.fit_array_scaler(tr.select(vector_to_array("features").alias("x")), "x")
            trp, tep = _scaled_points(tr, means, stds), _scaled_points(te, means, stds)
            # every (k, weighting) is scored from the same lists in one aggregate
            nn = K.neighbours(trp, tep, kmax, p=p)
            hits = [F.avg((K.vote_columns("nn", k, w)[0] == F.col("label")).cast("double")).alias(f"a{i}")
                    for i, (k, w) in enumerate(combos)]
            row = nn.agg(*hits).first()
            return p, [100.0 * float(row[f"a{i}"] or 0.0) for i in range(len(combos))]
        return run

    totals: dict[tuple, list] = {}
    results = run_parallel([fold_task(f, p) for f in range(cfg.cv_folds) for p in ps], cfg.cv_parallelism)
    for p, accs in results:
        for (k, w), a in zip(combos, accs):
            totals.setdefault((k, p, w), []).append(a)
    folded.unpersist()
    # scikit-learn's grid order: keys sorted (n_neighbors, p, weights); first best wins.
    order = [(k, p, w) for k in ks for p in ps for w in ws]
    search = [({"k": k, "p": p, "weights": w}, sum(totals[(k, p, w)]) / len(totals[(k, p, w)]))
              for (k, p, w) in order]
    best = max(enumerate(search), key=lambda t: (t[1][1], -t[0]))[1][0]
    means, stds = V.fit_array_scaler(train.select(vector_to_array("features").alias("x")), "x")
    ref = stage(_scaled_points(train, means, stds), "knn-points")

    parts = {"reference": ref, "means": means, "stds": stds, **best}
    return knn_scorer(parts), parts, best, search


def knn_scorer(parts: dict) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        q = _scaled_points(df.select("id", "features", *_label_of(df)), parts["means"], parts["stds"])
        return K.vote(K.neighbours(parts["reference"], q, parts["k"], p=parts["p"]), parts["k"], parts["weights"])
    return score


# --- M8 multilayer perceptron ------------------------------------------------------------

def fit_mlp(train: DataFrame, val: DataFrame, cfg: C.TrainingConfig, seed: int):
    """Synchronous mini-batch perceptron (``operators.perceptron``) on features scaled by the training rows."""
    means, stds = V.fit_array_scaler(train.select(vector_to_array("features").alias("x")), "x")
    rows = train.withColumn("val", F.lit(0)).unionByName(val.withColumn("val", F.lit(1)))
    rows = rows.withColumn("features", array_to_vector(V.scale_array(vector_to_array("features"), means, stds)))
    s = NN.Settings(hidden=tuple(cfg.mlp_hidden), dropout=cfg.mlp_dropout, batch_rows=cfg.mlp_batch_rows, batches=cfg.mlp_batches, epochs=cfg.mlp_epochs,
                    rate=cfg.mlp_rate, decay=cfg.mlp_decay, patience=cfg.patience, seed=seed)
    net, history, best = NN.train(NN.pack(rows, len(means)), len(means), s)
    parts = {**net.plain(), "scale_means": list(means), "scale_stds": list(stds)}
    return mlp_scorer(parts), parts, {"layers": [len(means), *cfg.mlp_hidden, 2], "epoch": best}, history


def mlp_scorer(parts: dict) -> Scorer:
    net, means, stds = NN.Network.of(parts), parts["scale_means"], parts["scale_stds"]

    def scorer(df: DataFrame) -> DataFrame:
        x = array_to_vector(V.scale_array(vector_to_array("features"), means, stds))
        return NN.score(net, df.select("id", *_label_of(df), x.alias("features")))
    return scorer


# --- harness -----------------------------------------------------------------------

MODEL_FAMILIES = ("random_forest", "gradient_boosting", "xgboost", "logistic_regression",
                  "svm", "knn", "mlp")


def train_model(name: str, data: DataFrame, cfg: C.TrainingConfig | None = None,
                seed: int | None = None) -> Fitted:
    """Split the labelled rows by ``seed``, fit family ``name``, validate.

    An unknown family raises (no silent fallback).
    """
    cfg = cfg or C.TrainingConfig()
    seed = cfg.seed if seed is None else seed
    if name not in MODEL_FAMILIES:
        raise ValueError(f"Unsupported model: {name!r} (expected one of {MODEL_FAMILIES})")
    train, val, split_rows = split_labelled(data, seed, cfg.val_ratio, cfg.fit_partitions)
    search, history = [], []
    if name == "random_forest":
        scorer, model, params = fit_random_forest(train, cfg, seed)
    elif name == "gradient_boosting":
        scorer, model, params, search = fit_gradient_boosting(train, cfg, seed)
    elif name == "xgboost":
        scorer, model, params, history = fit_boosting_early_stop(train, val, cfg, seed)
    elif name == "logistic_regression":
        scorer, model, params = fit_logistic(train, cfg, seed)
    elif name == "svm":
        scorer, model, params, search = fit_svm(train, cfg, seed)
    elif name == "knn":
        scorer, model, params, search = fit_knn(train, cfg, seed)
    else:
        scorer, model, params, history = fit_mlp(train, val, cfg, seed)
    scored = stage(scorer(val), "validation")
    acc, scored = validate(lambda _: scored, val)
    split_rows.unpersist()
    return Fitted(name, seed, acc, scorer, model, params, history, search, scored)


def predict_unlabelled(fitted: Fitted, data: DataFrame) -> DataFrame:
    """(id, prediction, p1) for the rows without a label."""
    return fitted.predict(data.where(~F.col("is_train")).select("id", "features"))
