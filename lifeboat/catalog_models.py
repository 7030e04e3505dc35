"""Registered queries for models, model selection, sources and sinks.

Model queries train on the labelled documents (counts over whole texts and the
language against the quality label, which carries signal) with
``config.QUERY_CONFIG`` and predict the documents without a label: id, prediction and probability of class 1. No SQL engine
trains forests, so these have no oracle; the tests check the trainers (every boosted split against a search over all, the
perceptron's gradient against finite differences, the logistic optimum by its gradient). ``boost_root_splits`` has the booster's
first sums and gains by value.
The composable pieces that SQL can state (nearest-neighbour join, random
Fourier map, soft vote, top-k leaderboard, CSV round trips, scoring) carry
DuckDB oracles over the same tables.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeboat import oracles as O
from lifeboat import config as C
from lifeboat.catalog import query
from lifeboat.operators import boosting as BO
from lifeboat.operators import knn as K
from lifeboat.operators import vectors as V
from lifeboat.operators.encode import category_codes
from lifeboat.operators.layout import stage
from lifeboat.operators.score import score_submission
from lifeboat.operators.vote import leaderboard_topk, soft_vote
from lifeboat.plans import features as FE
from lifeboat.plans import run as RUN
from lifeboat.plans import selection as S
from lifeboat.plans.models import predict_unlabelled, train_model
from lifeboat.plans.saved import load_scorer, save_vote
from lifeboat.session import scratch_path
from lifeboat.sources import bindings as B
from lifeboat.sources import csv as CSV
from lifeboat.sources import sinks

# =============================================================================
# Models (rows-only): predictions for the unlabelled subjects
# =============================================================================


def model_input(spark: SparkSession, sf: str) -> DataFrame:
    d, _ = FE.prepare_numeric(B.document_subjects(spark, sf), ["n_chars", "n_words", "n_lines"], ["lang"])
    return stage(d.select("id", "label", "is_train", "features"), "model-input")


def _predicted(pred: DataFrame) -> DataFrame:
    return pred.select(F.col("id").cast("long").alias("id"), "prediction", F.round("p1", 9).alias("p1"))


def _model_query(family: str):
    def run(spark, sf):
        data = model_input(spark, sf)
        return _predicted(predict_unlabelled(train_model(family, data, C.QUERY_CONFIG), data))
    run.__name__ = f"{family}_q"
    return run


query("random_forest")(_model_query("random_forest"))
query("gradient_boosting")(_model_query("gradient_boosting"))
query("xgboost")(_model_query("xgboost"))
query("logistic_regression")(_model_query("logistic_regression"))
query("svm_rbf")(_model_query("svm"))
query("knn")(_model_query("knn"))
query("mlp")(_model_query("mlp"))


_ROOT_SQL = """WITH d AS (SELECT CAST(l.quality AS INT) AS y, CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(length(d.lang) + ascii(d.lang) AS DOUBLE) AS lang_code
  FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL),
x AS (SELECT 0 AS feature, n_chars AS v, y FROM d UNION ALL SELECT 1, lang_code, y FROM d),
g AS (SELECT feature, v, sum(0.5 - y) AS g, 0.25 * count(*) AS h, count(*) AS n FROM x GROUP BY feature, v),
c AS (SELECT feature, v, sum(g) OVER (PARTITION BY feature ORDER BY v) AS gl, sum(h) OVER (PARTITION BY feature ORDER BY v) AS hl,
             sum(g) OVER (PARTITION BY feature) AS gt, sum(h) OVER (PARTITION BY feature) AS ht,
             lead(v) OVER (PARTITION BY feature ORDER BY v) AS nxt, count(*) OVER (PARTITION BY feature) AS k FROM g),
s AS (SELECT feature, (v + nxt) / 2 AS cut, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain
      FROM c WHERE nxt IS NOT NULL AND hl >= 1 AND ht - hl >= 1)
SELECT feature, round(cut, 6) AS cut, round(gain, 6) AS gain FROM s"""


@query("boost_root_splits", _ROOT_SQL)
def boost_root_splits_q(spark, sf):
    """M3: every candidate split of the booster's first root (cut and regularised gain), from the sums its jobs make.

    Columns are the documents' lengths and a number of their language; each distinct value is a bin.
    """
    docs = B.table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                                                  (F.length("lang") + F.ascii("lang")).cast("double").alias("lang_code"))
    lab = B.table(spark, sf, "labels").where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = docs.join(lab, "doc_id").select(F.col("doc_id").alias("id"), "label", F.array("n_chars", "lang_code").alias("x"))
    return BO.root_splits(stage(rows.withColumn("features", array_to_vector("x")).drop("x"), "boost-rows"))


_SEARCH_SCHEMA = T.StructType([T.StructField("ord", T.IntegerType()), T.StructField("params", T.StringType()),
                               T.StructField("cv_accuracy", T.DoubleType())])


@query("grid_search")
def grid_search_q(spark, sf):
    """V3: the gradient-boosting grid with its 3-fold CV accuracy per combination."""
    f = train_model("gradient_boosting", model_input(spark, sf), C.QUERY_CONFIG)
    rows = [(i, str(sorted(p.items())), float(a)) for i, (p, a) in enumerate(f.search)]
    return spark.createDataFrame(rows, _SEARCH_SCHEMA)


_HISTORY_SCHEMA = T.StructType([T.StructField("step", T.IntegerType()), T.StructField("split", T.StringType()),
                                T.StructField("loss", T.DoubleType()), T.StructField("accuracy", T.DoubleType()),
                                T.StructField("kept", T.BooleanType())])


def _history(spark, f, kept_step: int) -> DataFrame:
    rows = [(int(s), sp, float(lo), None if a is None else float(a), int(s) == kept_step)
            for s, sp, lo, a in f.history]
    return spark.createDataFrame(rows, _HISTORY_SCHEMA)


@query("early_stop")
def early_stop_q(spark, sf):
    """V5: validation log-loss of every boosting prefix, the kept prefix flagged."""
    f = train_model("xgboost", model_input(spark, sf), C.QUERY_CONFIG)
    return _history(spark, f, f.params["rounds"])


@query("training_history")
def training_history_q(spark, sf):
    """E5: per-epoch train/validation loss and accuracy of the MLP."""
    f = train_model("mlp", model_input(spark, sf), C.QUERY_CONFIG)
    best = max(((s, a) for s, sp, _, a in f.history if sp == "val"), key=lambda t: (t[1], -t[0]))[0]
    return _history(spark, f, best)


@query("seed_sweep")
def seed_sweep_q(spark, sf):
    """V4: the forest once per split seed; leaderboard with the winner flagged."""
    best, fits = S.seed_sweep("random_forest", model_input(spark, sf), C.QUERY_CONFIG)
    board = S.leaderboard(spark, fits)
    return board.withColumn("best", F.col("seed") == F.lit(best.seed))


@query("rfxgb")
def rfxgb_q(spark, sf):
    """M4: best forest and best booster over the seeds, soft-voted."""
    data = model_input(spark, sf)
    return _predicted(S.rfxgb(data, C.QUERY_CONFIG)[0])


@query("ensemble_top3")
def ensemble_top3_q(spark, sf):
    """Six families, the three best by validation accuracy, soft-voted."""
    data = model_input(spark, sf)
    return _predicted(S.ensemble_top3(data, C.QUERY_CONFIG)[0])


@query("run_pipeline")
def run_pipeline_q(spark, sf):
    """E-1 end to end: RF features, a forest per seed, submission + model written per seed,
    each submission scored against the unlabelled subjects' true labels, best seed flagged."""
    lab, unl = B.labelled_unlabelled(spark, sf)
    truth = B.subjects(spark, sf).where(~F.col("is_train")).select(
        F.col("id").alias("PassengerId"), F.col("label").alias("Survived"))
    truth_path = scratch_path(spark, "truth")
    truth.write.mode("overwrite").option("header", True).csv(truth_path)
    res = RUN.run(spark, lab, unl, "randomforest", scratch_path(spark, "run"), cfg=C.QUERY_CONFIG, ground_truth=truth_path)
    return res.table(spark).drop("submission", "model")


@query("model_sink", """SELECT doc_id AS id, true AS same, true AS in_range FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)""")
def model_sink_q(spark, sf):
    """Save a vote of a forest and a logistic regression, load it back, and compare
    what the original and the loaded models predict for every unlabelled row."""
    data = model_input(spark, sf)
    fits = [train_model(m, data, C.QUERY_CONFIG) for m in ("random_forest", "logistic_regression")]
    loaded = load_scorer(spark, save_vote(fits, scratch_path(spark, "model"), spark))
    rows = data.where(~F.col("is_train")).select("id", "features")
    before = soft_vote([f.predict(rows) for f in fits]).select("id", F.col("p1").alias("p"), F.col("prediction").alias("y"))
    both = loaded(rows).join(before, "id")
    return both.select("id", ((F.abs(F.col("p1") - F.col("p")) < 1e-9) & (F.col("prediction") == F.col("y"))).alias("same"),
                       F.col("p1").between(0.0, 1.0).alias("in_range"))


# =============================================================================
# Composable pieces with SQL oracles
# =============================================================================

_KNN_K = 7


@query("knn_join", f"""WITH pts AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
q AS (SELECT * FROM pts WHERE id % 10 = 0), t AS (SELECT * FROM pts WHERE id % 10 <> 0),
d AS (SELECT q.id, t.id AS tid, t.label, list_distance(q.x, t.x) AS dist FROM q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, tid) AS rn FROM d),
top AS (SELECT * FROM r WHERE rn <= {_KNN_K}),
c AS (SELECT id, label, count(*) AS n FROM top GROUP BY id, label),
w AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS wr FROM c)
SELECT w.id, CAST(w.label AS INTEGER) AS prediction,
  round(coalesce((SELECT n FROM c WHERE c.id = w.id AND c.label = 1), 0) / {_KNN_K}.0, 6) AS p1
FROM w WHERE wr = 1""")
def knn_join_q(spark, sf):
    """Exact k nearest training vectors of every query vector, majority vote."""
    pts = B.embedding_points(spark, sf)
    nn = K.neighbours(pts.where("is_train"), pts.where(~F.col("is_train")), _KNN_K, p=2)
    return K.vote(nn, _KNN_K).select("id", "prediction", F.round("p1", 6).alias("p1"))


_RFF_D, _RFF_IN, _RFF_SEED = 8, 64, 7
_RFF_W, _RFF_B = V.rff_weights(_RFF_IN, _RFF_D, 1.0 / _RFF_IN, _RFF_SEED)


def _rff_sql() -> str:
    cols = []
    for j in range(_RFF_D):
        w = ", ".join(repr(float(v)) for v in _RFF_W[j])
        cols.append(f"round(sqrt(2.0 / {_RFF_D}) * cos(list_dot_product(x, [{w}]::DOUBLE[]) + "
                    f"{float(_RFF_B[j])!r}), 6) AS z{j}")
    return ("WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings) SELECT id, "
            + ", ".join(cols) + " FROM p")


@query("rff_map", _rff_sql())
def rff_map_q(spark, sf):
    """M6 kernel map: random Fourier features of every embedding."""
    pts = B.embedding_points(spark, sf)
    z = V.rff_map("features", _RFF_W, _RFF_B)
    return pts.select("id", *[F.round(z[j], 6).alias(f"z{j}") for j in range(_RFF_D)])


_PA = "CASE WHEN d.doc_id % 4 = 0 THEN 0.5 ELSE 1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE) + 1.0) - 7.0))) END"
_PB = "CASE WHEN d.doc_id % 4 = 0 THEN 0.5 ELSE CAST(d.doc_id % 100 AS DOUBLE) / 100.0 END"


@query("soft_vote", f"""WITH m AS (SELECT d.doc_id AS id, {_PA} AS pa, {_PB} AS pb FROM documents d)
SELECT id, round((pa + pb) / 2.0, 6) AS p1, CAST((pa + pb) / 2.0 > 0.5 AS INTEGER) AS prediction FROM m""")
def soft_vote_q(spark, sf):
    """M9: two probability members over every document; p = 0.5 votes 0."""
    d = B.table(spark, sf, "documents").select("doc_id", "n_chars")
    quarter = F.col("doc_id") % 4 == 0
    pa = F.when(quarter, 0.5).otherwise(1.0 / (1.0 + F.exp(-(F.ln(F.col("n_chars").cast("double") + 1.0) - 7.0))))
    pb = F.when(quarter, 0.5).otherwise((F.col("doc_id") % 100).cast("double") / 100.0)
    a = d.select(F.col("doc_id").alias("id"), pa.alias("p1"))
    b = d.select(F.col("doc_id").alias("id"), pb.alias("p1"))
    v = soft_vote([a, b])
    return v.select("id", F.round("p1", 6).alias("p1"), "prediction")


_BOARD_SQL = """WITH b AS (SELECT d.source AS name, avg(CAST(l.quality = l.toxic AS DOUBLE)) * 100 AS val_acc
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY d.source),
o AS (SELECT *, CAST(dense_rank() OVER (ORDER BY name) - 1 AS INTEGER) AS ord FROM b)"""


def _board(spark, sf) -> DataFrame:
    lab = B.table(spark, sf, "labels")
    docs = B.table(spark, sf, "documents").select("doc_id", "source")
    b = (lab.join(docs, "doc_id").groupBy(F.col("source").alias("name"))
         .agg((F.avg((F.col("quality") == F.col("toxic")).cast("double")) * 100).alias("val_acc")))
    return category_codes(b, "name", "ord")


@query("leaderboard_topk", _BOARD_SQL + " SELECT ord, name, round(val_acc, 6) AS val_acc FROM o "
       "ORDER BY val_acc DESC, ord LIMIT 3")
def leaderboard_topk_q(spark, sf):
    """O2: the three best rows by score, registration order breaking ties."""
    top = leaderboard_topk(_board(spark, sf), 3)
    return top.select("ord", "name", F.round("val_acc", 6).alias("val_acc"))


@query("leaderboard_sink", _BOARD_SQL + " SELECT ord, name, round(val_acc, 6) AS val_acc FROM o")
def leaderboard_sink_q(spark, sf):
    """Leaderboard written as JSON lines and read back."""
    path = sinks.write_leaderboard(_board(spark, sf), scratch_path(spark, "board"))
    back = spark.read.schema("ord INT, name STRING, val_acc DOUBLE").json(path)
    return back.select("ord", "name", F.round("val_acc", 6).alias("val_acc"))


@query("submission_sink", "SELECT doc_id AS PassengerId, toxic AS Survived FROM labels")
def submission_sink_q(spark, sf):
    """S3: (id, prediction) written as a headered, id-sorted CSV and read back."""
    lab = B.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("prediction"))
    path = sinks.write_submission(lab, scratch_path(spark, "submission"))
    return spark.read.schema("PassengerId BIGINT, Survived INT").option("header", True).csv(path)


@query("sort_by_id", "SELECT doc_id AS PassengerId, quality AS Survived FROM labels ORDER BY doc_id")
def sort_by_id_q(spark, sf):
    """O1: predictions in ascending id order under the output header names."""
    lab = B.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("prediction"))
    return sinks.submission_frame(lab)


_PASSENGER_OUT = {v: k for k, v in CSV.PASSENGER_HEADER.items()}


_CSV_COLS = ("id", "label", "pclass", "name", "sex", "age", "sibsp", "parch", "ticket", "fare", "cabin", "embarked")


@query("csv_scan", O.W() + "SELECT " + ", ".join(
    "concat(name, ' (\"Q\")') AS name" if c == "name" else c for c in _CSV_COLS) + " FROM subjects")
def csv_scan_q(spark, sf):
    """Subjects written under the original headers as CSV and read back typed.

    Every name carries a comma and a quoted part, so the reader's RFC-4180
    quoting (doubled inner quotes) is exercised on every row.
    """
    s = B.subjects(spark, sf).select(*_CSV_COLS)
    s = s.withColumn("name", F.concat(F.col("name"), F.lit(' ("Q")')))
    out = s.select(*[F.col(c).alias(_PASSENGER_OUT[c]) for c in s.columns])
    path = scratch_path(spark, "passengers")
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return CSV.read_passengers(spark, path).select(*_CSV_COLS)


def _labels_csv(spark, sf, value: str, name: str) -> str:
    lab = B.table(spark, sf, "labels").select(F.col("doc_id").alias("PassengerId"),
                                              F.col(value).alias("Survived"))
    path = scratch_path(spark, name)
    lab.write.mode("overwrite").option("header", True).csv(path)
    return path


@query("label_scan_strict", "SELECT doc_id AS id, quality AS label FROM labels")
def label_scan_strict_q(spark, sf):
    """The strict (id, label) reader over a labels file written from the table."""
    return CSV.load_labels(spark, _labels_csv(spark, sf, "quality", "truth"))


_SCORE_SCHEMA = T.StructType([T.StructField("accuracy", T.DoubleType()), T.StructField("matches", T.LongType()),
                              T.StructField("total", T.LongType())])


@query("score_submission", """SELECT round(avg(CAST(quality = toxic AS DOUBLE)), 6) AS accuracy,
 CAST(sum(CAST(quality = toxic AS INTEGER)) AS BIGINT) AS matches, count(*) AS total FROM labels""")
def score_submission_q(spark, sf):
    """Strict-read a truth file and a prediction file, align by key, score."""
    truth = _labels_csv(spark, sf, "quality", "truth")
    pred = _labels_csv(spark, sf, "toxic", "pred")
    acc, matches, total = score_submission(spark, pred, truth)
    return spark.createDataFrame([(round(acc, 6), matches, total)], _SCORE_SCHEMA)
