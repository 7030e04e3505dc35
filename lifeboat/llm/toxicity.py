"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

Severity grades 0 < 1 < ... < K-1 share one weight per word; ordered
thresholds t_1 <= ... <= t_{K-1} give P(grade >= k) = sigmoid(w.x - t_k), and
the expected severity is the sum of those probabilities. x has a 1 for each
distinct word and word stem of the whole text. Weights carry an L1 penalty, so words
without evidence weigh exactly nothing and a long clean text gathers no score.

The model is fitted on a bounded sample of labelled rows: the ``sample_rows``
labelled ids with the smallest hash (a documented bound; more labels do not
make the driver hold more). Scoring covers every row, in Arrow batches, and
moves no text.

Defined results: a null text has no words and the score of the thresholds
alone; labels that are null, or whose document is missing, are left out; of
several labels the highest counts; without a labelled row of grade 1 or more
every severity is 0. Repeated rows are scored one by one; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import stage, text_or_empty

_WORD = re.compile(r"[^\W_]+")
#: Besides a word itself, its beginnings of these lengths are features: inflected forms share them.
STEMS = (4, 5, 6, 7)


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if n <= len(word))]


def text_features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in features(w)}


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 10_000      # labelled rows the model is fitted on, at most
    least_rows: int = 3            # rows of the sample that must have a feature
    features: int = 4_000          # words and stems kept: those that speak for toxicity, strongest first
    least_z: float = 3.0           # standard deviations by which a feature's toxic rows exceed the base rate
    levels: int = 3                # toxic grades made of 0/1 labels
    l1_rows: float = 0.25          # L1 penalty, in rows of the sample
    rounds: int = 600


#: Words whose weighted features a Python worker remembers.
_KNOWN_WORDS = 300_000


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()

    def at_least(self, text: str, known: dict[str, tuple[str, ...]]) -> np.ndarray:
        """P(grade >= k), k = 1.. of one text; ``known`` caches the weighted features of words."""
        if not self.thresholds:
            return np.zeros(1)
        if len(known) > _KNOWN_WORDS:
            known.clear()
        hit = set()
        for w in set(_WORD.findall(text.lower())):
            got = known.get(w)
            if got is None:
                got = known[w] = tuple(f for f in features(w) if f in self.weights)
            hit.update(got)
        score = sum(self.weights[f] for f in sorted(hit))
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - score, -60, 60)))


def _class_probability(m, t):
    s = 1 / (1 + np.exp(np.clip(t[None, :] - m[:, None], -60, 60)))
    return np.concatenate([np.ones((len(m), 1)), s, np.zeros((len(m), 1))], 1)


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_features: int, l1: float,
                rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient, on the mean loss.

    Weights are 0 or more: every feature was chosen because it speaks for toxicity.
    """
    n, k = len(y), int(y.max()) + 1
    cost = 1 / n
    at = np.arange(n)

    def loss(w, t, slope=False):
        m = np.bincount(rows, w[cols], n)
        s = _class_probability(m, t)
        p = np.maximum(s[at, y] - s[at, y + 1], 1e-12)
        value = -(cost * np.log(p)).sum()
        if not slope:
            return value
        ds = s * (1 - s)
        dm = -cost * (ds[at, y] - ds[at, y + 1]) / p
        gt = np.zeros(k + 1)
        np.add.at(gt, y, cost * ds[at, y] / p)
        np.add.at(gt, y + 1, -cost * ds[at, y + 1] / p)
        return value, np.bincount(cols, dm[rows], n_features), gt[1:k]

    above = np.clip([(y >= c).mean() for c in range(1, k)], 1e-6, 1 - 1e-6)
    w, t = np.zeros(n_features), np.log(1 / above - 1)      # thresholds of the grades' shares
    vw, vt, mom, step = w, t, 1.0, 1.0
    for _ in range(rounds):
        value, gw, gt = loss(vw, vt, True)
        while True:
            nw = vw - step * gw
            nw = np.maximum(nw - step * l1, 0)
            nt = np.maximum.accumulate(vt - step * gt)
            dw, dt = nw - vw, nt - vt
            bound = value + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * step)
            if step < 1e-9 or loss(nw, nt) <= bound + 1e-12:
                break
            step /= 2
        nxt = (1 + np.sqrt(1 + 4 * mom * mom)) / 2
        vw, vt = nw + (mom - 1) / nxt * (nw - w), nt + (mom - 1) / nxt * (nt - t)
        vt = np.maximum.accumulate(vt)
        w, t, mom, step = nw, nt, nxt, step * 1.2
    return w, t


def marker_grades(toxic: np.ndarray, rows: np.ndarray, cols: np.ndarray, marker: np.ndarray, levels: int) -> np.ndarray:
    """Grades from 0/1 labels: toxic rows by quantiles of how many features they have that only toxic rows have."""
    count = np.bincount(rows, marker[cols], len(toxic))
    cuts = np.quantile(count[toxic > 0], np.arange(1, levels) / levels)
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, count, side="left"), 0)


def fit(docs: DataFrame, labels: DataFrame, grade: Column, text_col: str = "text", id_col: str = "doc_id",
        label_id: str = "doc_id", settings: Settings = Settings()) -> Model:
    """Fit on the labelled sample; ``grade`` is an integer expression over ``labels``.

    Labels of 0 and 1 only are first graded 0..levels by ``marker_grades``.
    """
    graded = labels.select(F.col(label_id).alias("id"), grade.cast("int").alias("grade")).dropna()
    sample = stage(graded.groupBy("id").agg(F.max("grade").alias("grade"))
                   .orderBy(F.xxhash64("id"), "id").limit(settings.sample_rows), "sample")

    def distinct_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([sorted(text_features(t.as_py())) for t in b.column(2)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), found], ["id", "grade", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    # The sample is broadcast: at most sample_rows pairs of numbers.
    own = (docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(sample), "id")
           .select("id", "grade", "text").mapInArrow(distinct_features, f"id {kind}, grade int, features array<string>"))
    rows = stage(own.groupBy("id").agg(F.max("grade").alias("grade"), F.min("features").alias("features")), "sample-features")
    n, toxic = rows.agg(F.count("*"), F.sum((F.col("grade") > 0).cast("long"))).first()
    if not toxic:
        return Model()
    base = toxic / n
    counted = (rows.select((F.col("grade") > 0).cast("long").alias("y"), F.explode("features").alias("feature")).groupBy("feature")
               .agg(F.count("*").alias("n"), F.sum("y").alias("y")).filter(F.col("n") >= settings.least_rows))
    z = (F.col("y") - base * F.col("n")) / F.sqrt(F.col("n") * max(base * (1 - base), 1e-6))
    kept = counted.filter(z >= settings.least_z).orderBy(F.round(z, 9).desc(), "feature").limit(settings.features).collect()
    vocabulary = {r["feature"]: i for i, r in enumerate(kept)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[vocabulary[f] for f in fs.as_py() if f in vocabulary] for fs in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32()))], ["id", "grade", "x"])

    got = rows.mapInArrow(index, f"id {kind}, grade int, x array<int>").toArrow().sort_by("id")
    y = np.maximum(got.column("grade").to_numpy().astype(np.int64), 0)
    x = got.column("x").combine_chunks()
    cols = x.flatten().to_numpy().astype(np.int64)
    at = np.repeat(np.arange(len(y)), np.diff(x.offsets.to_numpy()))
    if y.max() == 1:
        y = marker_grades(y, at, cols, np.array([r["y"] == r["n"] for r in kept], float), settings.levels)
    w, t = fit_ordinal(at, cols, y, max(1, len(vocabulary)), settings.l1_rows / len(y), settings.rounds)
    return Model({f: float(w[i]) for f, i in vocabulary.items() if w[i]}, tuple(float(v) for v in t))


def severity(model: Model, text: Column) -> Column:
    """Struct column (severity, p_toxic, grade): expected grade, P(grade >= 1), most grades passed at 0.5."""
    known: dict[str, tuple[str, ...]] = {}

    @F.pandas_udf("severity double, p_toxic double, grade int")
    def score(texts: pd.Series) -> pd.DataFrame:
        p = [model.at_least(t, known) for t in texts]
        return pd.DataFrame({"severity": [float(v.sum()) for v in p], "p_toxic": [float(v[0]) for v in p],
                             "grade": np.array([int((v >= 0.5).sum()) for v in p], np.int32)})

    return score(text)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose P(grade >= 1) reaches ``limit``; same columns, no shuffle."""
    return docs.filter(severity(model, text_or_empty(text_col))["p_toxic"] < limit)
