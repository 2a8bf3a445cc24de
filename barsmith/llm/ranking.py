"""Quality classifier by Bradley-Terry ranking of document pairs.

Each preference pair holds a document labelled good and one labelled bad; the chance that the
good one wins is the logistic function of the difference of their scores. Scores are linear in
measures of the text, so fitting is logistic regression on feature differences. The cut is the
quantile of the training scores that separates the labels best, and the published score is the
logistic of the distance from the cut, shifted so that the cut itself scores ``CUT_SCORE``.

Fitting uses a bounded sample of labelled rows (``SAMPLE``, in the order of a hash); scoring is
one projection over every whole text, with no shuffle.

Defined cases: null texts count as empty, empty texts get the score of all-zero measures; equal
texts get equal scores; rows without an id are scored and not held out; with labels of one kind
only, or none, every weight is 0 and every score is above the cut; an empty table gives an empty
result; labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import measure, measures

#: Labelled rows to fit on at most.
SAMPLE = 20_000
#: Good documents that each bad one is compared with.
RIVALS = 20
#: Strength of the pull of weights towards 0, per pair.
RIDGE = 1e-3
CUT_SCORE = 0.3
FOLDS, HELD_OUT = 5, 0

#: Measures that are 0 in clean prose, and where each is half as bad as it gets.
FLAWS = {
    "symbol_ratio": 0.05, "bang_ratio": 0.05, "repeat_ratio": 0.2, "repeat_neighbour_ratio": 0.1, "dup_line_ratio": 0.3,
}
FEATURES = (*FLAWS, "stop_word_ratio", "word_length", "log_words")


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def features(m: Column) -> list[Column]:
    flaws = [measure(name, m) / (measure(name, m) + half) for name, half in FLAWS.items()]
    return [
        *flaws, measure("stop_word_ratio", m), F.least(F.abs(measure("mean_word_chars", m) - 5.0), F.lit(5.0)) / 5.0,
        F.log1p(m["n_words"].cast("double")) / 10.0,
    ]


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    cut: float

    def raw(self, m: Column) -> Column:
        total = F.lit(0.0)
        for w, x in zip(self.weights, features(m)):
            total = total + F.lit(w) * x
        return total

    def score(self, m: Column) -> Column:
        shift = float(np.log(CUT_SCORE / (1 - CUT_SCORE)))
        return 1.0 / (1.0 + F.exp(-(self.raw(m) - F.lit(self.cut) + F.lit(shift))))


def fit_pairs(x: np.ndarray, good: np.ndarray, rivals: int = RIVALS, ridge: float = RIDGE) -> np.ndarray:
    """Weights that maximise the likelihood of the good document winning each pair (Newton's method)."""
    best, worst = x[good], x[~good]
    weights = np.zeros(x.shape[1])
    if not len(best) or not len(worst):
        return weights
    # Fixed, evenly spread opponents: the k-th of each bad document.
    at = (np.arange(len(worst))[:, None] * 7919 + np.arange(rivals)[None, :] * 104729) % len(best)
    diff = (best[at] - worst[:, None, :]).reshape(-1, x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(diff @ weights, -30, 30)))
        slope = diff.T @ (1 - p) / len(diff) - ridge * weights
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def quantile_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The middle of the gap at the score quantile with the best balanced accuracy."""
    if good.all() or not good.any():
        return float(scores.min()) - 1.0 if len(scores) else -1.0
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()
    caught = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    edge = np.concatenate([[True], s[1:] > s[:-1], [True]])  # equal scores stay together
    k = int(np.where(edge, caught - lost, -1).argmax())
    return float(s[0] - 1 if k == 0 else s[-1] + 1 if k == len(s) else (s[k - 1] + s[k]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """Features and label of the sampled rows."""
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers.
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return measures(known).select(F.array(*features(F.col("_m"))).alias("x"), "_label", "doc_id").orderBy(F.xxhash64("doc_id"), "x")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    rows = training_rows(docs, labels, label, sample).limit(2 * sample).collect()
    if not rows:
        return Model((0.0,) * len(FEATURES), -1.0)
    x = np.array([r["x"] for r in rows], float)
    good = np.array([r["_label"] == 1 for r in rows])
    weights = fit_pairs(x, good)
    return Model(tuple(map(float, weights)), quantile_cut(x @ weights, good))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = measures(docs.select("doc_id", "text")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("_m")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT_SCORE).cast("int"))
