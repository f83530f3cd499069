"""Operator 4, quality classifier: naive Bayes support vectors.

Binary n-gram indicators are scaled by the log ratio of the two classes' smoothed counts; a linear hinge-loss
model is fitted to them by dual coordinate descent, and its margin is turned into a score by a logistic curve.

Learns from at most SAMPLE labelled rows, those with the least hash of their id; scores every whole text.

Defined results: null and empty texts have no terms and get the score of the intercept; without labelled rows of
both classes every score is the smoothed share of label 1; a score of exactly 0.5 counts as 1; rows with equal hashes
of their ids go into the sample by id and label; repeated rows give a row each; an empty table none; other columns are
not read (``keep_good`` keeps them); texts are read whole, whatever their length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.terms import BITS, kept_rows, labelled_sample, remainder, scored, style_terms, verdicts

SAMPLE = 16_000
#: Rows whose remainder is this aren't learned from.
PARTS, HELD_OUT = 3, 1


@dataclass
class NbSvm:
    """Weights by term, already times the log ratio; score = logistic(slope * margin + offset)."""

    weight: np.ndarray
    intercept: float
    slope: float
    offset: float

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        terms = style_terms(data, at)
        margin = np.bincount(terms >> BITS, weights=self.weight[terms & ((1 << BITS) - 1)], minlength=len(at) - 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.intercept) + self.offset, -500, 500)))


def log_ratios(rows: list[np.ndarray], sign: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Per term, the log of its smoothed share among documents of class +1 over that among -1."""
    counts = [np.bincount(np.concatenate([x for x, y in zip(rows, sign, strict=True) if y == side] or [[]]).astype(int),
                          minlength=1 << BITS) + smooth for side in (1, -1)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def dual_descent(rows: list[np.ndarray], sign: np.ndarray, scale: np.ndarray, cost: float = 0.1,
                 epochs: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Minimises |w|^2/2 + cost * sum of squared hinge losses: one dual variable per example, in random order."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = [scale[x] for x in rows]
    # the squared loss adds 1/(2 cost) to each diagonal entry; the last 1 is the intercept's
    diagonal = np.array([v @ v for v in values]) + 1 + 1 / (2 * cost)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for k in order.permutation(len(rows)):
            x, v, y = rows[k], values[k], sign[k]
            gradient = y * (w[x] @ v + bias) - 1 + alpha[k] / (2 * cost)
            step = max(alpha[k] - gradient / diagonal[k], 0.0) - alpha[k]
            if step:
                alpha[k] += step
                w[x] += step * y * v
                bias += step * y
                most = max(most, abs(gradient))
        if most < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, target: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method on targets drawn in from 0 and 1."""
    n1 = target.sum()
    t = np.where(target == 1, (n1 + 1) / (n1 + 2), 1 / (len(target) - n1 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    b = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (t - p))
        b += move * min(1, 2 / max(1e-9, np.abs(move).max()))
    return float(max(b[0], 1e-6)), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> NbSvm:
    learn = labels.filter(remainder(F.col("doc_id"), PARTS) != HELD_OUT)
    rows, label = labelled_sample(docs, learn, "quality", sample, style_terms)
    if len(set(label.tolist())) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        return NbSvm(np.zeros(1 << BITS), 0.0, 1.0, float(np.log(share / (1 - share))))
    sign = np.where(label == 1, 1, -1)
    ratio = log_ratios(rows, sign)
    w, bias = dual_descent(rows, sign, ratio)
    weight = w * ratio
    margin = np.array([weight[x].sum() for x in rows]) + bias
    return NbSvm(weight, float(bias), *logistic_curve(margin, label))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    model = fit(docs, labels, sample)
    return verdicts(scored(docs, model.score), remainder(F.col("doc_id"), PARTS) == HELD_OUT)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows that the classifier takes for good ones, with all their columns."""
    model = fit(docs, labels, sample)
    return kept_rows(docs, lambda data, at: model.score(data, at) >= 0.5)
