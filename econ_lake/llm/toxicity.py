"""Operator 10, toxicity: a factorization machine over hashed terms.

score = logistic(b + sum w_i + sum over pairs <v_i, v_j>) over the distinct terms of a text.  The factors let a
pair of terms (an insult with the mention of a group) weigh what neither does alone.

Learns from at most SAMPLE labelled rows, those with the least hash of their id, over all hashed terms that LEAST or
more of them have (2^18 at most, with FACTORS numbers each).  The terms whose shares differ between the classes beyond
chance learn first; if their mean loss stays above ENOUGH, all terms learn what those leave unexplained, such as pairs
whose members tell nothing alone.  So the many other terms add no noise where nothing is left.  Scores every whole text.

Defined results: null and empty texts have no terms and get the score of the intercept; without labelled rows of
both classes every score is the smoothed share of label 1; a score of exactly 0.5 counts as 1; rows with equal hashes
of their ids go into the sample by id and label; repeated rows give a row each; an empty table none; other columns
are not read; texts are read whole, whatever their length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.terms import BITS, labelled_sample, remainder, scored, verdicts, word_terms

SAMPLE = 16_000
PARTS, HELD_OUT = 5, 0
LEAST, FACTORS = 3, 8
#: Documents of a step, and steps in all; learning ends earlier once a round's mean loss is below ENOUGH.
BATCH, STEPS, ENOUGH = 32, 6_000, 0.02


@dataclass
class FactorizationMachine:
    place: np.ndarray  # of each hashed term among those used, -1 for the others
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """The value before the logistic curve, of n rows given as parallel arrays of row and used term."""
        sums = np.stack([np.bincount(rows, weights=self.factors[terms, k], minlength=n)
                         for k in range(self.factors.shape[1])], 1)
        squares = np.bincount(rows, weights=(self.factors[terms] ** 2).sum(1), minlength=n)
        return self.bias + np.bincount(rows, weights=self.linear[terms], minlength=n) + (
            (sums**2).sum(1) - squares) / 2

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        got = word_terms(data, at)
        used = self.place[got & ((1 << BITS) - 1)]
        rows = (got >> BITS)[used >= 0]
        return 1 / (1 + np.exp(-np.clip(self.raw(rows, used[used >= 0], len(at) - 1), -500, 500)))


class Batch:
    """Documents of a step: their terms end to end, where each document begins, and the distinct terms."""

    def __init__(self, rows: list[np.ndarray], label: np.ndarray):
        self.label = label
        size = np.array([len(r) for r in rows])
        self.some = np.flatnonzero(size)  # documents without a term have nothing to add up
        self.first = np.cumsum(size)[self.some] - size[self.some]
        self.row = np.repeat(np.arange(len(rows)), size)
        self.used, self.place = np.unique(np.concatenate(rows).astype(np.int64), return_inverse=True)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.label), *values.shape[1:]))
        if len(self.some):
            out[self.some] = np.add.reduceat(values, self.first)
        return out

    def per_term(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, weights=values, minlength=len(self.used))


def learned(rows: list[np.ndarray], label: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray, rate: float,
            pair_rate: float, decay: float, seed: int) -> float:
    """Moves weights and factors by steps over batches, and returns the intercept; each coordinate's step is scaled by
    the gradients that it has seen.  Pairs learn more slowly than single terms, so that they explain what those don't."""
    rng = np.random.default_rng(seed)
    weight = len(label) / (2 * np.bincount(label, minlength=2))  # both classes count alike
    order = rng.permutation(len(rows))
    batches = [Batch([rows[k] for k in order[a:a + BATCH]], label[order[a:a + BATCH]])
               for a in range(0, len(rows), BATCH)]
    gb, gw, gv = 1e-2, np.full(w.shape, 1e-2), np.full(v.shape, 1e-2)
    for _ in range(-(-STEPS // len(batches))):
        loss = 0.0
        for k in rng.permutation(len(batches)):
            b = batches[k]
            own = v[b.used][b.place]
            total = b.per_document(own)
            value = np.clip(bias + b.per_document(w[b.used][b.place]) + (
                (total**2).sum(1) - b.per_document((own**2).sum(1))) / 2, -30, 30)
            loss += float((weight[b.label] * np.log1p(np.exp(np.where(b.label == 1, -value, value)))).sum())
            error = weight[b.label] * (1 / (1 + np.exp(-value)) - b.label)
            each = error[b.row][:, None] * (total[b.row] - own)
            step = np.stack([b.per_term(each[:, f]) for f in range(FACTORS)], 1) + decay * v[b.used]
            gv[b.used] += step**2
            v[b.used] -= pair_rate * step / np.sqrt(gv[b.used])
            step = b.per_term(error[b.row]) + decay * w[b.used]
            gw[b.used] += step**2
            w[b.used] -= rate * step / np.sqrt(gw[b.used])
            gb += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(gb)
        if loss < ENOUGH * len(rows):
            break
    return bias, loss / len(rows)


def telling_terms(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """The terms whose shares in the two classes lie further apart, in standard errors, than the furthest of as many
    terms without meaning would by chance."""
    n = np.array([(label == c).sum() for c in (0, 1)])
    count = np.stack([np.bincount(np.concatenate([r for r, y in zip(rows, label, strict=True) if y == c]).astype(int),
                                  minlength=1 << BITS) for c in (0, 1)])
    share, both = count / n[:, None], count.sum(0) / n.sum()
    apart = np.abs(share[1] - share[0]) / (np.sqrt(both * (1 - both) * (1 / n).sum()) + 1e-12)
    often = count.sum(0) >= LEAST
    return np.flatnonzero(often & (apart > np.sqrt(2 * np.log(max(2, often.sum())))))


def trained(rows: list[np.ndarray], label: np.ndarray, seed: int = 1) -> FactorizationMachine:
    """The machine learned from documents given as their hashed terms."""
    rng, place = np.random.default_rng(seed), np.full(1 << BITS, -1)
    share = (label.sum() + 1) / (len(label) + 2)
    bias, loss = float(np.log(share / (1 - share))), np.inf
    if len(set(label.tolist())) < 2:
        return FactorizationMachine(place, bias, np.zeros(1), np.zeros((1, FACTORS)))
    used = np.flatnonzero(np.bincount(np.concatenate(rows), minlength=1 << BITS) >= LEAST)
    place[used] = np.arange(len(used))
    w, v = np.zeros(len(used)), np.zeros((len(used), FACTORS))
    inner = [x[x >= 0] for x in (place[r] for r in rows)]
    first = place[telling_terms(rows, label)]
    if len(first):
        at = np.full(len(used), -1)
        at[first] = np.arange(len(first))
        own_w, own_v = w[first], rng.normal(0, 0.05, (len(first), FACTORS))
        bias, loss = learned([x[x >= 0] for x in (at[r] for r in inner)], label, bias, own_w, own_v, 0.1, 0.01, 1e-2,
                             seed)
        w[first], v[first] = own_w, own_v
    if loss > ENOUGH:
        others = np.setdiff1d(np.arange(len(used)), first)
        v[others] = rng.normal(0, 0.01, (len(others), FACTORS))
        bias, _ = learned(inner, label, bias, w, v, 0.1, 0.05, 1e-3, seed)
    return FactorizationMachine(place, bias, w, v)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorizationMachine:
    learn = labels.filter(remainder(F.col("doc_id"), PARTS) != HELD_OUT)
    return trained(*labelled_sample(docs, learn, "toxic", sample, word_terms))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    model = fit(docs, labels, sample)
    return verdicts(scored(docs, model.score), remainder(F.col("doc_id"), PARTS) == HELD_OUT)
