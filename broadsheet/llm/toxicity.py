"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import over_text
from broadsheet.llm.features import HashedTerms, labelled_sample, select_terms

#: Bounds of the labelled sample that the model is fitted on, for each label.
TOXIC_ROWS, OTHER_ROWS = 3000, 6000
#: Terms of the machine, and the least G that a term's presence must reach.
TERMS, LEAST_G = 2048, 30.0
FACTORS, EPOCHS, RATE, DECAY = 8, 300, 0.05, 1e-3


@dataclass
class FactorizationMachine:
    """log-odds = bias + sum of weights + sum over pairs of terms of the products of their factors."""

    slots: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def log_odds(self, terms: np.ndarray) -> float:
        if not len(terms):
            return self.bias
        v = self.factors[terms]
        s = v.sum(axis=0)
        return float(self.bias + self.weights[terms].sum() + 0.5 * ((s * s) - (v * v).sum(axis=0)).sum())

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        z = np.array([self.log_odds(s) for s in sets])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit(sets: list[np.ndarray], y: np.ndarray, terms: int = TERMS, least: float = LEAST_G, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 3) -> FactorizationMachine:
    """Full-batch Adam on the log loss with weight decay, over the terms that tell the labels apart.

    Without labelled rows, or with one label only, the machine has no terms and the bias gives the share seen (0 if none).
    """
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1e-3
    slots = select_terms(sets, y, terms, least) if 0 < y.sum() < len(y) else np.empty(0, np.int64)
    bias = float(np.log(share / (1 - share)))
    if not len(slots):
        return FactorizationMachine(slots, bias, np.zeros(0), np.zeros((0, factors)))
    x = np.zeros((len(y), len(slots)), np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(slots, s)
        at = at[at < len(slots)]
        x[i, np.intersect1d(at, np.flatnonzero(np.isin(slots, s)))] = 1
    r = np.random.default_rng(seed)
    p = [np.array([bias], np.float32), np.zeros(len(slots), np.float32), r.normal(0, 0.02, (len(slots), factors)).astype(np.float32)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for t in range(1, epochs + 1):
        s = x @ p[2]
        z = p[0] + x @ p[1] + 0.5 * ((s * s).sum(axis=1) - x @ (p[2] * p[2]).sum(axis=1))
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y).astype(np.float32) / len(y)
        xe = x.T @ e
        g = [np.array([e.sum()]), xe + DECAY * p[1] / len(slots), x.T @ (e[:, None] * s) - xe[:, None] * p[2] + DECAY * p[2] / len(slots)]
        for k in range(3):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] * g[k]
            p[k] = (p[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return FactorizationMachine(slots, float(p[0][0]), p[1].astype(np.float64), p[2].astype(np.float64))


def train(docs: DataFrame, labels: DataFrame, rows, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: dict | None = None) -> FactorizationMachine:
    """Fit on at most per_class rows of each label, from the ids that rows(id) selects."""
    per_class = per_class or {1: TOXIC_ROWS, 0: OTHER_ROWS}
    sample = labelled_sample(docs, labels, rows, F.col(label_col).cast("int"), per_class, id_col, text_col)
    bags = HashedTerms(None)
    sets = []
    for at in range(0, len(sample), 500):
        sets += bags.sets(pa.array([t for t, _ in sample[at : at + 500]], pa.string()))
    return fit(sets, np.array([y for _, y in sample], np.float64))


def score(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of docs: id, score, predicted, from the whole text.

    A text without known terms, null and empty ones too, gets the bias. Nothing is shuffled. An empty table gives no rows.
    Other columns of docs are not read.
    Rows that repeat an id are scored by their own texts; columns of docs named like a result don't clash, unless id_col has
    that name, which is an error.
    """
    bags = HashedTerms(model.slots)

    def rows_of(batch):
        s = model.scores(bags.sets(pa.array(batch, pa.string())))
        return {"score": pa.array(s, pa.float64()), "predicted": pa.array((s >= threshold).astype(np.int32), pa.int32())}

    return over_text(docs, [id_col], text_col, "score double, predicted int", rows_of, rows=2000)
