"""Quality: attention-based multiple-instance learning over the passages of a document."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import over_text
from broadsheet.llm.features import labelled_sample, passages

#: Bounds of the labelled sample that the model is fitted on, for each label.
GOOD_ROWS, POOR_ROWS = 3000, 3000
PASSAGE_CHARS = 512
HIDDEN, ATTENTION, EPOCHS, RATE, DECAY = 24, 12, 400, 0.01, 1e-4


def encode(batch: list[str], chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(a row for each passage, passages of each text): square roots of the shares of class pairs, the passage's fill, and
    what it repeats of itself, as the share that compression leaves."""
    counts, count = passages(batch, chars)
    n = counts.sum(axis=1, keepdims=True)
    pack = zstandard.ZstdCompressor(level=1).compress
    left = []
    for t in batch:
        for at in range(0, max(1, len(t)), chars):
            raw = t[at : at + chars].encode("utf-8", "surrogatepass")
            left.append(len(pack(raw)) / (len(raw) + 16))
    return np.concatenate([np.sqrt(counts / np.maximum(n, 1)), np.log1p(n) / 7, np.array(left, np.float32)[:, None]], axis=1), count


@dataclass
class AttentionModel:
    """h = tanh(E x); weight ~ exp(w . (tanh(V h) * sigmoid(U h))); document = weighted mean of h; score = sigmoid(c . document)."""

    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]
    chars: int = PASSAGE_CHARS

    def forward(self, x: np.ndarray, count: np.ndarray):
        """x: passages of all documents in order; count: passages a document (at least one)."""
        p = self.params
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * g) @ p["w"]
        first = np.cumsum(count) - count
        doc = np.repeat(np.arange(len(count)), count)
        a = np.exp(a - np.maximum.reduceat(a, first)[doc])
        a = a / np.add.reduceat(a, first)[doc]
        d = np.add.reduceat(a[:, None] * h, first, axis=0)
        z = d @ p["c"] + p["b"][0]
        return h, t, g, a, d, doc, first, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def inputs(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        x, n = encode(batch, self.chars)
        return ((x - self.mean) / self.scale).astype(np.float32), n

    def scores(self, batch: list[str]) -> np.ndarray:
        if not batch or not self.params:
            return np.full(len(batch), float(self.mean[0]) if not self.params else 0.0)
        x, n = self.inputs(batch)
        return self.forward(x, n)[-1].astype(np.float64)

    def attention(self, text: str) -> np.ndarray:
        """The weight of each passage of a text."""
        x, n = self.inputs([text])
        return self.forward(x, n)[3]


def fit(texts: list[str], y: np.ndarray, chars: int = PASSAGE_CHARS, epochs: int = EPOCHS, seed: int = 5) -> AttentionModel:
    """Adam over mini-batches of documents, each class weighing its share in the sample; with one label only, its share."""
    if not len(y) or y.min() == y.max():
        return AttentionModel(np.array([y.mean() if len(y) else 0.0]), np.ones(1), {}, chars)
    parts = [encode(texts[i : i + 64], chars) for i in range(0, len(texts), 64)]  # few at once: characters are wide here
    x, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    x = ((x - mean) / scale).astype(np.float32)
    r = np.random.default_rng(seed)
    k = x.shape[1]

    def draw(a, b):
        return r.normal(0, 1 / np.sqrt(a), (a, b)).astype(np.float32)

    p = {"E": draw(k, HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION), "w": np.zeros(ATTENTION, np.float32), "c": np.zeros(HIDDEN, np.float32), "b": np.zeros(1, np.float32)}
    model = AttentionModel(mean, scale, p, chars)
    first = np.cumsum(n) - n
    m, v = {q: np.zeros_like(p[q]) for q in p}, {q: np.zeros_like(p[q]) for q in p}
    step, size = 0, 256
    rounds = max(6, epochs * size // max(size, len(y)))
    for _ in range(rounds):
        order = r.permutation(len(y))
        for at in range(0, len(y), size):
            ids = np.sort(order[at : at + size])
            rows = np.concatenate([np.arange(first[i], first[i] + n[i]) for i in ids])
            xb, nb, yb = x[rows], n[ids], y[ids]
            h, t, g, a, d, doc, f, s = model.forward(xb, nb)
            e = ((s - yb) / len(yb)).astype(np.float32)
            dd = e[:, None] * p["c"]
            ga = (h * dd[doc]).sum(axis=1)
            da = a * (ga - np.add.reduceat(a * ga, f)[doc])
            dt, dg = da[:, None] * p["w"] * g * (1 - t * t), da[:, None] * p["w"] * t * g * (1 - g)
            dh = a[:, None] * dd[doc] + dt @ p["V"].T + dg @ p["U"].T
            dx = dh * (1 - h * h)
            grad = {"E": xb.T @ dx, "e": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ da, "c": d.T @ e, "b": np.array([e.sum()])}
            step += 1
            for q in p:
                gq = grad[q] + DECAY * p[q]
                m[q] = 0.9 * m[q] + 0.1 * gq
                v[q] = 0.999 * v[q] + 0.001 * gq * gq
                p[q] -= (RATE * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, rows, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: dict | None = None) -> AttentionModel:
    """Fit on at most per_class rows of each label, from the ids that rows(id) selects."""
    per_class = per_class or {1: GOOD_ROWS, 0: POOR_ROWS}
    sample = labelled_sample(docs, labels, rows, F.col(label_col).cast("int"), per_class, id_col, text_col)
    return fit([t for t, _ in sample], np.array([y for _, y in sample], np.float64))


def score(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per row of docs: id, score, predicted, from every passage of the whole text.

    Null and empty texts are one empty passage. Nothing is shuffled. An empty table gives no rows. Other columns of docs
    are not read.
    Rows that repeat an id are scored by their own texts; columns of docs named like a result don't clash, unless id_col has
    that name, which is an error.
    """

    def rows_of(batch):
        s = model.scores(batch)
        return {"score": pa.array(s, pa.float64()), "predicted": pa.array((s >= threshold).astype(np.int32), pa.int32())}

    return over_text(docs, [id_col], text_col, "score double, predicted int", rows_of, rows=128)
