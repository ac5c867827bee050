"""Mixing to target weights: soft domain membership, and document rates by projected-gradient least squares."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import ROW_KEY, over_text, slices, small_batches, stage, stage_only, texts, unstage, with_row_key
from broadsheet.llm.features import HASH_BITS, SAMPLE_BYTES, HashedTerms, labelled_keys, passages, sample_rows, telling_terms

#: Bounds of the classifier: labelled rows for each domain, terms, and the least G of a term.
ROWS_PER_DOMAIN, TERMS, LEAST_G = 2500, 1024, 30.0
EPOCHS, RATE, DECAY = 250, 0.05, 1e-4
#: The fit ends when the weighed squared miss, as a share of the budget, is within TOLERANCE of the least that any rates reach.
TOLERANCE = 1e-6
#: Damping of the steps that are tried at once, from Newton's on the free rows to the gradient by supply, which always lowers the miss.
DAMPING = (1e-9, 1e-6, 1e-5, 1e-4, 3e-4, 1e-3, 3e-3, 1e-2, 3e-2, 0.1, 0.3, 1.0)
_WIDE = 1 << 40
#: How often a row is repeated; no table has a column of this name.
COPIES = "__broadsheet_copies"
logger = logging.getLogger(__name__)


@dataclass
class DomainModel:
    """Softmax regression over hashed terms and the shares of character-class pairs of the whole text."""

    domains: list[str]
    slots: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bags: HashedTerms = field(repr=False, default=None)

    def inputs(self, batch: list[str]) -> np.ndarray:
        sets = self.bags.sets(pa.array(batch, pa.string()))
        shares = np.concatenate([passages(batch[i : i + 128], _WIDE)[0] for i in range(0, max(1, len(batch)), 128)])
        shares = np.sqrt(shares / np.maximum(shares.sum(axis=1, keepdims=True), 1))
        out = np.zeros((len(batch), len(self.slots) + shares.shape[1] + 1), np.float32)
        for i, s in enumerate(sets):
            out[i, s] = 1
        out[:, len(self.slots) : -1] = (shares - self.mean) / self.scale
        out[:, -1] = 1
        return out

    def posteriors(self, batch: list[str]) -> np.ndarray:
        z = self.inputs(batch) @ self.weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return (z / z.sum(axis=1, keepdims=True)).astype(np.float64)


def fit_domains(docs: DataFrame, labels: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text", rows_per_domain: int = ROWS_PER_DOMAIN, seed: int = 11) -> DomainModel:
    """Fit on at most rows_per_domain labelled documents of each domain; each weighs its domain's share of all labels.

    Domains are the values of `domain` in labels, sorted. Without labelled documents there is one domain, '', which all
    belong to. The sample's texts stay with the executors, which encode them; the driver holds the inputs, four bytes a
    number, of rows_per_domain rows a domain.
    """
    shares = {r.d: r["count"] for r in labels.select(domain.alias("d")).filter("d is not null").groupBy("d").count().collect()}
    width = passages([""], _WIDE)[0].shape[1]
    nothing = np.empty(0, np.int64)
    keys = labelled_keys(docs, labels, lambda c: F.lit(True), domain, id_col, text_col)
    rows = sample_rows(keys, docs, dict.fromkeys(sorted(shares), rows_per_domain), SAMPLE_BYTES, id_col, text_col)
    rows = stage(rows, "domain-sample") if rows is not None else None
    counted = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()} if rows is not None else {}
    names = sorted(counted)
    if len(names) < 2:
        return DomainModel(names or [""], nothing, np.zeros(width), np.ones(width), np.zeros((width + 1, 1), np.float32), HashedTerms(nothing))
    slots = _slots(rows, names, [counted[n] for n in names])
    model = DomainModel(names, slots, np.zeros(width), np.ones(width), np.zeros((len(slots) + width + 1, len(names)), np.float32), HashedTerms(slots))
    x, y = _encoded(rows, model)
    unstage(rows)
    part = x[:, len(slots) : -1]
    model.mean, model.scale = part.mean(axis=0), part.std(axis=0) + 0.02
    x[:, len(slots) : -1] = (part - model.mean) / model.scale
    total = sum(shares[n] for n in names)
    weigh = np.array([shares[n] / total / max(1, (y == k).sum()) for k, n in enumerate(names)])[y][:, None]
    hot = np.eye(len(names))[y]
    w = model.weights
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, EPOCHS + 1):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ ((z / z.sum(axis=1, keepdims=True) - hot) * weigh).astype(np.float32) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


def _slots(rows: DataFrame, names: list[str], sizes: list[int]) -> np.ndarray:
    """Terms that tell a domain from the others. Texts are counted where they are; one count a domain and slot is sent."""

    def run(batches):
        plain, counts = HashedTerms(None), np.zeros((len(names), 1 << HASH_BITS), np.int32)
        for b in slices(batches, 128, 1 << 20):
            for s, y in zip(plain.sets(b.column(1)), b.column(0).to_pylist(), strict=True):
                counts[names.index(y), s] += 1
        k, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(slot, pa.int64()), pa.array(counts[k, slot], pa.int64())], names=["k", "slot", "n"])

    small_batches(rows.sparkSession)
    sums = rows.select("_y", "_t").mapInArrow(run, "k bigint, slot bigint, n bigint").groupBy("k", "slot").agg(F.sum("n").cast("int").alias("n")).toArrow()
    counts = np.zeros((len(names), 1 << HASH_BITS), np.int32)
    counts[sums.column("k").to_numpy(), sums.column("slot").to_numpy()] = sums.column("n").to_numpy()
    total, n = counts.sum(axis=0, dtype=np.int32), sum(sizes)
    found = [telling_terms(counts[k], total - counts[k], float(m), float(n - m), TERMS // len(names), LEAST_G) for k, m in enumerate(sizes)]
    return np.unique(np.concatenate(found))


def _encoded(rows: DataFrame, model: DomainModel) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, domain numbers) of the sample in the order of ids. The executors encode; places of terms and shares of pairs
    are sent, no text."""
    kind, terms = rows.schema["_id"].dataType.simpleString(), len(model.slots)

    def run(batches):
        for b in slices(batches, 128, 1 << 20):
            x = model.inputs(texts(b.column(2)))
            held = [np.flatnonzero(r[:terms]).astype("<u2").tobytes() for r in x]
            shares = [np.ascontiguousarray(r[terms:-1], "<f4").tobytes() for r in x]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(held, pa.binary()), pa.array(shares, pa.binary())], names=["_y", "_id", "held", "shares"])

    sent = rows.select("_y", "_id", "_t").mapInArrow(run, f"_y string, _id {kind}, held binary, shares binary").orderBy("_id").toArrow()
    x = np.zeros((sent.num_rows, len(model.weights)), np.float32)
    x[:, -1] = 1
    y = np.empty(sent.num_rows, np.int64)
    for i, (d, held, shares) in enumerate(zip(*(sent.column(c) for c in ("_y", "held", "shares")), strict=True)):
        y[i] = model.domains.index(d.as_py())
        x[i, np.frombuffer(held.as_py(), "<u2")] = 1
        x[i, terms:-1] = np.frombuffer(shares.as_py(), "<f4")
    return x, y


@dataclass
class Mixture:
    """Rates of documents: from 1, each step takes the posteriors' product with a scaled gradient away, within 0 and `most`."""

    model: DomainModel
    steps: list[np.ndarray]
    most: float
    totals: dict[str, float]
    targets: dict[str, float]
    away: float = 0.0

    def report(self) -> str:
        """Totals of tokens against targets by domain, and how far the miss may be from the least, as a share of the budget."""
        parts = [f"{n} {self.totals[n]:.0f} of {self.targets[n]:.0f}" for n in self.totals]
        return f"mixture: {', '.join(parts)} tokens; {len(self.steps)} steps, within {self.away:.1e} of the least miss"

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        return fold_steps(posteriors, self.steps, self.most)


def fold_steps(posteriors: np.ndarray, steps: list[np.ndarray], most: float, start: np.ndarray | None = None) -> np.ndarray:
    r = np.ones(len(posteriors)) if start is None else start
    for g in steps:
        r = np.clip(r - posteriors @ g, 0.0, most)
    return r


def memberships(docs: DataFrame, model: DomainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, tokens (white-space words), posteriors (in the order of model.domains)."""

    def rows_of(batch):
        p = model.posteriors(batch)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
        return {"tokens": pa.array([len(t.split()) for t in batch], pa.int64()), "posteriors": lists}

    return over_text(docs, [id_col], text_col, "tokens bigint, posteriors array<double>", rows_of, rows=2000)


def fit_rates(members: DataFrame, model: DomainModel, weights: dict[str, float], budget: float | None = None, thin: bool = False, keep: str | None = None) -> Mixture:
    """Nonnegative document rates whose expected domain token totals match budget * weights, by least squares.

    A step takes two sums over all documents. The first gives the product sums of posteriors over the free rows, a matrix of
    domains by domains, and how far the miss may be from the least (the gradient times the way to the bound that it points
    to, a bound from convexity). Rows at a bound that want to go beyond it are not free. The second gives the totals after
    each of the steps of DAMPING, and the best is taken. The fit ends when that distance is within TOLERANCE of the budget,
    or no step lowers the miss any more, in floating point. With thin, rates are at most 1, so
    nothing repeats. The budget is, unless given, the one at which the domain `keep` (by default the one of the largest
    weight) has all its supply as its target, so that its documents stay; scarcer domains fall short of their targets with
    thin, and are then fitted to their supply, or else repeat. Domains without a weight have weight 0.
    """
    names, d = model.domains, len(model.domains)
    want = np.array([weights.get(n, 0.0) for n in names])
    want = want / want.sum() if want.sum() > 0 else np.full(d, 1.0 / d)
    most = 1.0 if thin else np.inf

    def sums(width, of):
        """The sum of of(tokens, posteriors), a vector of `width`, over slices of all documents."""

        def run(batches):
            out = np.zeros(width)
            for b in slices(batches, 1 << 15):
                out += of(np.asarray(b.column(0), dtype=float), np.asarray(b.column(1).flatten()).reshape(-1, d))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(out)], names=["k", "s"])

        rows = members.select("tokens", "posteriors").mapInArrow(run, "k bigint, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(width)
        for r in rows:
            out[r.k] = r.s
        return out

    def state(steps, slope):
        def of(t, p):
            r, z = fold_steps(p, steps, most), p @ slope
            free = ((r > 0) | (z < 0)) & ((r < most) | (z > 0))
            way = np.where(z > 0, r, r - most if thin else -1.0)
            return np.append((t * z * way).sum(), (p * (t * free)[:, None]).T @ p)

        out = sums(1 + d * d, of)
        return out[0], out[1:].reshape(d, d)

    def after(steps, tried):
        def of(t, p):
            r = fold_steps(p, steps, most)
            return np.concatenate([(t * fold_steps(p, [g], most, r)) @ p for g in tried])

        return sums(len(tried) * d, of).reshape(-1, d)

    steps: list[np.ndarray] = []
    now = sums(d, lambda t, p: t @ p)
    safe = np.maximum(now, 1e-9)
    if budget is None:
        kept = names.index(keep) if keep is not None else int(np.lexsort((now, want))[-1])
        budget = float(now[kept] / want[kept]) if want[kept] > 0 else 0.0
    target = budget * want
    goal = np.minimum(target, now) if thin else target
    best, away = ((now - goal) ** 2 / safe).sum(), 0.0
    while budget > 0:
        slope = (now - goal) / safe
        away, gram = state(steps, slope)
        if away <= TOLERANCE * budget:
            break
        tried = [np.linalg.solve(gram / safe[:, None] + m * np.eye(d), slope) for m in DAMPING]
        totals = after(steps, tried)
        misses = ((totals - goal) ** 2 / safe).sum(axis=1)
        at = int(misses.argmin())
        if not misses[at] < best:
            break
        steps.append(tried[at])
        now, best = totals[at], misses[at]
    mixture = Mixture(model, steps, most, dict(zip(names, now.tolist(), strict=True)), dict(zip(names, target.tolist(), strict=True)), away / budget if budget > 0 else 0.0)
    logger.warning("%s", mixture.report())
    return mixture


def _draw(id_col: Column) -> Column:
    """A number in [0, 1) from the id."""
    return F.pmod(F.xxhash64(F.lit("mix"), id_col.cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def mix(docs: DataFrame, model: DomainModel, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", budget: float | None = None, thin: bool = False, draw_by: Column | None = None) -> tuple[DataFrame, Mixture]:
    """(rows, mixture): one row per row of docs: id, tokens, posteriors, domain, rate, copies.

    copies is the rate rounded down or up by a number drawn from the id (or draw_by, of it), so its expectation is the rate.
    Without thin, rates over 1 repeat documents of scarce domains, and totals meet their targets. Null and empty texts have
    no tokens and a rate like any other; rows that repeat an id are rated by their own texts. An empty table gives no rows.
    Other columns of docs are not read.
    """
    members = stage(memberships(docs, model, id_col, text_col), "memberships")
    mixture = fit_rates(members, model, weights, budget, thin)
    names = F.array(*[F.lit(n) for n in model.domains])

    def run(batches):
        for b in slices(batches, 1 << 15):
            p = np.asarray(b.column(2).flatten()).reshape(-1, len(model.domains))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(mixture.rates(p))], names=[*b.schema.names, "rate"])

    kind = members.schema[id_col].dataType.simpleString()
    rated = members.mapInArrow(run, f"`{id_col}` {kind}, tokens bigint, posteriors array<double>, rate double")
    best = F.element_at(names, F.array_position("posteriors", F.array_max("posteriors")).cast("int"))
    draw = _draw(F.col(id_col) if draw_by is None else draw_by)
    copies = F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")
    return rated.select(id_col, "tokens", "posteriors", best.alias("domain"), "rate", copies.cast("int").alias("copies")), mixture


def mixed_rows(docs: DataFrame, model: DomainModel, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", thin: bool = False) -> DataFrame:
    """The rows of docs as often as the mixture's rates ask for, with all their columns; with thin, each at most once.

    Texts are classified once; the decisions are joined by a key of rows, so each row is drawn by its own rate.
    """
    keyed = with_row_key(docs)
    at = F.struct(keyed[id_col].alias("id"), keyed[ROW_KEY].alias("key"))
    plain = keyed.select(at.alias("at"), keyed[text_col].cast("string").alias("text"))

    def drawn():
        rows, _ = mix(plain, model, weights, "at", "text", thin=thin, draw_by=F.col("at.id"))
        return rows.filter("copies > 0").select(F.col("at.key").alias(ROW_KEY), "copies")

    kept = stage_only(drawn, "mixture")
    again = F.explode(F.array_repeat(F.lit(1), F.col(COPIES))).alias(COPIES)
    names = [F.col(f"`{c}`") for c in docs.columns]
    return keyed.join(kept.withColumnRenamed("copies", COPIES).hint("shuffle_hash"), ROW_KEY).select(*names, again).drop(COPIES)
