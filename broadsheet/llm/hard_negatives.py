"""Hard negatives of anchors by exact inner products, searched through a table of distances to pivots."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import slices, small_batches, stage, stage_only

#: Pivots, and rows that they come from.
PIVOTS, SAMPLE = 24, 2048
#: Rows of a block of the pivot table, blocks that a task holds while anchors stream past, and anchors that come together.
BLOCK, SHARD, GROUP = 1024, 32, 128
#: Positives of an anchor, negatives of each, and the least and most that a negative's score is of the positive's, in per cent.
POSITIVES, NEGATIVES, LEAST, MOST = 5, 10, 30, 90
#: A row whose squared norm reaches this takes no part: scores would not fit a long.
_HUGE = 2.0**62
_NONE = np.iinfo(np.int64).min

_BLOCKS = "dim int, label bigint, kind int, number bigint, n int, uids binary, ids binary, q binary, far binary, extra binary"


def quantized(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: float) -> DataFrame:
    """(id, label, anchor, dim, norm2, q): components as floor(scale * x), little-endian integers of 16 bits, or of 64 where
    these don't do.

    Rows with a null id, label or vector, with a null or non-finite component, or whose squared norm would not fit, go.
    """
    small_batches(vectors.sparkSession)
    v = vectors[vector_col].cast("array<double>")
    good = v.isNotNull() & vectors[id_col].isNotNull() & vectors[label_col].isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    narrow = vectors.filter(good).select(vectors[id_col].cast("bigint").alias("id"), vectors[label_col].cast("bigint").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("v"))

    def run(batches):
        for b in slices(batches):
            raw, dims, norms, keep = [], [], [], []
            for i, x in enumerate(b.column(3).to_pylist()):
                with np.errstate(over="ignore"):
                    q = np.floor(scale * np.array(x, np.float64))
                    norm = float((q * q).sum())
                if norm < _HUGE:
                    keep.append(i)
                    raw.append(q.astype("<i2" if norm < 2.0**30 else "<i8").tobytes())
                    dims.append(len(q))
                    norms.append(norm)
            took = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*took.columns[:3], pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(raw, pa.binary())], names=["id", "label", "anchor", "dim", "norm2", "q"])

    return narrow.mapInArrow(run, "id bigint, label bigint, anchor boolean, dim int, norm2 double, q binary")


def _values(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<i2" if len(raw) == 2 * dim else "<i8")


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Pivots of each dimension that occurs in the `sample` rows of lowest hash, each as far as can be from those before it."""
    by: dict[int, list[np.ndarray]] = {}
    for r in rows.select("dim", "q").distinct().orderBy(F.xxhash64("q"), "q", "dim").limit(sample).collect():
        by.setdefault(r.dim, []).append(_values(bytes(r.q), r.dim).astype(np.float64))
    out = {}
    for dim, found in by.items():
        x = np.array(found).reshape(len(found), dim)
        taken, away = [int((x * x).sum(axis=1).argmax())], np.full(len(x), np.inf)
        while len(taken) < min(pivots, len(x)):
            away = np.minimum(away, ((x - x[taken[-1]]) ** 2).sum(axis=1))
            if away.max() <= 0:
                break
            taken.append(int(away.argmax()))
        out[dim] = x[taken]
    return out


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """x with one more component, so that all rows have the squared norm `most`. From an anchor with a zero for that component,
    the squared distance is its squared norm plus `most` less twice the inner product."""
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0.0))[:, None]])


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2 * (x @ p.T), 0.0))


def pivot_table(rows: DataFrame, pivots: dict[int, np.ndarray], most: dict[int, float]) -> DataFrame:
    """(dim, label, uid, id, anchor, q, far): the stored table of distances `far` to the lifted pivots, in single precision.

    Rows of a label that lie near the same pivot stand together; uid tells rows apart.
    """

    def near(batches):
        for b in batches:
            cells, raw = [], []
            for dim, q in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                p = pivots.get(dim)
                d = np.empty(0) if p is None else _distances(lifted(_values(q, dim).astype(np.float64)[None, :], most[dim]), lifted(p, most[dim]))[0]
                cells.append(int(d.argmin()) if len(d) else 0)
                raw.append(d.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.int32()), pa.array(raw, pa.binary())], names=["id", "label", "anchor", "dim", "q", "cell", "far"])

    told = rows.select("id", "label", "anchor", "dim", "q").mapInArrow(near, "id bigint, label bigint, anchor boolean, dim int, q binary, cell int, far binary")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", "label", "cell", "id", "far"]
    dealt = told.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stage(dealt.select("dim", "label", F.monotonically_increasing_id().alias("uid"), "id", "anchor", "q", "far"), "pivot-table")


def packed(rows: DataFrame, size: int, kind: int) -> DataFrame:
    """Blocks of up to `size` rows of one dimension and label that follow one another: rows (dim, label, uid, id, q, far, extra)."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        count, key = 0, None

        def out():
            t = pa.Table.from_batches(held).combine_chunks()
            uids, ids = t.column("uid").to_numpy(), t.column("id").to_numpy()
            q = t.column("q").to_pylist()
            if len({len(x) for x in q}) > 1:
                q = [_values(x, key[0]).astype("<i8").tobytes() for x in q]
            joined = [b"".join(x) for x in (q, t.column("far").to_pylist(), t.column("extra").to_pylist())]
            row = [key[0], key[1], kind, int(uids[0]), count, uids.astype("<i8").tobytes(), ids.astype("<i8").tobytes(), *joined]
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in _BLOCKS.split(", ")])

        for b in batches:
            dims, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            while at < b.num_rows:
                if held and (key != (dims[at], labels[at]) or count == size):
                    yield out()
                    held, count = [], 0
                key, end = (dims[at], labels[at]), at
                while end < b.num_rows and end - at < size - count and (dims[end], labels[end]) == key:
                    end += 1
                held.append(b.slice(at, end - at))
                count += end - at
                at = end
        if held:
            yield out()

    return rows.select("dim", "label", "uid", "id", "q", "far", "extra").mapInArrow(run, _BLOCKS)


class _Block:
    """A block of the pivot table, or a group of anchors, in arrays."""

    def __init__(self, b: pa.RecordBatch, i: int):
        get = lambda name: b.column(name)[i].as_py()
        self.dim, self.label, self.n = get("dim"), get("label"), get("n")
        self.uids, self.ids = np.frombuffer(get("uids"), "<i8"), np.frombuffer(get("ids"), "<i8")
        self.q = _values(get("q"), self.n * self.dim).reshape(self.n, self.dim)
        self.far = np.frombuffer(get("far"), "<f4").astype(np.float64).reshape(self.n, -1) if get("far") else np.empty((self.n, 0))
        self.extra = get("extra")
        self.near, self.away = (self.far.min(axis=0), self.far.max(axis=0)) if self.far.size else (None, None)

    def asks(self, pivots: dict[int, np.ndarray], most: float) -> _Block:
        """As a group of anchors: distances to the lifted pivots from its vectors with a zero added."""
        x, p = self.floats(), pivots.get(self.dim)
        self.norm2 = (x * x).sum(axis=1)
        self.far = np.empty((self.n, 0)) if p is None else _distances(np.hstack([x, np.zeros((self.n, 1))]), lifted(p, most))
        return self

    def floats(self) -> np.ndarray:
        if not hasattr(self, "_floats"):
            self._floats = self.q.astype(np.float64)
        return self._floats


def brackets(far: np.ndarray, norm2: np.ndarray, near: np.ndarray, away: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) that the inner products of anchors can be with what lies between `near` and `away` from the pivots.

    far: anchors by pivots, norm2: squared norms of anchors, near and away: pivots by what is asked for. The triangle inequality
    bounds the distance, and with it the product. A margin covers rounding to single precision.
    """
    low = np.zeros((far.shape[0], near.shape[1]))
    high = np.full(low.shape, np.inf)
    for p in range(far.shape[1]):
        a = far[:, p : p + 1]
        np.maximum(low, np.maximum(a - away[p], near[p] - a), out=low)
        np.minimum(high, a + away[p], out=high)
    margin, base = 2e-6 * (most + 1.0), (norm2[:, None] + most) / 2
    return base - high * high / 2 - margin, base - low * low / 2 + margin


def _scores(anchors: _Block, block: _Block, rows: np.ndarray, cols: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products: doubles are exact below 2^53, and integers beyond; every partial sum is within `most`."""
    if most < 2.0**53:
        return (anchors.floats()[rows] @ block.floats()[cols].T).astype(np.int64)
    return anchors.q[rows].astype(np.int64) @ block.q[cols].astype(np.int64).T


def _best(scores: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id; _NONE is no score."""
    have = np.flatnonzero(scores != _NONE)
    if len(have) > 4 * k:
        cut = np.partition(scores[have], len(have) - k)[len(have) - k]
        have = have[scores[have] >= cut]
    return have[np.lexsort((uids[have], ids[have], -scores[have]))[:k]]


def _search(blocks: DataFrame, groups: DataFrame, rows_of: Callable, schema: str, shard: int) -> DataFrame:
    """rows_of(group, blocks) for every group of anchors with every shard of blocks of its dimension.

    A shard is about `shard` blocks, by their hashed numbers, or fewer where that keeps all tasks busy. A task holds one
    shard while the groups stream past it, so its memory does not grow with the anchors, which are copied once a shard.
    """
    n = max(12, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    many = blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("_m"))
    many = many.select("dim", F.greatest(F.ceil(F.col("_m") / shard), F.least("_m", F.lit(n))).alias("_m"))
    placed = blocks.join(many, "dim").withColumn("shard", F.pmod(F.xxhash64("number"), F.col("_m")))
    sent = groups.join(many, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1)))
    both = placed.unionByName(sent).drop("_m").repartition(n, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "number")

    def run(batches):
        at, held = None, []
        for b in batches:
            dims, shards, kinds = (b.column(c).to_pylist() for c in ("dim", "shard", "kind"))
            for i in range(b.num_rows):
                if at != (dims[i], shards[i]):
                    at, held = (dims[i], shards[i]), []
                if kinds[i] == 0:
                    held.append(_Block(b, i))
                    continue
                rows = rows_of(_Block(b, i), held)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    return both.mapInArrow(run, schema)


def _survivors(anchors: _Block, block: _Block, who: np.ndarray, floor: np.ndarray, ceiling: np.ndarray, most: float) -> np.ndarray:
    """Rows of a block that the bracket of some anchor of `who` leaves between its floor and ceiling."""
    if not block.far.shape[1]:
        return np.arange(block.n)
    low, high = brackets(anchors.far[who], anchors.norm2[who], block.far.T, block.far.T, most)
    return np.flatnonzero(((high >= floor[:, None]) & (low <= ceiling[:, None])).any(axis=0))


def _outer(anchors: _Block, blocks: list[_Block], most: float) -> tuple[np.ndarray, np.ndarray]:
    """brackets() of anchors with whole blocks."""
    if not anchors.far.shape[1]:
        return np.full((anchors.n, len(blocks)), -np.inf), np.full((anchors.n, len(blocks)), np.inf)
    return brackets(anchors.far, anchors.norm2, np.array([b.near for b in blocks]).T, np.array([b.away for b in blocks]).T, most)


def _positives(pivots: dict[int, np.ndarray], most: dict[int, float], k: int) -> Callable:
    """The k best rows of an anchor's label but itself; blocks that may hold the best come first and raise what others must reach."""

    def rows_of(a: _Block, held: list[_Block]) -> list[tuple]:
        blocks, limit = [b for b in held if b.label == a.label], most[a.dim]
        if not blocks:
            return []
        a.asks(pivots, limit)
        _, high = _outer(a, blocks, limit)
        floor = np.full(a.n, -np.inf)
        none = np.empty(0, np.int64)
        best = [(none, none, none)] * a.n
        for j in np.argsort(-high.max(axis=0)):
            who = np.flatnonzero(high[:, j] >= floor)
            if not len(who):
                continue
            b = blocks[j]
            cols = _survivors(a, b, who, floor[who], np.full(len(who), np.inf), limit)
            if not len(cols):
                continue
            scores = _scores(a, b, who, cols, limit)
            for i, s in zip(who, scores, strict=True):
                s = np.where(b.uids[cols] == a.uids[i], _NONE, s)
                found = _best(s, b.ids[cols], b.uids[cols], k)
                all_s, ids, uids = (np.concatenate(x) for x in zip(best[i], (s[found], b.ids[cols][found], b.uids[cols][found]), strict=True))
                found = _best(all_s, ids, uids, k)
                best[i] = all_s[found], ids[found], uids[found]
                if len(found) == k:
                    floor[i] = all_s[found[-1]]
        return [(int(a.uids[i]), int(a.ids[i]), int(x), int(u), int(s)) for i in range(a.n) for s, x, u in zip(*best[i], strict=True)]

    return rows_of


def _negatives(pivots: dict[int, np.ndarray], most: dict[int, float], k: int, positives: int) -> Callable:
    """For each anchor and positive the k best rows of other labels between the bounds that come with the anchor."""

    def rows_of(a: _Block, held: list[_Block]) -> list[tuple]:
        blocks, limit = [b for b in held if b.label != a.label], most[a.dim]
        if not blocks:
            return []
        a.asks(pivots, limit)
        bounds = np.frombuffer(a.extra, "<i8").reshape(a.n, positives, 2)
        low, high = _outer(a, blocks, limit)
        have = bounds[:, :, 0] <= bounds[:, :, 1]
        least = np.where(have, bounds[:, :, 0].astype(np.float64), np.inf)
        ceiling = np.where(have, bounds[:, :, 1].astype(np.float64), -np.inf).max(axis=1)
        none = np.empty(0, np.int64)
        best = [[(none, none, none)] * positives for _ in range(a.n)]
        for j in np.argsort(-high.max(axis=0)):
            floor = least.min(axis=1)
            who = np.flatnonzero((high[:, j] >= floor) & (low[:, j] <= ceiling))
            if not len(who):
                continue
            b = blocks[j]
            cols = _survivors(a, b, who, floor[who], ceiling[who], limit)
            if not len(cols):
                continue
            scores = _scores(a, b, who, cols, limit)
            for i, s in zip(who, scores, strict=True):
                for p in np.flatnonzero(have[i]):
                    inside = np.where((s >= bounds[i, p, 0]) & (s <= bounds[i, p, 1]), s, _NONE)
                    found = _best(inside, b.ids[cols], b.uids[cols], k)
                    if not len(found):
                        continue
                    all_s, ids, uids = (np.concatenate(x) for x in zip(best[i][p], (s[found], b.ids[cols][found], b.uids[cols][found]), strict=True))
                    found = _best(all_s, ids, uids, k)
                    best[i][p] = all_s[found], ids[found], uids[found]
                    if len(found) == k:
                        least[i, p] = max(least[i, p], float(all_s[found[-1]]))
        return [(int(a.uids[i]), p + 1, int(x), int(u), int(s)) for i in range(a.n) for p in range(positives) for s, x, u in zip(*best[i][p], strict=True)]

    return rows_of


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = 256.0, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, pivots: int = PIVOTS, block: int = BLOCK, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score, all exact.

    Components become floor(scale * x), and a score is the integer inner product with the anchor, higher first, ties by
    smaller id. An anchor's positives are its first `positives` other rows of its label; for each, its negatives are the
    first `negatives` rows of other labels whose score is between `least` and `most` per cent of the positive's, so a
    positive of a negative score has none. Rows with a null id, label or vector or a null or non-finite component take no
    part, nor do those whose squared norm is 2^62 or more; only vectors of one length meet. Rows that repeat an id are rows
    of their own. `anchor` says which rows are anchors, null is no. Empty tables give no rows; other columns aren't read.

    Vectors are lifted to one norm, so that scores are distances turned round, and the distances of all rows to the pivots
    are stored. Anchors meet all rows in blocks: the triangle inequality brackets the scores of a block, then of its rows,
    and what is left is computed exactly.
    """

    def found():
        usable = stage(quantized(vectors, id_col, vector_col, label_col, anchor, scale), "quantized")
        limits = {r.dim: r.m for r in usable.groupBy("dim").agg(F.max("norm2").alias("m")).collect()}
        chosen = choose_pivots(usable, pivots)
        table = pivot_table(usable, chosen, limits)
        blocks = packed(table.withColumn("extra", F.lit(b"")), block, 0)
        anchors = table.filter("anchor")
        near = _search(blocks, packed(anchors.withColumn("extra", F.lit(b"")), group, 1), _positives(chosen, limits, positives), "a bigint, anchor_id bigint, id bigint, uid bigint, score bigint", shard)
        first = Window.partitionBy("a").orderBy(F.col("score").desc(), "id", "uid")
        best = near.withColumn("p", F.row_number().over(first)).filter(F.col("p") <= positives)
        best = stage(best.select("a", "p", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        bounds = best.groupBy("a").agg(F.collect_list(F.struct("p", "positive_score")).alias("_p"))

        def bounded(batches):
            for b in batches:
                raw = []
                for listed in b.column(6).to_pylist():
                    out = np.tile(np.array([1, 0], "<i8"), (positives, 1))
                    for x in listed:
                        s = x["positive_score"]
                        out[x["p"] - 1] = max(-(-least * s // 100), -(2**63)), min(most * s // 100, 2**63 - 1)
                    raw.append(out.tobytes())
                yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(raw, pa.binary())], names=[*b.schema.names[:6], "extra"])

        asked = anchors.join(bounds.withColumnRenamed("a", "uid"), "uid").select("dim", "label", "uid", "id", "q", "far", "_p")
        asked = asked.mapInArrow(bounded, "dim int, label bigint, uid bigint, id bigint, q binary, far binary, extra binary").sortWithinPartitions("dim", "label", "uid")
        far = _search(blocks, packed(asked, group, 1), _negatives(chosen, limits, negatives, positives), "a bigint, p bigint, id bigint, uid bigint, score bigint", shard)
        order = Window.partitionBy("a", "p").orderBy(F.col("score").desc(), "id", "uid")
        hard = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
        return hard.join(best, ["a", "p"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

    return stage_only(found, "hard-negatives")
