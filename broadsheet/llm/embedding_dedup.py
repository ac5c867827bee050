"""Embedding near-dedup by a pivot-permutation index."""

from __future__ import annotations

import itertools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import fold, salted, slices, small_batches, stage, stage_only, unfold
from broadsheet.llm.graph import components, forest, in_buckets

#: Reference points, length of the prefix whose pivots have lists, pivots that two prefixes must share, and rows that pivots
#: come from. Measured on 64 dimensions: 0.974 of pairs at cosine 0.905 share two of six, and 0.7 % of all pairs do. The
#: share falls with the square of the pivots, so take more of them, and a larger sample, for more than some millions of vectors.
PIVOTS, PREFIX, SHARED, SAMPLE = 256, 6, 2, 4096
#: Nearest pivots that are compared in order, and the least agreement of candidates as a share of the most: the counts of
#: shared pivots of the first 1, 2, ... pivots, summed. At cosine 0.905 none of 3,000 pairs that share two of six falls
#: below, in 64 and in 768 dimensions; 0 to 0.1 % of other pairs reach it.
LENGTH, AGREEMENT = 16, 0.3
#: Where the sample has fewer pivots that far apart, they may come closer.
FEWEST = 16
#: No two pivots are closer than this, so that a dense group doesn't take them all.
APART = 0.6
COSINE = 0.9
#: Vectors that one task compares with one another at once.
BLOCK = 512


def values(raw: bytes, dim: int) -> np.ndarray:
    """The doubles of a stored vector, which is in single precision where that loses nothing."""
    return np.frombuffer(raw, "<f4" if len(raw) == 4 * dim else "<f8").astype(np.float64)


def unit(raw: bytes, dim: int) -> np.ndarray:
    x = values(raw, dim)
    return x / np.sqrt((x * x).sum())


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, vec, dim, _ok): components as little-endian floats; _ok is false for what links with nothing."""
    small_batches(vectors.sparkSession)
    narrow = vectors.select(vectors[id_col].alias("_id"), vectors[vector_col].cast("array<double>").alias("_v"))

    def run(batches):
        for b in slices(batches):
            out, dims = [], []
            for x in b.column(1).to_pylist():
                good = x is not None and len(x) > 0 and None not in x
                a = np.array(x, "<f8") if good else np.empty(0)
                good = bool(good and np.isfinite(a).all() and a.any())
                if good:
                    a = np.ldexp(a, -int(np.frexp(np.abs(a).max())[1]))  # squares neither overflow nor vanish
                    single = a.astype("<f4")
                    a = single if (single == a).all() else a.astype("<f8")
                out.append(a.tobytes() if good else b"")
                dims.append(len(a) if good else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32()), pa.array([d > 0 for d in dims], pa.bool_())], names=["_id", "vec", "dim", "_ok"])

    return narrow.mapInArrow(run, f"_id {vectors.schema[id_col].dataType.simpleString()}, vec binary, dim int, _ok boolean")


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, apart: float = APART) -> dict[int, np.ndarray]:
    """Unit pivots for each dimension that occurs in a bounded sample: the distinct vectors of lowest hash, taken greedily
    if no pivot taken is within `apart`; if there are fewer than FEWEST, the bound is raised."""
    if pivots > 1 << 16:
        raise ValueError("pivots are numbered in 16 bits")
    rows = vectors.orderBy(F.xxhash64("vec"), "vec", "dim").limit(sample).collect()
    by: dict[int, list[np.ndarray]] = {}
    for r in rows:
        by.setdefault(r.dim, []).append(unit(bytes(r.vec), r.dim))
    out = {}
    for dim, found in by.items():
        bound, taken = apart, []
        while len(taken) < min(FEWEST, pivots, len(found)) and bound < 1.2:
            for x in found:
                if len(taken) == pivots:
                    break
                if not taken or (np.array(taken) @ x).max() < bound:
                    taken.append(x)
            bound += 0.1
        out[dim] = np.array(taken)
    return out


def describe(vectors: DataFrame, pivots: dict[int, np.ndarray], length: int = LENGTH) -> DataFrame:
    """(node, dim, desc): the nearest pivots in order, as bytes of little-endian 16-bit numbers; ties go to the first pivot."""

    def run(batches):
        for b in slices(batches):
            out = []
            for v, dim in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True):
                p = pivots.get(dim)
                near = np.empty(0, np.int64) if p is None else np.argsort(-(p @ unit(v, dim)), kind="stable")[:length]
                out.append(near.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["node", "dim", "desc"])

    return vectors.select("node", "dim", "vec").mapInArrow(run, "node bigint, dim int, desc binary")


def _postings(described: DataFrame, shared: int, prefix: int) -> DataFrame:
    """Inverted lists of ids and descriptions: one row for each set of `shared` pivots of a prefix, keyed by dimension and set.

    Two prefixes share at least `shared` pivots just if they meet in some list. A description of fewer pivots than that has
    one list, of all that it has.
    """

    def run(batches):
        for b in slices(batches, 256):
            keys, at = [], []
            for i, d in enumerate(b.column(2).to_pylist()):
                near = sorted(struct.unpack(f"<{len(d) // 2}H", d)[:prefix])
                for c in itertools.combinations(near, min(shared, len(near))):
                    key = 0
                    for p in c:
                        key = key << 16 | p
                    keys.append(key)
                    at.append(i)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(1).take(take), pa.array(keys, pa.int64()), b.column(0).take(take), b.column(2).take(take)], names=["dim", "list", "node", "desc"])

    return described.mapInArrow(run, "dim int, list bigint, node bigint, desc binary")


def _order(t: pa.Table, at: int) -> np.ndarray:
    """Descriptions of the rows, one a row, from the column at `at`."""
    raw = t.column(at).to_pylist()
    return np.frombuffer(b"".join(raw), "<u2").reshape(len(raw), -1).astype(np.int64)


def agreement(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Shared pivots of the first 1, 2, ... pivots, summed, for each pair of descriptions. With l pivots, l(l + 1) less
    twice this is Spearman's footrule, where a pivot that is missing stands behind the last."""
    names = np.unique(np.concatenate([dx.ravel(), dy.ravel()]))
    out = np.zeros((len(dx), len(dy)), np.float32)
    hx, hy = (np.zeros((len(d), len(names)), np.float32) for d in (dx, dy))
    for k in range(dx.shape[1]):
        for h, d in ((hx, dx), (hy, dy)):
            h[np.arange(len(d)), np.searchsorted(names, d[:, k])] = 1
        out += hx @ hy.T
    return out


def candidates(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Which pairs of descriptions agree enough to be verified."""
    n = dx.shape[1]
    return agreement(dx, dy) >= AGREEMENT * n * (n + 1) / 2


def owned(dx: np.ndarray, dy: np.ndarray, key: int, shared: int, prefix: int) -> np.ndarray:
    """Which pairs of a list count there: those whose smallest shared pivots name it, so that each counts in one list."""
    last, px, py = key & 0xFFFF, dx[:, :prefix], dy[:, :prefix]
    names = np.unique(np.concatenate([px.ravel(), py.ravel()]))
    names = names[names <= last]
    hx, hy = (np.zeros((len(d), len(names) + 1), np.float32) for d in (px, py))
    for h, d in ((hx, px), (hy, py)):
        r, c = np.nonzero(d <= last)
        h[r, np.searchsorted(names, d[r, c])] = 1
    return hx @ hy.T <= min(shared, px.shape[1])


def members(described: DataFrame, shared: int, prefix: int, block: int) -> DataFrame:
    """(dim, list, node): which vectors a list has to verify, those with a candidate that counts there."""

    def compare(x, y, key: int):
        (nx, dx), (ny, dy) = x, y
        open_ = candidates(dx, dy) & owned(dx, dy, key, shared, prefix)
        if x is y:
            np.fill_diagonal(open_, False)
        found = np.concatenate([nx[open_.any(axis=1)], ny[open_.any(axis=0)]])
        return np.unique(found) if len(found) else None

    def out(dim: int, key: int, nodes: np.ndarray):
        return np.full(len(nodes), dim, np.int32), np.full(len(nodes), key, np.int64), nodes

    def small(t: pa.Table, starts: np.ndarray):
        found, dims, keys, nodes = [], t.column(0).to_numpy(), t.column(1).to_numpy(), t.column(2).to_numpy()
        for s, e in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
            if e - s > 1:
                x = (nodes[s:e], _order(t.slice(s, e - s), 3))
                got = compare(x, x, int(keys[s]))
                if got is not None:
                    found.append(out(int(dims[s]), int(keys[s]), got))
        return [np.concatenate(c) for c in zip(*found, strict=True)] if found else None

    def pair(left: pa.Table, right: pa.Table, width: int):
        dim, key = left.column(0)[0].as_py(), left.column(1)[0].as_py()
        x, y = ((u.column(width + 3).to_numpy(), _order(u, width + 4)) for u in (left, right))
        got = compare(x, x if left is right else y, key)
        return None if got is None else out(dim, key, got)

    found = in_buckets(_postings(described, shared, prefix), ["dim", "list"], "d int, l bigint, n bigint", small, pair, block)
    return found.distinct().select(F.col("d").alias("dim"), F.col("l").alias("list"), F.col("n").alias("node"))


def links(described: DataFrame, vectors: DataFrame, cosine: float = COSINE, shared: int = SHARED, prefix: int = PREFIX, block: int = BLOCK) -> DataFrame:
    """(a, b, na, nb): forest links between distinct vectors, and links that each end gains, weighted by the other's copies.

    Lists hold ids and descriptions; only vectors with a candidate are fetched, to the lists that verify them. vectors:
    node, vec, weight. Each pair is verified in double precision, in the one list where it counts.
    """

    def load(t: pa.Table, at: int, dim: int):
        v = np.array([values(x, dim) for x in t.column(at + 2).to_pylist()])
        return t.column(at).to_numpy(), v / np.sqrt((v * v).sum(axis=1, keepdims=True)), t.column(at + 3).to_numpy(), _order(t, at + 1)

    def compare(x, y, key: int):
        """x and y as load() gives them; the same object for a block with itself."""
        (nx, vx, wx, dx), (ny, vy, wy, dy) = x, y
        near = vx @ vy.T >= cosine
        if x is y:
            near |= near.T
            np.fill_diagonal(near, False)
        near &= candidates(dx, dy)
        if not near.any():
            return None
        own = near & owned(dx, dy, key, shared, prefix)
        if x is y:
            return nx[forest(near)], nx, np.zeros(len(nx), np.int64), own @ wy
        n, ids = len(nx), np.concatenate([nx, ny])
        whole = np.zeros((len(ids), len(ids)), bool)
        whole[:n, n:], whole[n:, :n] = near, near.T
        return ids[forest(whole)], ids, np.zeros(len(ids), np.int64), np.concatenate([own @ wy, own.T @ wx])

    def small(t: pa.Table, starts: np.ndarray):
        found, dims, keys = [], t.column(0).to_numpy(), t.column(1).to_numpy()
        for s, e in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
            if e - s > 1:
                x = load(t.slice(s, e - s), 2, int(dims[s]))
                got = compare(x, x, int(keys[s]))
                if got is not None:
                    found.append(got)
        return [np.concatenate(c) for c in zip(*found, strict=True)] if found else None

    def pair(left: pa.Table, right: pa.Table, width: int):
        dim, key = left.column(0)[0].as_py(), left.column(1)[0].as_py()
        x = load(left, width + 3, dim)
        return compare(x, x if left is right else load(right, width + 3, dim), key)

    asked = stage(members(described, shared, prefix, block), "list-members")
    rows = asked.join(described.select("node", "desc").join(vectors.select("node", "vec", "weight"), "node"), "node")
    return in_buckets(rows.select("dim", "list", "node", "desc", "vec", "weight"), ["dim", "list"], "a bigint, b bigint, na bigint, nb bigint", small, pair, block)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, pivots: int = PIVOTS, prefix: int = PREFIX, shared: int = SHARED) -> DataFrame:
    """One row per row of vectors: id, n_links, component_id, kept.

    Equal vectors up to scale by a power of two are one node with a weight, so copies are never paired; a node of w copies
    gives each w - 1 links. Null, empty or zero vectors, and those with null or non-finite components, link with nothing:
    no links, their own component, kept. Vectors of other dimensions never link. Of rows that repeat an id all have the
    same component. Null ids are passed over as component ids unless nothing else is there. An empty table gives no rows.
    """
    rows = stage(_usable(vectors, id_col, vector_col).withColumn("_uid", F.monotonically_increasing_id()), "vectors")
    same = ["vec", "dim"]
    good = salted(rows.filter("_ok").select("_id", "_uid", *same), F.col("_uid"))
    nodes = fold(good, same, {"node": F.min("_uid"), "low": F.min("_id"), "weight": F.count(F.lit(1))}, {"node": F.min("node"), "low": F.min("low"), "weight": F.sum("weight")})
    nodes = stage(nodes, "vector-nodes")
    distinct = nodes.select("node", "dim", "vec", "weight")

    def found():
        index = stage(describe(distinct, choose_pivots(distinct, pivots)), "pivot-index")
        return links(index, distinct, cosine, shared, prefix)

    found = stage_only(found, "vector-links")
    gained = found.groupBy(F.col("b").alias("node")).agg(F.sum("nb").alias("gain"))
    comp = stage_only(lambda: components(found.filter("a <> b").select("a", "b")), "vector-linked")
    labelled = nodes.join(gained, "node", "left").join(comp, "node", "left")
    labelled = stage(labelled.select(*same, "_salts", "low", F.coalesce("component", "node").alias("component"), (F.coalesce("gain", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "vector-components")
    parts = salted(labelled.select(*same, "low", "component", "n_links"), F.col("vec"))
    lows = fold(parts, ["component"], {"component_id": F.min("low")}, {"component_id": F.min("component_id")})
    named = unfold(parts, lows, ["component"]).select(*same, "n_links", "component_id")
    linked = unfold(good, labelled.select(*same, "_salts").join(named, same), same).select("_id", "n_links", "component_id")
    alone = rows.filter("not _ok").select("_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
