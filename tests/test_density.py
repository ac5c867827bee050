"""Hierarchical density clusters against a plain computation from the definition, top down over a whole distance matrix."""

import numpy as np
import pytest

from broadsheet.operators import density


def _tree(reach):
    """(u, v, w) of a minimum spanning tree by Prim's rule on the whole matrix."""
    n = len(reach)
    near, source, inside = reach[0].copy(), np.zeros(n, int), np.zeros(n, bool)
    inside[0], out = True, []
    for _ in range(n - 1):
        at = int(np.where(inside, np.inf, near).argmin())
        out.append((int(source[at]), at, float(near[at])))
        inside[at] = True
        closer = reach[at] < near
        near[closer], source[closer] = reach[at][closer], at
    return out


def plain(x, min_size, samples, single=False):
    """Set of clusters, each a frozenset of rows."""
    n = len(x)
    if n < 3:
        return set()
    u = np.round(x / np.linalg.norm(x, axis=1, keepdims=True), 9)
    d = np.maximum(np.round(np.sqrt(np.maximum(2 - 2 * u @ u.T, 0)), density.PLACES), density.FLOOR)
    np.fill_diagonal(d, -1)
    core = np.maximum(np.sort(d, axis=1)[:, min(samples, n - 1)], density.FLOOR)
    reach = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    links = {i: {} for i in range(n)}
    for a, b, w in _tree(reach):
        links[a][b] = links[b][a] = w

    def parts(rows):
        left, out = set(rows), []
        while left:
            todo = [left.pop()]
            got = set(todo)
            while todo:
                for b in links[todo.pop()]:
                    if b in left:
                        left.discard(b)
                        got.add(b)
                        todo.append(b)
            out.append(got)
        return out

    def grow(rows, birth, root):
        """(best stability, chosen clusters) of the cluster that consists of these rows at its birth."""
        whole, stability, inner, chosen = frozenset(rows), 0.0, 0.0, []
        while True:
            w = max((v for a in rows for v in links[a].values()), default=None)
            if w is None:
                break
            for a in rows:
                for b in [b for b, v in links[a].items() if v == w]:
                    del links[a][b]
            split = parts(rows)
            big = [p for p in split if len(p) >= min_size]
            if len(big) == 1:
                stability += (len(rows) - len(big[0])) * (1 / w - birth)
                rows = big[0]
                continue
            stability += len(rows) * (1 / w - birth)
            for p in big:
                s, c = grow(p, 1 / w, False)
                inner, chosen = inner + s, chosen + c
            break
        if stability >= inner and (single or not root):
            return stability, [whole]
        return inner, chosen

    return set(grow(set(range(n)), 0.0, True)[1]) if n >= min_size else set()


def _groups(rows, of=None):
    out = {}
    for r in rows:
        if r.cluster_id >= 0 and (of is None or r.day == of):
            out.setdefault(r.cluster_id, set()).add(r.vec_id)
    return out


def _frame(spark, x, day=0, start=0):
    return spark.createDataFrame([(start + i, day, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, day int, embedding array<double>")


def _blobs(seed, n, dim=8, groups=7, noise=0.25):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim)) * 3
    pick = r.integers(0, groups, n)
    x = centres[pick] + r.normal(size=(n, dim)) * r.uniform(0.2, 0.9, groups)[pick][:, None]
    loose = r.random(n) < noise
    x[loose] = r.normal(size=(int(loose.sum()), dim)) * 3
    return x


@pytest.mark.parametrize(("block", "edges"), [(5000, 10**6), (700, 900)])
def test_equals_plain_on_three_thousand(spark, block, edges):
    x = _blobs(1, 3000)
    got = _groups(density.density_clusters(_frame(spark, x), ["day"], block=block, edges_at_once=edges).collect())
    want = plain(x, 8, 8)
    assert len(want) > 2 and {frozenset(g) for g in got.values()} == want
    assert [len(got[i]) for i in range(len(got))] == sorted((len(g) for g in want), reverse=True)


def test_copies_ties_and_slices(spark):
    r = np.random.default_rng(2)
    grid = np.array([[np.cos(a), np.sin(a)] for a in np.repeat(np.arange(24) * 0.05, 3)])
    copied = np.concatenate([_blobs(3, 150, 4, 3), np.repeat(r.normal(size=(1, 4)), 90, axis=0), np.repeat(r.normal(size=(9, 4)), 8, axis=0)])
    rows = _frame(spark, grid, 0).union(_frame(spark, copied, 1)).union(_frame(spark, np.ones((40, 3)), 2))
    for min_size, samples, single, block, edges in ((5, 5, False, 40, 60), (8, 3, False, 2048, 10**6), (5, 5, True, 90, 120)):
        got = density.density_clusters(rows, ["day"], min_size=min_size, samples=samples, single=single, block=block, edges_at_once=edges).collect()
        assert len(got) == len(grid) + len(copied) + 40
        for day, x in enumerate((grid, copied, np.ones((40, 3)))):
            assert {frozenset(g) for g in _groups(got, day).values()} == plain(x, min_size, samples, single), (day, min_size, samples, single, block)


def test_rows_that_are_no_vectors(spark):
    x = np.concatenate([np.random.default_rng(4).normal([9, 0, 0], 0.1, (20, 3)), np.random.default_rng(5).normal([0, 9, 0], 0.1, (12, 3))])
    odd = [(100, 0, None), (101, 0, []), (102, 0, [0.0, 0.0, 0.0]), (103, 0, [1.0, None, 2.0]), (104, 0, [float("nan"), 1.0, 1.0]), (105, 0, [1.0, 2.0]), (None, 0, [9.0, 0.0, 0.0]), (3, 0, [9.0, 0.05, 0.0]), (107, 1, [1.0, 0.0, 0.0]), (108, None, [1.0, 0.0, 0.0])]
    rows = _frame(spark, x).union(spark.createDataFrame(odd, "vec_id long, day int, embedding array<double>")).selectExpr("*", "'x' AS cluster_id", "'y' AS u", "1 AS core")
    got = density.density_clusters(rows, ["day"], min_size=6).collect()
    assert len(got) == len(x) + len(odd)
    assert {r.cluster_id for r in got if r.vec_id is not None and (r.vec_id > 99 or r.day is None)} == {-1}
    assert next(r.cluster_id for r in got if r.vec_id is None) == 0 and sum(r.vec_id == 3 for r in got) == 2
    assert {r.cluster_id for r in got if r.vec_id is not None and 20 <= r.vec_id < 32} <= {1, -1}
    assert density.density_clusters(rows.limit(0), ["day"]).collect() == []


def test_reduced_vectors_keep_distances_in_their_plane(spark):
    r = np.random.default_rng(6)
    flat = r.normal(size=(60, 2)) @ np.linalg.qr(r.normal(size=(6, 6)))[0][:2]
    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
    rows = _frame(spark, flat).union(spark.createDataFrame([(100, 0, None), (101, 0, [1.0, 2.0]), (102, 0, [0.0] * 6)], "vec_id long, day int, embedding array<double>"))
    got = {r.vec_id: r.embedding for r in density.reduced(rows, 2).collect()}
    assert len(got) == 63 and got[100] is None and got[101] is None and got[102] is None
    low = np.array([got[i] for i in range(60)])
    assert np.allclose(low @ low.T, flat @ flat.T, atol=1e-9)
    assert density.reduced(rows.limit(0), 2).collect() == []


def test_spanning_makes_lengths_of_its_edges_alone(monkeypatch):
    x = _blobs(7, 400)
    x = np.round(x / np.linalg.norm(x, axis=1, keepdims=True), 9)
    d = np.maximum(np.round(np.sqrt(np.maximum(2 - 2 * x @ x.T, 0)), density.PLACES), density.FLOOR)
    core = np.sort(d, axis=1)[:, 8]
    want = sorted(w for _, _, w in _tree(np.maximum(np.maximum(d, core[:, None]), core[None, :])))
    roots, plain_sqrt = [], np.sqrt
    monkeypatch.setattr(density.np, "sqrt", lambda a, *more: roots.append(np.size(a)) or plain_sqrt(a, *more))
    u, v, w = density._spanning(x, core)
    assert sum(roots) <= len(x)
    assert np.allclose(np.sort(w), want, atol=1e-9) and np.allclose(w, np.maximum(np.maximum(d[u, v], core[u]), core[v]), atol=1e-9)
