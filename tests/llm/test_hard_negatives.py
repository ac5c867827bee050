import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import hard_negatives


def brute(rows, positives=5, negatives=10, least=30, most=90):
    use = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, y, q) in enumerate(use):
        if a % 100:
            continue
        others = [(-sum(s * t for s, t in zip(q, r, strict=True)), j, z) for m, (j, z, r) in enumerate(use) if m != n and len(r) == len(q)]
        others.sort(key=lambda x: x[:2])
        for p, j, _ in [x for x in others if x[2] == y][:positives]:
            fit = [(s, k) for s, k, z in others if z != y and least * -p <= 100 * -s <= most * -p][:negatives]
            out += [(a, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fit)]
    return sorted(out)


def rows_of(seed, n=700, dim=8, scale=1.0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, dim))
    out = [(i, [float(x) for x in scale * (centre[i % 6] + 0.6 * r.normal(size=dim))], int(r.integers(0, 3)) if i % 3 else 0) for i in range(n)]
    out += [(9000 + i, out[0][1], i % 2) for i in range(150)]  # a group of copies
    out += [(100, out[5][1], 1), (8800, None, 1), (8801, [1.0] * dim, None), (8802, [None] + [1.0] * (dim - 1), 1), (8803, [math.inf] * dim, 2)]
    out += [(8804, [math.nan] * dim, 2), (None, [1.0] * dim, 1), (8900, [0.0] * dim, 0), (8901, [2.0, -1.0], 0), (8400, [1.0, 1.0], 0), (8402, [1.0, 0.5], 1), (8403, [], 1)]
    return out


@pytest.mark.parametrize(("block", "shard", "group", "pivots", "scale"), [(1024, 32, 128, 24, 1.0), (16, 2, 3, 4, 1.0), (64, 4, 8, 6, 3e4), (50, 4, 8, 5, 1e6)])
def test_equals_brute_force(spark, block, shard, group, pivots, scale):
    rows = rows_of(block, scale=scale)
    df = spark.createDataFrame([(i, v, y, "t", 5) for i, v, y in rows], "vec_id long, embedding array<double>, label int, q string, far int").repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, block=block, shard=shard, group=group, pivots=pivots)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert want and sorted(map(tuple, got.collect())) == want


def test_edges(spark):
    schema = "vec_id long, embedding array<double>, label int"
    mine = lambda rows: hard_negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0).collect()
    assert mine([]) == [] and mine([(100, None, 1)]) == [] and mine([(100, [1.0], 1), (1, [1.0], 1)]) == []
    assert mine([(100, [1e300], 1), (1, [1.0], 1), (2, [0.5], 2)]) == []  # its norm does not fit
    zero = mine([(100, [0.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [5.0], 2)])
    assert [(x["negative_id"], x["positive_score"], x["rank"]) for x in zero] == [(2, 0, 1), (3, 0, 2)]


def test_brackets_hold_and_prune():
    r = np.random.default_rng(4)
    centre = 200 * r.normal(size=(8, 32))
    x = np.floor(centre[np.arange(800) % 8] + 10 * r.normal(size=(800, 32)))
    most = float((x * x).sum(axis=1).max())
    p = x[:8]
    far = hard_negatives._distances(hard_negatives.lifted(x, most), hard_negatives.lifted(p, most)).astype("<f4").astype(float)
    asked = hard_negatives._distances(np.hstack([x[:20], np.zeros((20, 1))]), hard_negatives.lifted(p, most))
    low, high = hard_negatives.brackets(asked, (x[:20] ** 2).sum(axis=1), far.T, far.T, most)
    exact = x[:20] @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    tenth = np.sort(exact, axis=1)[:, -10]
    assert (high >= tenth[:, None]).mean() < 0.5
