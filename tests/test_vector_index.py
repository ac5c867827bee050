import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import vector_index
from broadsheet.operators.vector_index import VectorIndex


def vectors(n=1500, dim=24, groups=30, seed=3):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    x = centre[np.arange(n) % groups] + 0.5 * r.normal(size=(n, dim))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000 + i, rows[7][1]) for i in range(40)]  # copies
    rows += [(9000, None), (9001, [0.0] * dim), (9002, [math.nan] * dim), (9003, [None] * dim), (9004, [1.0, 2.0]), (None, [1.0] * dim), (9005, [math.inf] + [0.0] * (dim - 1)), (9006, [])]
    return rows


def brute(rows, metric, k, asked, others):
    dim = len(rows[0][1])
    use = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and len(v) == dim and None not in v and np.isfinite(v).all() and (metric == "dot" or np.any(v))]
    unit = (lambda v: v / np.linalg.norm(v)) if metric == "cosine" else (lambda v: v)
    x, ids = np.array([unit(v) for _, v in use]), np.array([i for i, _ in use])
    out = {}
    for i, v in use:
        if asked(i):
            s = x @ unit(v)
            order = [j for j in np.lexsort((ids, -np.round(s, 9))) if not (others and ids[j] == i)][:k]
            out[i] = [(int(ids[j]), round(float(s[j]), 7)) for j in order]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in vectors()], "vec_id long, embedding array<double>, code string, cell int").repartition(5)


@pytest.mark.parametrize(("metric", "rows", "others"), [("cosine", 32_768, False), ("dot", 32_768, True), ("cosine", 20, True)])
def test_all_cells_equal_brute_force(spark, table, tmp_path, monkeypatch, metric, rows, others):
    monkeypatch.setattr(vector_index, "ROWS", rows)
    monkeypatch.setattr(vector_index, "TOGETHER", 7)
    index = VectorIndex.build(table, f"file://{tmp_path}/i", metric=metric)
    asked = table.filter("vec_id % 50 = 0 or vec_id = 7 or vec_id > 8999").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    asked = asked.unionByName(asked.filter("query_id = 50"))
    got = {}
    for r in index.search(asked, 12, probes=10**6, others=others).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.similarity, 7)))
    want = brute(vectors(), metric, 12, lambda i: i % 50 == 0 or i == 7 or i > 8999, others)
    assert got.keys() == want.keys()
    for i, found in got.items():
        assert [s for _, s in found] == pytest.approx([s for _, s in want[i]], abs=1e-6)
    if others:
        assert all(i not in [j for j, _ in v] for i, v in got.items())


def test_recall_of_probes_and_pruned_partitions(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = VectorIndex.build(e, f"file://{tmp_path}/i")
    q = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    found = {(r.query_id, r.id) for r in index.search(q, 10, others=True).collect()}
    exact = {(r.query_id, r.id) for r in index.search(q, 10, probes=10**6, others=True).collect()}
    assert len(found & exact) >= 0.9 * len(exact), len(found & exact) / len(exact)
    again = VectorIndex.open(spark, index.path)
    assert again.probes == index.probes < len(index.cells)
    near = spark.createDataFrame([(i, v) for i, v in vectors(3000) if i is not None and i < 3000], "vec_id long, embedding array<double>")
    grouped = VectorIndex.build(near, f"file://{tmp_path}/g", cells=30)
    assert grouped.probes <= 3  # where there are groups, few cells do
    one = index.nearest(e.filter("vec_id = 7").first()["embedding"], 5)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and one.first()["id"] == 7
    assert "NestedLoop" not in index.search(q, 10)._jdf.queryExecution().executedPlan().toString()


def test_edges(spark, table, tmp_path):
    empty = VectorIndex.build(table.limit(0), f"file://{tmp_path}/e")
    q = table.limit(3).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    assert empty.search(q).count() == 0 and empty.nearest([1.0] * 24).count() == 0
    index = VectorIndex.build(table.limit(5), f"file://{tmp_path}/s", cells=50)
    assert index.nearest([0.0] * 24).count() == 0 and index.nearest([1.0]).count() == 0 and index.search(q.limit(0)).count() == 0
    with pytest.raises(ValueError):
        VectorIndex.build(table, f"file://{tmp_path}/m", metric="euclid")


def test_copies_of_queries_are_sent_in_bounded_batches(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([r for r in vectors(300) if r[0] is not None and r[0] < 300], "vec_id long, embedding array<double>")
    index = VectorIndex.build(rows, str(tmp_path / "index"), metric="dot", recall=1.0)
    asked = rows.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    plain = lambda: sorted((r.query_id, r["rank"], r.id) for r in index.search(asked, 3, probes=len(index.cells), others=True).collect())
    at_once = plain()
    monkeypatch.setattr(vector_index, "SENT", 1)  # a query at a time
    assert plain() == at_once and len(at_once) == 90
