"""Nearest vectors through an inverted file: coarse cells, residual codes with error bounds, exact ranking of what is left."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions.vectors import dot

#: Most cells, rows a cell that their centres are fitted on, and rows of a cell that one task compares at once.
CELLS, SAMPLE, ROWS = 4096, 128, 32_768
#: Queries that are compared together.
TOGETHER = 256
#: Share of the LEARNT_K nearest rows of LEARN rows that lie in the cells which a query looks into: it sets their number.
RECALL, LEARN, LEARNT_K = 0.95, 100, 10
#: Copies of queries that a task sends at once.
SENT = 4_096


def _usable(vectors: DataFrame, id_col: str, vector_col: str, metric: str) -> DataFrame:
    """(id, vec): vectors without null or non-finite components; for cosine of norm 1, without those of norm 0."""
    v = F.col(vector_col).cast("array<double>")
    good = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(good).select(F.col(id_col).cast("bigint").alias("id"), v.alias("vec"))
    if metric == "dot":
        return rows
    norm = F.sqrt(dot(F.col("vec"), F.col("vec")))
    return rows.withColumn("_n", norm).filter("_n > 0 and _n < double('infinity')").select("id", F.transform("vec", lambda x: x / F.col("_n")).alias("vec"))


class VectorIndex:
    """A table of vectors partitioned by cell, a table of the cells, and how many a query looks into by default: `rows`, `cells`
    and `probes` under one path.

    A row has its id, its vector, and a code: the vector less its cell's centre in 8 bits a component, with the distance
    between both as an error bound. Codes bracket a similarity, so ranking by exact values what the brackets leave gives the
    exact order among all rows of the cells that are looked into; with all cells the search is exact.
    """

    def __init__(self, spark: SparkSession, path: str, probes: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        known = spark.read.parquet(f"{self.path}/cells").orderBy("cell").collect()  # at most CELLS rows
        self.metric = known[0].metric if known else "cosine"
        self.cells = np.array([r.cell for r in known], np.int64)
        self.centres = np.array([r.centre for r in known], np.float64)
        self.near = _Near(self.centres)
        self.probes = len(self.cells) if probes is None else probes

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema("id bigint, vec array<double>, code binary, scale double, err double, cell int").parquet(f"{self.path}/rows")

    @classmethod
    def build(cls, vectors: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None, metric: str = "cosine", recall: float = RECALL, seed: int = 42) -> VectorIndex:
        """Write the index. Cells are the square root of the rows unless given, at most CELLS and half the rows; their centres are fitted on
        about SAMPLE rows a cell, by hashed ids. Vectors of another length than the most frequent one are left out.

        How many cells a query looks into is measured, so that `recall` of the nearest rows are found. Rows are dealt by ranges of cell and id, so a cell that holds many rows becomes many files.
        """
        if metric not in ("cosine", "dot"):
            raise ValueError(f"no such metric: {metric}")
        spark, path = vectors.sparkSession, path.rstrip("/")
        rows = _usable(vectors, id_col, vector_col, metric)
        sizes = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.col("count").desc(), "dim").first()
        dim, n = (sizes["dim"], sizes["count"]) if sizes else (0, 0)
        rows = rows.filter(F.size("vec") == dim)
        many = max(1, min(CELLS, cells or math.isqrt(n), n // 2))
        centres = np.zeros((1, dim))
        if many > 1:
            share = min(1.0, SAMPLE * many / n)
            sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(array_to_vector("vec").alias("features"))
            centres = np.array(KMeans(k=many, seed=seed, maxIter=15).fit(sample).clusterCenters())
        half = (centres * centres).sum(axis=1) / 2

        def code(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, dim)
                cell = (x @ centres.T - half).argmax(axis=1)
                rest = x - centres[cell]
                scale = np.maximum(np.abs(rest).max(axis=1) / 127, 1e-300)
                codes = np.rint(rest / scale[:, None]).astype(np.int8)
                err = np.linalg.norm(rest - codes * scale[:, None], axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(err), pa.array(cell.astype(np.int32))], names=["id", "vec", "code", "scale", "err", "cell"])

        coded = rows.mapInArrow(code, "id bigint, vec array<double>, code binary, scale double, err double, cell int")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        coded.repartitionByRange(parts, "cell", "id").sortWithinPartitions("cell").write.partitionBy("cell").parquet(f"{path}/rows")
        listed = spark.createDataFrame([(i, [float(v) for v in c], metric) for i, c in enumerate(centres)], "cell int, centre array<double>, metric string")
        listed.coalesce(1).write.parquet(f"{path}/cells")
        index = cls(spark, path)
        index.probes = index._learn_probes(recall)
        spark.createDataFrame([(index.probes,)], "probes int").coalesce(1).write.parquet(f"{path}/probes")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        return cls(spark, path, spark.read.parquet(f"{path.rstrip('/')}/probes").first()["probes"])

    def _learn_probes(self, recall: float) -> int:
        """The fewest cells that hold `recall` of the nearest rows of LEARN rows, those of lowest hashed id, measured exactly."""
        if len(self.cells) < 2:
            return 1
        sample = self.rows.select(F.col("id").alias("query_id"), F.col("vec").alias("q")).orderBy(F.xxhash64("query_id"), "query_id").limit(LEARN).collect()
        asked = self.spark.createDataFrame([(r.query_id, r.q) for r in sample], "query_id bigint, q array<double>")
        found = self.search(asked, LEARNT_K, probes=len(self.cells), others=True).join(self.rows.select("id", "cell"), "id").select("query_id", "cell").collect()
        place = {r.query_id: {c: i for i, c in enumerate(order)} for r, order in zip(sample, self.cells[self.near(np.array([r.q for r in sample]), None)].tolist(), strict=True)}
        places = sorted(place[r.query_id][r.cell] for r in found)
        return places[min(len(places) - 1, math.ceil(recall * len(places)) - 1)] + 1 if places else len(self.cells)

    def nearest(self, query: list[float], k: int = 10, probes: int | None = None) -> DataFrame:
        """(id, similarity) of the k rows nearest to one vector, ties by id; only the partitions of its cells are read."""
        q = np.array(query, np.float64)
        norm = np.linalg.norm(q) if self.metric == "cosine" else 1.0
        if q.size != self.centres.shape[1] or not np.isfinite(q).all() or norm == 0:
            return self.rows.limit(0).select("id", F.lit(0.0).alias("similarity"))
        cells = self.cells[self.near(q[None, :] / norm, probes or self.probes)[0]].tolist()
        value = dot(F.col("vec"), F.array(*[F.lit(float(x)) for x in q / norm]))
        return self.rows.filter(F.col("cell").isin(cells)).select("id", value.alias("similarity")).orderBy(F.col("similarity").desc(), "id").limit(k)

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, id_col: str = "query_id", vector_col: str = "q", others: bool = False) -> DataFrame:
        """(query_id, id, similarity, rank): the k nearest rows of each query, ties by id; with `others`, not itself.

        Queries that are no usable vectors or of another length find nothing; queries that repeat an id are searched once.
        A task holds up to about ROWS codes of a cell while the queries that look into the cell stream past, so its memory
        grows neither with the queries nor with the cell; queries are copied once for each of their cells' parts.
        """
        asked = _usable(queries, id_col, vector_col, self.metric).filter(F.size("vec") == self.centres.shape[1]).dropDuplicates(["id"])
        probes = probes or self.probes
        near, cells, centres, keep = self.near, self.cells, self.centres, others

        def probe(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                q = np.asarray(b.column(1).flatten()).reshape(b.num_rows, -1)
                # a copy for each cell: no more than SENT at once, however many queries and cells there are
                step = max(1, SENT // max(1, min(probes, len(cells))))
                for i in range(0, len(q), step):
                    found = near(q[i : i + step], probes)
                    take = pa.array(i + np.repeat(np.arange(len(found)), found.shape[1]))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(cells[found.ravel()].astype(np.int32))], names=["id", "vec", "cell"])

        sent = asked.mapInArrow(probe, "id bigint, vec array<double>, cell int")
        sizes = self.rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("parts"))
        none = F.lit(None)
        coded = self.rows.join(F.broadcast(sizes), "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "code", "scale", "err", none.cast("array<double>").alias("vec"))
        sent = sent.join(F.broadcast(sizes), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        sent = sent.select("cell", "part", F.lit(1).alias("kind"), "id", none.cast("binary").alias("code"), none.cast("double").alias("scale"), none.cast("double").alias("err"), "vec")
        n = max(8, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        both = coded.unionByName(sent).repartition(n, "cell", "part").sortWithinPartitions("cell", "part", "kind", "id")
        names = ["query_id", "id", "cell", "low", "high"]

        def compare(batches):
            at, codes, block, waiting = None, [], None, []

            def out():
                nonlocal block, waiting
                if not waiting or not codes:
                    waiting = []
                    return
                if block is None:
                    block = [np.concatenate([c[i] for c in codes]) for i in range(4)]
                ids, code, scale, err = block
                q = np.array([v for _, v in waiting])
                value = (q @ centres[np.searchsorted(cells, at[0])])[:, None] + (q.astype(np.float32) @ code.astype(np.float32).T).astype(np.float64) * scale
                slack = np.linalg.norm(q, axis=1)[:, None] * (err + 1e-5 * (1 + scale * 127))
                asks = np.array([i for i, _ in waiting], np.int64)
                waiting = []
                low, high = value - slack, value + slack
                if keep:
                    own = ids[None, :] == asks[:, None]
                    low[own] = high[own] = -np.inf
                least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(q), -np.inf)
                a, b = np.nonzero((high >= least[:, None]) & (high > -np.inf))
                cell = np.full(len(a), at[0], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(asks[a]), pa.array(ids[b]), pa.array(cell), pa.array(low[a, b]), pa.array(high[a, b])], names=names)

            for b in batches:
                keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
                start = 0
                while start < len(keys):
                    end = start
                    while end < len(keys) and keys[end] == keys[start]:
                        end += 1
                    cell, part, kind = keys[start]
                    if at != (cell, part):
                        yield from out()
                        at, codes, block = (cell, part), [], None
                    run = b.slice(start, end - start)
                    if kind == 0:
                        code = np.frombuffer(b"".join(run.column(4).to_pylist()), np.int8).reshape(run.num_rows, -1)
                        codes.append((run.column(3).to_numpy(), code, run.column(5).to_numpy(), run.column(6).to_numpy()))
                    else:
                        for i, v in zip(run.column(3).to_pylist(), run.column(7).to_pylist(), strict=True):
                            waiting.append((i, v))
                            if len(waiting) == TOGETHER:
                                yield from out()
                    start = end
            yield from out()

        found = both.mapInArrow(compare, "query_id bigint, id bigint, cell int, low double, high double")
        mine = Window.partitionBy("query_id")
        found = found.withColumn("_r", F.row_number().over(mine.orderBy(F.col("low").desc(), "id")))
        found = found.withColumn("_least", F.max(F.when(F.col("_r") == k, F.col("low"))).over(mine)).filter("_least is null or high >= _least")
        exact = found.select("query_id", "id", "cell").join(self.rows.select("id", "cell", "vec"), ["cell", "id"]).join(asked.select(F.col("id").alias("query_id"), F.col("vec").alias("_q")), "query_id")
        scored = exact.select("query_id", "id", dot(F.col("vec"), F.col("_q")).alias("similarity"))
        rank = F.row_number().over(mine.orderBy(F.col("similarity").desc(), "id"))
        return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


class _Near:
    """Places of the `probes` nearest centres of each vector, all without a number."""

    def __init__(self, centres: np.ndarray):
        self.centres, self.half = centres, (centres * centres).sum(axis=1) / 2

    def __call__(self, q: np.ndarray, probes: int | None) -> np.ndarray:
        many = len(self.centres) if probes is None else min(probes, len(self.centres))
        return np.argsort(-(q @ self.centres.T - self.half), axis=1, kind="stable")[:, :many]
