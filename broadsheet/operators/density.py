"""Hierarchical density clusters: distances in blocks, a spanning forest by Borůvka's rounds, a condensed tree by levels of edges."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.vectors import dot
from broadsheet.sources.shared import drop_path, shared_dir, stored

MIN_SIZE = 8
#: Distinct vectors of a block (two blocks meet in a task), and edges of a slice that a task merges at once, about.
BLOCK, EDGES = 2048, 2_000_000
#: Distances are rounded to this many places and are at least the floor, so that densities stay finite.
PLACES, FLOOR = 10, 1e-6

_MERGED = "_s string, kind int, comp bigint, to bigint, size bigint, cluster bigint, acc double, best double, parent bigint, chosen boolean"


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors; about 0 for equal ones."""
    return 2 - 2 * (x @ y.T)


def _lengths(squares: np.ndarray) -> np.ndarray:
    """Distances, which rise with their squares."""
    return np.maximum(np.round(np.sqrt(np.maximum(squares, 0)), PLACES), FLOOR)


def _spanning(x: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, weight) of a minimum spanning tree by mutual reachability: the largest of a distance and both core distances.

    Squares have the order of reaches, so only the tree's own edges are made lengths. Points that are left stand first.
    """
    n = len(x)
    u, v, w = np.zeros(n - 1, np.int64), np.zeros(n - 1, np.int64), np.zeros(n - 1)
    rows, least = np.arange(n), core * core
    twice = np.ascontiguousarray(-2 * x)
    near, source = np.full(n, np.inf), np.zeros(n, np.int64)
    at, m = 0, n
    for i in range(n - 1):
        here, square, one = rows[at], least[at], x[rows[at]]
        m -= 1
        for a in (rows, least, twice, near, source):
            a[at] = a[m]
        reach = twice[:m] @ one
        reach += 2
        np.maximum(reach, least[:m], out=reach)
        np.maximum(reach, square, out=reach)
        closer = reach < near[:m]
        np.copyto(near[:m], reach, where=closer)
        np.copyto(source[:m], here, where=closer)
        at = int(near[:m].argmin())
        u[i], v[i], w[i] = source[at], rows[at], near[at]
    return u, v, _lengths(w)


def _finite(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _unit(vectors: DataFrame, slice_cols: list[str], id_col: str, vector_col: str) -> DataFrame:
    """vectors with _s, the slice, and _vec, the vector of norm 1; null for what has no direction."""
    v = F.col(vector_col).cast("array<double>")
    norm = F.sqrt(dot(v, v))
    usable = _finite(v) & (norm > 0) & (norm < float("inf"))
    rows = vectors.select(*slice_cols, id_col, F.to_json(F.struct(*slice_cols)).alias("_s") if slice_cols else F.lit("").alias("_s"), F.when(usable, F.transform(v, lambda x: F.round(x / norm, 9) + F.lit(0.0))).alias("_vec"))
    return rows.withColumn("_dim", F.coalesce(F.size("_vec"), F.lit(-1)))


def reduced(vectors: DataFrame, dims: int = 10, vector_col: str = "embedding") -> DataFrame:
    """vectors with vector_col in its `dims` principal components (doubles): densities tell little in hundreds of dimensions.

    Components come from the covariance of all unit vectors of the most frequent length (ties: the shorter), which is the
    square of that length in size; vectors that aren't usable, and those of another length, become null. Up to `dims`
    components are only divided by their norm. Extra columns and repeated rows stay.
    """
    v = F.col(vector_col).cast("array<double>")
    norm = F.sqrt(dot(v, v))
    rows = vectors.withColumn("_unit", F.when(_finite(v) & (norm > 0) & (norm < float("inf")), F.transform(v, lambda x: x / norm)))
    common = rows.filter("_unit is not null").groupBy(F.size("_unit").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    size = common["d"] if common else 0
    same = F.when(F.size("_unit") == size, F.col("_unit"))
    if size <= dims or common["count"] < 2:
        return rows.withColumn(vector_col, same).drop("_unit")
    fit = rows.select(same.alias("_a")).filter("_a is not null").select(array_to_vector("_a").alias("_x"))
    axes = PCA(k=dims, inputCol="_x", outputCol="_y").fit(fit).pc.toArray().T
    value = [F.aggregate(F.zip_with(same, F.array(*[F.lit(float(a)) for a in axis]), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) for axis in axes]
    return rows.withColumn(vector_col, F.when(same.isNotNull(), F.array(*value))).drop("_unit")


def _pairs(points: DataFrame, own: bool) -> DataFrame:
    """A row for each pair of blocks (a <= b) that the point's block is in; with `own` its pair with itself, too."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    out = points.withColumn("_j", other)
    if not own:
        out = out.filter((F.col("_j") != F.col("block")) | (F.col("blocks") == 1))
    return out.withColumn("a", F.least("block", "_j")).withColumn("b", F.greatest("block", "_j")).drop("_j")


def _with_core(points: DataFrame, k: int) -> DataFrame:
    """points with core, the distance to the k-th nearest other row, or to the farthest if there are fewer; copies count."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, block = np.stack(pdf["_vec"].to_numpy()), pdf["block"].to_numpy()
        u, c = pdf["u"].to_numpy(), pdf["copies"].to_numpy()
        a, b = pdf["a"].iloc[0], pdf["b"].iloc[0]
        out = []
        for here, there in {(a, b), (b, a)}:
            rows, cols = np.flatnonzero(block == here), np.flatnonzero(block == there)
            if not len(cols):
                continue
            for at in range(0, len(rows), 512):
                part = rows[at : at + 512]
                d = _squares(x[part], x[cols])
                if here == there:
                    d[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
                few = min(k, len(cols))
                take = np.argpartition(d, few - 1, axis=1)[:, :few]
                d = np.take_along_axis(d, take, axis=1)
                ok, length, copies = np.isfinite(d), _lengths(d), c[cols[take]]
                for i, row in enumerate(part):
                    out.append((u[row], length[i][ok[i]], copies[i][ok[i]]))
        return pd.DataFrame(out, columns=["u", "d", "c"])

    near = _pairs(points, True).groupBy("_s", "a", "b").applyInPandas(run, "u bigint, d array<double>, c array<bigint>")
    lists = near.groupBy("u").agg(F.sort_array(F.flatten(F.collect_list(F.arrays_zip("d", "c")))).alias("near"))
    walk = F.aggregate(
        "near",
        F.struct((F.lit(k) - F.col("copies") + 1).cast("bigint").alias("left"), F.lit(FLOOR).alias("d")),
        lambda acc, x: F.struct((acc["left"] - F.when(acc["left"] > 0, x["c"]).otherwise(0)).alias("left"), F.when(acc["left"] > 0, x["d"]).otherwise(acc["d"]).alias("d")),
    )["d"]
    return points.join(lists, "u", "left").withColumn("core", F.coalesce(walk, F.lit(FLOOR))).drop("near")


def _forest_of_pairs(points: DataFrame) -> DataFrame:
    """(_s, u, v, w, blocks), u < v: a spanning tree of each pair of blocks. Their union holds a spanning tree of the slice."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, s = pdf["u"].to_numpy(), pdf["_s"].iloc[0]
        i, j, w = _spanning(np.stack(pdf["_vec"].to_numpy()), pdf["core"].to_numpy())
        return pd.DataFrame({"_s": s, "u": np.minimum(ids[i], ids[j]), "v": np.maximum(ids[i], ids[j]), "w": w, "blocks": pdf["blocks"].iloc[0]})

    return _pairs(points, False).groupBy("_s", "a", "b").applyInPandas(run, "_s string, u bigint, v bigint, w double, blocks int")


def spanning_forest(edges: DataFrame, under: str = "density") -> DataFrame:
    """(_s, u, v, w): the minimum spanning forest of edges by Borůvka's rounds; ties by u and v.

    Each round takes the least edge of every component, joins components along them by doubling pointers, and keeps the
    least edge between two components, so a component that holds most rows has no more edges than there are components.
    """
    left = stored(edges.groupBy("_s", "u", "v").agg(F.min("w").alias("w")).select("_s", "u", "v", "w", F.col("u").alias("cu"), F.col("v").alias("cv")), f"{under}/edges")
    taken = []
    while not left.isEmpty():
        edge = lambda to: F.struct("w", "u", "v", F.col(to).alias("to"), "_s")
        ends = left.select(F.col("cu").alias("c"), edge("cv").alias("e")).union(left.select(F.col("cv").alias("c"), edge("cu").alias("e")))
        least = stored(ends.groupBy("c").agg(F.min("e").alias("e")).select("c", "e.*"), f"{under}/least")
        taken.append(least.select("_s", "u", "v", "w").distinct())
        back = least.select(F.col("c").alias("to"), F.col("to").alias("_back"))
        root = (F.col("_back") == F.col("c")) & (F.col("c") < F.col("to"))
        hooks = stored(least.join(back, "to", "left").select("c", F.when(root, F.col("c")).otherwise(F.col("to")).alias("r")), f"{under}/hooks")
        while True:
            up = hooks.select(F.col("c").alias("r"), F.col("r").alias("_r"))
            after = stored(hooks.join(up, "r").select("c", F.col("_r").alias("r"), (F.col("r") != F.col("_r")).alias("moved")), f"{under}/hooks")
            hooks = after.select("c", "r")
            if after.filter("moved").isEmpty():
                break
        for end in ("cu", "cv"):
            left = left.join(hooks.select(F.col("c").alias(end), F.col("r").alias("_r")), end).drop(end).withColumnRenamed("_r", end)
        left = left.filter("cu != cv").groupBy(F.least("cu", "cv").alias("a"), F.greatest("cu", "cv").alias("b")).agg(F.min(F.struct("w", "u", "v", "_s")).alias("e"))
        left = stored(left.select("e._s", "e.u", "e.v", "e.w", F.col("a").alias("cu"), F.col("b").alias("cv")), f"{under}/edges")
    if not taken:
        return left.select("_s", "u", "v", "w")
    out = taken[0]
    for more in taken[1:]:
        out = out.union(more)
    return out


def _merge(level: int, min_size: int):
    """A task's work: merge a slice's components along edges of rising weight; edges of one weight act together."""

    def run(key, edges: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        comps = states["comp"].to_numpy()
        place = {c: i for i, c in enumerate(comps.tolist())}
        n = len(comps)
        parent, name = list(range(n)), comps.tolist()
        size = states["size"].tolist()
        cluster = [None if pd.isna(c) else int(c) for c in states["cluster"]]
        acc, best = states["acc"].tolist(), states["best"].tolist()
        loose = [[i] if cluster[i] is None else [] for i in range(n)]
        joined, closed, opened = [None] * n, [], 0

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        edges = edges.sort_values(["w", "cu", "cv"])
        us, vs, ws = edges["cu"].tolist(), edges["cv"].tolist(), edges["w"].tolist()
        at = 0
        while at < len(ws):
            w, touched = ws[at], set()
            first = at
            while at < len(ws) and ws[at] == w:
                touched.update((find(place[us[at]]), find(place[vs[at]])))
                at += 1
            for e in range(first, at):
                a, b = find(place[us[e]]), find(place[vs[e]])
                if a != b:
                    parent[max(a, b)] = min(a, b)
            groups: dict[int, list[int]] = {}
            for t in sorted(touched):
                groups.setdefault(find(t), []).append(t)
            dense = 1 / w
            for root, parts in groups.items():
                held = [p for p in parts if cluster[p] is not None]
                free = [p for p in parts if cluster[p] is None]
                total, more = sum(size[p] for p in parts), sum(size[p] for p in free)
                members = [i for p in free for i in loose[p]]
                if len(held) == 1:
                    now, sums, inner = cluster[held[0]], acc[held[0]] + more * dense, best[held[0]]
                elif total < min_size:
                    now, sums, inner = None, 0.0, 0.0
                else:
                    now, sums, inner = (level << 32) + opened, total * dense, 0.0
                    opened += 1
                    for p in held:
                        stability = acc[p] - size[p] * dense
                        chosen = stability >= best[p]
                        closed.append((cluster[p], now, stability, chosen))
                        inner += stability if chosen else best[p]
                if now is not None:
                    for i in members:
                        joined[i] = now
                    members = []
                name[root] = min(name[p] for p in parts)
                size[root], cluster[root], acc[root], best[root], loose[root] = total, now, sums, inner, members
        roots = [find(i) for i in range(n)]
        out = [(key[0], 0, int(comps[i]), name[r], None, joined[i], None, None, None, None) for i, r in enumerate(roots)]
        out += [(key[0], 1, name[r], None, size[r], cluster[r], acc[r], best[r], None, None) for r in sorted(set(roots))]
        out += [(key[0], 2, None, None, None, c, s, None, p, ok) for c, p, s, ok in closed]
        frame = pd.DataFrame(out, columns=["_s", "kind", "comp", "to", "size", "cluster", "acc", "best", "parent", "chosen"])
        return frame.astype({c: "Int64" for c in ("comp", "to", "size", "cluster", "parent")} | {"acc": "float64", "best": "float64", "chosen": "boolean"})

    return run


def _condensed(points: DataFrame, forest: DataFrame, min_size: int, edges_at_once: int, single: bool, under: str) -> tuple[DataFrame, DataFrame]:
    """(places, tree): the cluster that each point first lies in, and (_s, cluster, parent, chosen, stability).

    Edges are dealt by ranges of weight; the slices' first ranges are merged together, then their second ones, so what a
    task holds is a range's edges and the components that they touch, however large a slice is.
    """
    loops = points.filter(F.col("copies") >= min_size).select("_s", "u", F.col("u").alias("v"), F.col("core").alias("w"))
    every = stored(forest.select("_s", "u", "v", "w").union(loops), f"{under}/forest")
    ranges = max(1, -(-every.count() // edges_at_once))
    dealt = stored(every.repartitionByRange(ranges, "_s", "w").withColumn("_r", F.spark_partition_id()), f"{under}/levels")
    first = dealt.groupBy("_s").agg(F.min("_r").alias("_first"))
    dealt = dealt.join(first, "_s").withColumn("level", F.col("_r") - F.col("_first")).drop("_r", "_first")
    levels = dealt.agg(F.max("level")).first()[0]
    places = points.select("_s", "u", F.col("u").alias("comp"), F.lit(None).cast("bigint").alias("cluster"))
    states = points.select("_s", F.col("u").alias("comp"), F.col("copies").alias("size"), F.lit(None).cast("bigint").alias("cluster"), F.lit(0.0).alias("acc"), F.lit(0.0).alias("best"))
    closed = None
    for level in range(-1 if levels is None else levels + 1):
        now = dealt.filter(F.col("level") == level)
        for end, comp in (("u", "cu"), ("v", "cv")):
            now = now.join(places.select(F.col("u").alias(end), F.col("comp").alias(comp)), end)
        now = now.select("_s", "w", "cu", "cv")
        touched = now.select(F.col("cu").alias("comp")).union(now.select(F.col("cv").alias("comp"))).distinct()
        held = states.join(touched, "comp", "left_semi").select("_s", "comp", "size", "cluster", "acc", "best")
        merged = stored(now.groupBy("_s").cogroup(held.groupBy("_s")).applyInPandas(_merge(level, min_size), _MERGED), f"{under}/merged")
        moves = merged.filter("kind = 0").select("comp", "to", F.col("cluster").alias("_joined"))
        places = places.join(moves, "comp", "left").select("_s", "u", F.coalesce("to", "comp").alias("comp"), F.coalesce("cluster", "_joined").alias("cluster"))
        after = merged.filter("kind = 1").select("_s", "comp", "size", "cluster", "acc", "best")
        states = states.join(moves, "comp", "left_anti").select(*after.columns).union(after)
        if levels:
            places, states = stored(places, f"{under}/places"), stored(states, f"{under}/states")
        ends = merged.filter("kind = 2").select("_s", "cluster", "parent", "chosen", F.col("acc").alias("stability"))
        closed = ends if closed is None else closed.union(ends)
    last = states.filter("cluster is not null").select("_s", "cluster", F.lit(None).cast("bigint").alias("parent"), (F.lit(single) & (F.col("acc") >= F.col("best"))).alias("chosen"), F.col("acc").alias("stability"))
    return places, last if closed is None else closed.union(last)


def _tops(tree: DataFrame, under: str) -> DataFrame:
    """(_s, cluster, top): the chosen cluster highest above each cluster, itself included, by doubling pointers."""
    own = F.when(F.col("chosen"), F.col("cluster"))
    at = stored(tree.select("_s", "cluster", F.col("parent").alias("up"), own.alias("top")), f"{under}/tree")
    while not at.filter("up is not null").isEmpty():
        above = at.select("_s", F.col("cluster").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"))
        at = stored(at.join(above, ["_s", "up"], "left").select("_s", "cluster", F.col("_up").alias("up"), F.coalesce("_top", "top").alias("top")), f"{under}/tree")
    return at.select("_s", "cluster", "top")


def density_clusters(
    vectors: DataFrame,
    slice_cols: list[str],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    min_size: int = MIN_SIZE,
    samples: int | None = None,
    single: bool = False,
    block: int = BLOCK,
    edges_at_once: int = EDGES,
) -> DataFrame:
    """(slice columns, id, cluster_id), a row for each row of vectors: hierarchical density clusters within each slice; -1 is noise.

    Vectors get norm 1. A row's core distance is that to its `samples`-th other row (min_size unless given), and two rows
    reach each other at the largest of their distance and their core distances. From the minimum spanning tree of reaches a
    hierarchy is condensed to splits of which each side has min_size rows, and clusters of the greatest stability are
    chosen; the whole slice is one only with `single`. Merges at an equal reach are one, so the result doesn't hang on the
    order of rows. Clusters are numbered from 0 by size, then by their smallest id.

    Equal vectors are one point with a weight, so a group of copies of any size costs one. Null, empty, zero and non-finite
    vectors are noise, so are those of another length than most in their slice (ties: the shorter), and slices of fewer
    than three usable rows. Repeated ids are rows of their own, null ids too. An empty table gives no rows. Columns other
    than these are not read.
    """
    if min_size < 2:
        raise ValueError("min_size must be at least 2")
    under = f"density-{uuid.uuid4().hex}"  # the folder of this call's tables, which goes when its result is written
    rows = stored(_unit(vectors, slice_cols, id_col, vector_col), f"{under}/rows")
    usable = rows.filter(F.col("_dim") > 0)
    dims = usable.groupBy("_s", "_dim").agg(F.count(F.lit(1)).alias("_n")).groupBy("_s").agg(F.max(F.struct("_n", (-F.col("_dim")).alias("d"))).alias("m"))
    dims = dims.filter("m._n >= 3").select("_s", (-F.col("m.d")).alias("_dim"))
    points = usable.join(dims, ["_s", "_dim"]).groupBy("_s", "_dim", "_vec").agg(F.count(F.lit(1)).alias("copies"))
    points = stored(points.withColumn("u", F.monotonically_increasing_id()), f"{under}/points")
    sizes = points.groupBy("_s").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = points.select("_s", "u", "copies", "_vec").join(sizes, "_s").withColumn("block", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int"))
    dealt = stored(_with_core(dealt, samples or min_size), f"{under}/core")
    trees = stored(_forest_of_pairs(dealt), f"{under}/pairs")
    forest = trees.filter("blocks = 1").select("_s", "u", "v", "w").union(spanning_forest(trees.filter("blocks > 1").drop("blocks"), under))
    places, tree = _condensed(dealt.drop("_vec"), forest, min_size, edges_at_once, single, under)
    tops = places.join(_tops(tree, under), ["_s", "cluster"]).select("u", "top")
    found = rows.join(points.select("_s", "_vec", "u"), ["_s", "_vec"], "left").join(tops, "u", "left")
    found = stored(found.select(*slice_cols, id_col, "_s", "top"), "density-found")
    drop_path(vectors.sparkSession, f"{shared_dir(vectors.sparkSession)}/{under}")
    order = found.filter("top is not null").groupBy("_s", "top").agg(F.count(F.lit(1)).alias("_n"), F.min(id_col).alias("_least"))
    number = order.select("_s", "top", (F.row_number().over(Window.partitionBy("_s").orderBy(F.col("_n").desc(), "_least", "top")) - 1).cast("int").alias("cluster_id"))
    return found.join(number, ["_s", "top"], "left").select(*slice_cols, id_col, F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))
