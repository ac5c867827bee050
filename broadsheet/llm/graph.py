"""Links inside buckets, and connected components, without a task that gathers a bucket or a component."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import fold, release, salted, stage, unfold, unstage

#: Members of a bucket that one task compares with one another at once; larger buckets are dealt out as pairs of blocks.
BLOCK = 1024


# ---------------------------------------------------------------- connected components


def _attach_min(edges: DataFrame) -> DataFrame:
    """(x, y, m): m is the smallest of x and its neighbours."""
    rows = salted(edges, F.col("y"))
    low = fold(rows, ["x"], {"m": F.min("y")}, {"m": F.min("m")}).withColumn("m", F.least("x", "m"))
    return unfold(rows, low, ["x"])


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node in edges (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: every round moves links to smaller nodes, and O(log^2 n) rounds leave one
    star for each component. Each round is written to the shared folder. Hubs are salted.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).filter("x <> y").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        large = _attach_min(both).filter("y > x and y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.distinct()
        small = _attach_min(large)
        small = small.select(F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e"))
        after = stage(small.select("e.x", "e.y").filter("x <> y").distinct(), "edges")
        unstage(now)
        now = after
        release(edges.sparkSession)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
        now.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    )


# ---------------------------------------------------------------- buckets


def runs(batches: Iterator[pa.RecordBatch], keys: int, hold: int) -> Iterator[tuple[pa.Table, np.ndarray, bool, bool]]:
    """Runs of equal keys in batches sorted by their first `keys` columns, streamed: (table, starts, first, last).

    Whole runs come together in one table, with the start of each. A run that exceeds `hold` rows comes as pieces of at
    most `hold` rows, one a table: first and last say whether the piece opens or ends its run.
    """
    rest: pa.Table | None = None
    opened = False

    def changes(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for i in range(keys):
            c = t.column(i).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return new

    def cut(t: pa.Table, final: bool):
        nonlocal rest, opened
        new = changes(t)
        new[0] = True
        starts = np.flatnonzero(new)
        if opened:  # t begins inside a run of which pieces have gone out
            end = starts[1] if len(starts) > 1 else t.num_rows
            whole = len(starts) > 1 or final
            at = 0
            while end - at > hold or (whole and at < end):
                n = min(hold, end - at)
                yield t.slice(at, n), np.array([0]), False, whole and at + n == end
                at += n
            if whole:
                opened = False
                t = t.slice(end)
                if t.num_rows:
                    yield from cut(t, final)
                else:
                    rest = None
            else:
                rest = t.slice(at)
            return
        tail = t.num_rows if final else starts[-1]
        sizes = np.diff(np.append(starts, t.num_rows))
        at = 0
        for big in np.flatnonzero(sizes > hold):
            if starts[big] > at:
                yield t.slice(at, starts[big] - at), starts[(starts >= at) & (starts < starts[big])] - at, True, True
            at = starts[big]
            if at == tail and not final:  # the run may go on
                yield t.slice(at, hold), np.array([0]), True, False
                opened = True
                yield from cut(t.slice(at + hold), False)
                return
            end = at + sizes[big]
            while at < end:
                n = min(hold, end - at)
                yield t.slice(at, n), np.array([0]), at == starts[big], at + n == end
                at += n
        if tail > at:
            yield t.slice(at, tail - at), starts[(starts >= at) & (starts < tail)] - at, True, True
        rest = t.slice(tail) if tail < t.num_rows else None

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if rest is not None and rest.num_rows:
            t = pa.concat_tables([rest, t]).combine_chunks()
        rest = None
        yield from cut(t, False)
    if rest is not None and rest.num_rows:
        yield from cut(rest, True)


def forest(near: np.ndarray) -> np.ndarray:
    """For each of n items its smallest reachable item, from a symmetric n x n matrix of links."""
    label = np.arange(len(near))
    while True:
        low = np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near))
        after = np.minimum(label, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def in_buckets(rows: DataFrame, keys: list[str], schema: str, small: Callable, pair: Callable, block: int = BLOCK) -> DataFrame:
    """Results (schema) for the pairs inside every bucket of equal keys, each pair of rows met once.

    rows: the keys (integers), then an item and payload. small(table, starts) handles runs of at most `block` rows that
    come together; pair(left, right) handles two blocks of a larger bucket, left is right for a block with itself.
    Larger buckets stream through their task once in O(block) memory, only to be numbered; then each pair of blocks is a
    row group of its own, dealt out over all tasks. Nothing is capped.
    """
    width, n = len(keys), max(12, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    body = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    outs = [x.split()[0] for x in schema.split(", ")]
    both = ", ".join([*body, "_block int", schema])

    def first(batches):
        number: int = 0
        for t, starts, opens, ends in runs(batches, width, block):
            if opens and ends:
                got = small(t, starts)
                if got is None:
                    continue
                m = len(got[0])
                lead = [pa.nulls(m, f.type) for f in t.schema] + [pa.nulls(m, pa.int32())]
                yield pa.RecordBatch.from_arrays([*lead, *[pa.array(x) for x in got]], names=[*t.schema.names, "_block", *outs])
            else:
                number = 0 if opens else number + 1
                m = t.num_rows
                cols = [t.column(i).combine_chunks() for i in range(t.num_columns)]
                cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(m, number, np.int32)), *[pa.nulls(m, k) for k in kinds]], names=[*t.schema.names, "_block", *outs])

    kinds = [{"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}[x.split()[1]] for x in schema.split(", ")]
    dealt = rows.repartition(n, *keys).sortWithinPartitions(*keys, rows.columns[width])
    found = stage(dealt.mapInArrow(first, both), "bucket-links")
    small_found = found.filter("_block is null").select(*outs)
    blocks = found.filter("_block is not null").select(*rows.columns, "_block")
    top = blocks.groupBy(*keys).agg(F.max("_block").alias("_top"))
    if top.isEmpty():
        return small_found
    # block b is the left of pairs (b, b..top) and the right of pairs (0..b-1, b)
    at = blocks.join(top, keys)
    at = at.withColumn(
        "_p",
        F.explode(
            F.transform(F.sequence(F.lit(0), F.col("_top")), lambda o: F.struct(F.least("_block", o).alias("i"), F.greatest("_block", o).alias("j")))
        ),
    )
    at = at.select(*keys, F.col("_p.i").alias("_i"), F.col("_p.j").alias("_j"), F.col("_block"), *rows.columns[width:])

    def second(batches):
        for t, starts, _, _ in runs(batches, width + 2, 2 * block):
            for s, e in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
                u = t.slice(s, e - s)
                i, j, b = (u.column(k).to_numpy() for k in (width, width + 1, width + 2))
                left = u.filter(pa.array(b == i))
                got = pair(left, left if i[0] == j[0] else u.filter(pa.array(b == j)), width)
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=outs)

    again = at.repartition(n * 4, *keys, "_i", "_j").sortWithinPartitions(*keys, "_i", "_j", "_block")
    return small_found.unionByName(again.mapInArrow(second, schema))
