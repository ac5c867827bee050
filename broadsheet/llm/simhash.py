"""SimHash near-dedup: 64-bit fingerprints, found within a radius by covering locality-sensitive hashing.

near_duplicates links fingerprints within a radius. similar_documents links texts by the Jaccard similarity of their word
shingles: at 0.8 the fingerprints of whole texts differ in 10 bits on average and up to 20, and tables that cover such a
radius number 2^21; so SimHashes of parts of the texts go into covering tables beside those of the whole, and the sets of
shingles themselves decide.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import (
    ROW_KEY,
    fold,
    keep_rows,
    over_text,
    salted,
    slices,
    small_batches,
    stage,
    stage_only,
    unfold,
    with_row_key,
)
from broadsheet.llm.graph import components, forest, in_buckets

SHINGLE, RADIUS, SEED = 4, 4, 42
_BITS = np.arange(64, dtype=np.uint64)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Hashes of the word shingles of a text, repeats included; a text of fewer words is one shingle, one without words none."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, "<u8")
    line = b" ".join(parts)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(line))
    n = max(1, len(starts) - words + 1)
    digest = xxhash.xxh64_intdigest
    ends = ends[words - 1 :] if len(ends) >= words else ends[-1:]
    return np.array([digest(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends.tolist(), strict=True)], dtype="<u8")


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, repeats included; zero for a text without words.

    A-Z is lower-cased; words are what bytes.split() gives: runs without space, tab, line feed, vertical tab, form feed
    and carriage return. A bit is set if it is set in over half of the shingles' hashes.
    """
    h = shingle_hashes(text, words)
    if not len(h):
        return 0
    n = len(h)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        counts += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(2 * counts > n, np.uint64(1) << _BITS, np.uint64(0))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit integer."""

    def rows_of(batch):
        return {"fp": pa.array(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))}

    return over_text(docs, [id_col], text_col, "fp bigint", rows_of)


def masks(radius: int = RADIUS, bits: int = 64, seed: int = 7) -> list[int]:
    """2^(radius+1) - 1 bit masks, one a table: any two values within the radius agree under at least one of them.

    Each position gets a non-zero vector of radius+1 bits; mask v holds the positions whose vector has an odd product with
    v. At most `radius` differing positions span at most `radius` dimensions, so some v is orthogonal to all of them, and
    its mask leaves them out. Vectors are dealt evenly, so every mask keeps about half of the bits.
    """
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    random.Random(seed).shuffle(vectors)
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() & 1) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fp_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` within the radius, directly or through others linked."""
    cover = masks(radius)
    keep = np.array(cover, np.uint64)
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(cover)]))
    rows = fps.select(tables.alias("e"), "fp").select("e.t", "e.k", "fp")

    def small(t: pa.Table, starts: np.ndarray):
        """Short runs pair by pair, a link only in the first table where its ends meet; long runs as a forest."""
        n = t.num_rows
        sizes = np.diff(np.append(starts, n))
        if sizes.max() < 2:
            return None
        fp, tab = t.column(2).to_numpy().view(np.uint64), t.column(0).to_numpy()
        run = np.repeat(np.arange(len(starts)), sizes)
        short = (sizes <= 24)[run]
        a_all, b_all = [], []
        for d in range(1, min(24, int(sizes.max()))):
            i = np.flatnonzero((run[d:] == run[:-d]) & short[d:])
            if not len(i):
                continue
            x = fp[i] ^ fp[i + d]
            near = np.bitwise_count(x) <= radius
            i, x = i[near], x[near]
            first = tab[i].copy()
            for v in range(len(keep) - 2, -1, -1):
                first = np.where((x & keep[v]) == 0, np.minimum(first, v), first)
            i = i[first == tab[i]]
            a_all.append(fp[i])
            b_all.append(fp[i + d])
        for r in np.flatnonzero(sizes > 24):
            f = fp[starts[r] : starts[r] + sizes[r]]
            root = forest(np.bitwise_count(f[:, None] ^ f[None, :]) <= radius)
            a_all.append(f[root])
            b_all.append(f)
        a, b = (np.concatenate(x) if x else np.array([], np.uint64) for x in (a_all, b_all))
        return (a.view(np.int64), b.view(np.int64)) if len(a) else None

    def pair(left: pa.Table, right: pa.Table, width: int):
        x, y = (u.column(width + 3).to_numpy().view(np.uint64) for u in (left, right))
        f = np.unique(np.concatenate([x, y]))
        root = forest(np.bitwise_count(f[:, None] ^ f[None, :]) <= radius)
        return f[root].view(np.int64), f.view(np.int64)

    return in_buckets(rows, ["t", "k"], "a bigint, b bigint", small, pair).filter("a <> b").distinct()


def grouped(rows: DataFrame, id_col: str, links_of) -> DataFrame:
    """rows (id, fp) with component_id; links_of gives links (a, b) between values of fp, from one row each."""
    rows = salted(rows, F.col(id_col))
    groups = stage(fold(rows, ["fp"], {"_low": F.min(id_col)}, {"_low": F.min("_low")}), "fp-groups")
    linked = stage_only(lambda: components(links_of(groups)), "fp-linked")
    labelled = groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = stage(labelled.withColumn("component", F.coalesce("component", "fp")), "fp-components")
    members = salted(labelled.drop("_salts"), F.col("fp"))
    lows = fold(members, ["component"], {"component_id": F.min("_low")}, {"component_id": F.min("component_id")})
    ids = unfold(members, lows, ["component"]).select("fp", "component_id")
    return unfold(rows, groups.select("fp", "_salts").join(ids, "fp"), ["fp"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (smallest id reachable), fp.

    Texts with equal fingerprints are one node, so copies are never paired. Null and empty texts have fingerprint zero and
    link like any other. Null ids are passed over as component ids unless nothing else is in the component. An empty
    table gives no rows. Other columns of docs are not read.
    """
    out = grouped(stage(fingerprints(docs, id_col, text_col), "fingerprints"), id_col, lambda groups: fp_links(groups.select("fp"), radius))
    return out.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp")


# ---------------------------------------------------------------- similarity of shingle sets

#: Words of a shingle and the least Jaccard similarity of near copies.
SIMILAR_SHINGLE, SIMILARITY = 5, 0.8
#: Parts of a text, and shingles in each. At similarity 0.8 a part of 4 is equal with a chance of 0.41, and none of 24 with 3e-6.
PARTS, PART = 24, 4
#: Candidates differ in at most so many bits of two fingerprints: at similarity 0.8 it is 19.4 of 128 on average, with a
#: deviation of 4.1. Pairs nearer than NEAR are linked first where many texts share a part.
FAR, NEAR = 36, 20
#: Longer runs are first linked along a chain; only what it leaves apart is then compared, in blocks of so many sets.
SHORT, SET_BLOCK = 24, 512
#: Shingles of the sets that blocks hold; pairs with larger ones are verified one by one. Shingles that are counted together.
BLOCK_SHINGLES, COUNTED = 10_000, 4096
#: Keys of sets that are broadcast at once, and links that a task makes a forest of at a time.
KEYS, THIN = 1_000_000, 1 << 18
#: Bytes that one Arrow batch holds where sets of shingles are in it, and shingles that are counted at once.
SET_BYTES, AT_ONCE = 1 << 20, 8192
_DRAW = np.random.default_rng(42)
_MUL = _DRAW.integers(0, 1 << 63, PARTS, np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _DRAW.integers(0, 1 << 63, PARTS, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; a shorter text is one shingle, one without words none."""
    return np.unique(shingle_hashes(text or "", SIMILAR_SHINGLE))


def mixed(h: np.ndarray) -> np.ndarray:
    """Other 64 bits of a hash."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def set_key(hashes: np.ndarray) -> int:
    """One signed 64-bit integer a set: equal sets are one node."""
    return int(mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).view(np.int64))


def majority(hashes: np.ndarray) -> np.uint64:
    """SimHash of hashes, each counting once; zero for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        counts += np.unpackbits(hashes[at : at + AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.bitwise_or.reduce(np.where(2 * counts > len(hashes), np.uint64(1) << _BITS, np.uint64(0)))


def part_fingerprints(hashes: np.ndarray) -> np.ndarray:
    """SimHashes of PARTS samples of a set: in each, the PART shingles that come first in an order of its own, or all."""
    out = np.zeros(PARTS, np.uint64)
    for k in range(PARTS if len(hashes) else 0):
        order = (hashes ^ _XOR[k]) * _MUL[k]
        first = order if len(order) <= PART else np.partition(order, PART - 1)[:PART]
        ones = ((mixed(first)[:, None] >> _BITS) & np.uint64(1)).sum(axis=0, dtype=np.int64)
        out[k] = np.bitwise_or.reduce(np.where(2 * ones > len(first), np.uint64(1) << _BITS, np.uint64(0)))
    return out


def signatures(docs: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """(columns, fp, n, s0, s1, parts): the set's key and size, two SimHashes of the set, SimHashes of its parts.

    The sets are not among them, as they are longer than the texts: texts_sets makes those that are asked for again.
    """
    small_batches(docs.sparkSession, SET_BYTES)

    def rows_of(batch):
        sets = [shingle_set(t) for t in batch]
        parts = np.array([part_fingerprints(s) for s in sets], np.uint64).reshape(len(sets), PARTS)
        return {
            "fp": pa.array([set_key(s) for s in sets], pa.int64()),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "s0": pa.array(np.array([majority(s) for s in sets], np.uint64).view(np.int64)),
            "s1": pa.array(np.array([majority(mixed(s)) for s in sets], np.uint64).view(np.int64)),
            "parts": pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * PARTS, pa.int32()), pa.array(parts.ravel().view(np.int64))),
        }

    return over_text(docs, columns, text_col, "fp bigint, n bigint, s0 bigint, s1 bigint, parts array<bigint>", rows_of, size=SET_BYTES)


def _columns(t: pa.Table):
    """node, size, two fingerprints and component of the rows, behind the keys t and k."""
    return [t.column(i).to_numpy() for i in range(2, 7)]


def _apart(x, y) -> np.ndarray:
    """Bits that differ between rows x and y, or more than all where the sizes rule the similarity out."""
    far = np.bitwise_count((x[2] ^ y[2]).view(np.uint64)).astype(np.int16) + np.bitwise_count((x[3] ^ y[3]).view(np.uint64))
    return np.where(np.minimum(x[1], y[1]) >= SIMILARITY * np.maximum(x[1], y[1]), far, 129)


def _across(left, right, same: bool, all_pairs: bool):
    """Candidate pairs (a, b) between two blocks: all of unlike components, or for each right row the nearest left row before it."""
    far = _apart([c[:, None] for c in left], [c[None, :] for c in right])
    near = far <= (FAR if all_pairs else NEAR)
    if same:
        near &= np.tri(len(left[0]), k=-1, dtype=bool).T
    if all_pairs:
        i, j = np.nonzero(near & (left[4][:, None] != right[4][None, :]))
    else:
        j = np.flatnonzero(near.any(axis=0))
        i = len(near) - 1 - near[::-1, j].argmax(axis=0)
    return left[0][i], right[0][j]


def candidates(rows: DataFrame, all_pairs: bool) -> DataFrame:
    """Pairs (a, b) of nodes, a < b, that meet in a table and whose fingerprints are near.

    rows: t, k, node, n, s0, s1, component. Without all_pairs, runs of at most SHORT rows give all their pairs and longer
    ones chains; with it, longer runs give all pairs of unlike components.
    """

    def small(t: pa.Table, starts: np.ndarray):
        sizes = np.diff(np.append(starts, t.num_rows))
        cols = _columns(t)
        a_all, b_all = [], []
        run = np.repeat(np.arange(len(starts)), sizes)
        short = (sizes <= SHORT)[run]
        for d in range(1, 0 if all_pairs else min(SHORT, int(sizes.max()))):
            i = np.flatnonzero((run[d:] == run[:-d]) & short[d:])
            if len(i):
                i = i[_apart([c[i] for c in cols], [c[i + d] for c in cols]) <= FAR]
                a_all.append(cols[0][i])
                b_all.append(cols[0][i + d])
        for r in range(len(sizes)) if all_pairs else np.flatnonzero(sizes > SHORT):
            part = [c[starts[r] : starts[r] + sizes[r]] for c in cols]
            a, b = _across(part, part, True, all_pairs)
            a_all.append(a)
            b_all.append(b)
        a, b = (np.concatenate(x) if x else np.array([], np.int64) for x in (a_all, b_all))
        return (a, b) if len(a) else None

    def pair(left: pa.Table, right: pa.Table, width: int):
        cut = [[u.column(i).to_numpy() for i in (width + 3, *range(width + 4, width + 8))] for u in (left, right)]
        return _across(*cut, left is right, all_pairs)

    found = in_buckets(rows, ["t", "k"], "a bigint, b bigint", small, pair)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of x has in common with each set of y, COUNTED hashes at a time."""
    out = np.zeros((len(x), len(y)), np.float32)
    words = np.intersect1d(np.unique(np.concatenate(x)), np.unique(np.concatenate(y)), assume_unique=True)

    def entries(sets):
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(words, flat)
        held = np.flatnonzero(words[np.minimum(at, len(words) - 1)] == flat)
        held = held[np.argsort(at[held], kind="stable")]
        return at[held], row[held]

    if len(words):
        sides = [entries(x), entries(y)] if x is not y else [entries(x)]
        for lo in range(0, len(words), COUNTED):
            hot = []
            for (at, row), sets in zip(sides, (x, y), strict=False):
                a, b = np.searchsorted(at, [lo, lo + COUNTED])
                h = np.zeros((len(sets), min(COUNTED, len(words) - lo)), np.float32)
                h[row[a:b], at[a:b] - lo] = 1
                hot.append(h)
            out += hot[0] @ hot[-1].T
    return out


def block_links(rows: DataFrame, block: int) -> DataFrame:
    """Links (a, b) that connect all sets of at least SIMILARITY in runs of equal t and k, verified block by block.

    rows: t, k, node, n, s0, s1, component, hashes. Pairs of one component are not compared. A block gives a forest, so what
    leaves it grows with its members and not with its pairs.
    """

    def load(t: pa.Table, at: int):
        return [t.column(i).to_numpy() for i in range(at, at + 5)], t.column(at + 5)

    def take(side, rows):
        cols, sets = side
        return cols[0][rows], cols[1][rows], [np.frombuffer(sets[int(i)].as_py(), "<u8") for i in rows]

    def compare(x, y):
        far = _apart([c[:, None] for c in x[0]], [c[None, :] for c in y[0]])
        open_ = (far <= FAR) & (x[0][4][:, None] != y[0][4][None, :])
        i, j = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(i):
            return None
        nx, cx, sx = take(x, i)
        ny, cy, sy = (nx, cx, sx) if x is y else take(y, j)
        both = shared_counts(sx, sy)
        near = open_[np.ix_(i, j)] & (both >= SIMILARITY * (cx[:, None] + cy[None, :] - both))
        if not near.any():
            return None
        if x is y:
            return nx[forest(near | near.T)], nx
        n, ids = len(nx), np.concatenate([nx, ny])
        whole = np.zeros((len(ids), len(ids)), bool)
        whole[:n, n:], whole[n:, :n] = near, near.T
        return ids[forest(whole)], ids

    def small(t: pa.Table, starts: np.ndarray):
        found = []
        for s, e in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
            if e - s > 1:
                x = load(t.slice(s, e - s), 2)
                got = compare(x, x)
                if got is not None:
                    found.append(got)
        return [np.concatenate(c) for c in zip(*found, strict=True)] if found else None

    def pair(left: pa.Table, right: pa.Table, width: int):
        x = load(left, width + 3)
        return compare(x, x if left is right else load(right, width + 3))

    return in_buckets(rows, ["t", "k"], "a bigint, b bigint", small, pair, block).filter("a <> b").distinct()


def sets_of(sets: DataFrame, nodes: DataFrame, held: str = "hashes") -> DataFrame:
    """One row (fp, held) a node `fp`. Only keys travel to the sets, KEYS at a time and one reading of the sets for each, so sets
    that are not asked for are never shuffled."""
    nodes = stage(nodes.distinct(), "set-keys")
    share = max(1, -(-nodes.count() // KEYS))
    found = [sets.join(F.broadcast(nodes.filter(F.pmod(F.xxhash64("fp"), F.lit(share)) == i)), "fp", "left_semi") for i in range(share)]
    return reduce(DataFrame.unionByName, found).groupBy("fp").agg(F.first(held).alias(held))


def texts_sets(found: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, hashes) of the nodes `fp`, from the text of one row of each: found (fp, row), texts (row, text)."""
    rows = found.join(nodes.distinct(), "fp", "left_semi").groupBy("fp").agg(F.min("row").alias("row"))
    chosen = sets_of(texts.select(F.col("row").alias("fp"), "text"), rows.select(F.col("row").alias("fp")), "text")

    def rows_of(batch):
        sets = [shingle_set(t) for t in batch]
        return {"fp": pa.array([set_key(s) for s in sets], pa.int64()), "hashes": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())}

    return over_text(chosen, [], "text", "fp bigint, hashes binary", rows_of, size=SET_BYTES)


def thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect the same nodes: of THIN links that a task reads at a time, a forest.

    A near copy meets others in up to 55 tables. A forest has a link less than nodes, so what goes on to the components
    grows with the nodes and not with the tables in which they have met.
    """

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]))
            n += b.num_rows
            if n >= THIN:
                yield forest_of(np.concatenate(held, axis=1))
                held, n = [], 0
        if n:
            yield forest_of(np.concatenate(held, axis=1))

    def forest_of(ends):
        nodes, at = np.unique(ends, return_inverse=True)
        a, b = at.reshape(2, -1)
        label = np.arange(len(nodes))
        while True:
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            if np.array_equal(low, high):
                break
            np.minimum.at(label, high, low)
            while not np.array_equal(label[label], label):
                label = label[label]
        own = label != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[label[own]]), pa.array(nodes[own])], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, sets_for: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least SIMILARITY; sets_for gives the sets (fp, hashes) of nodes `fp`."""
    sets = stage_only(lambda: sets_for(pairs.select(F.explode(F.array("a", "b")).alias("fp"))), "candidate-sets")
    out = pairs
    for end, other in (("a", "b"), ("b", "a")):
        rows = salted(out, F.col(other))
        hubs = fold(rows, [end], {"_n": F.count(F.lit(1))}, {"_n": F.sum("_n")}).drop("_n")
        named = sets.select(F.col("fp").alias(end), F.col("hashes").alias(f"h_{end}"))
        out = unfold(rows, hubs.join(named, end), [end])

    def run(batches):
        for b in slices(batches, 256, SET_BYTES):
            x, y = ([np.frombuffer(v, "<u8") for v in b.column(b.schema.get_field_index(f"h_{e}")).to_pylist()] for e in "ab")
            both = np.array([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y, strict=True)], np.int64)
            union = np.array([len(p) + len(q) for p, q in zip(x, y, strict=True)], np.int64) - both
            yield b.select(["a", "b"]).filter(pa.array(both >= SIMILARITY * union))

    return out.select("a", "b", "h_a", "h_b").mapInArrow(run, "a bigint, b bigint")


def set_links(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all sets `fp` of at least SIMILARITY, directly or through others linked.

    found: row, and the signatures; texts: row, text.

    Tables 0 to 30 are the covering masks of the whole set's fingerprint, so that no pair within RADIUS bits is missed; the
    others hold the fingerprints of the parts, which meet if they are equal.
    """
    # one column a part: an array among the aggregates would be sorted, and kept in memory for that
    parts = [F.col("parts")[i].alias(f"p{i}") for i in range(PARTS)]
    nodes = found.filter("n > 0").select("fp", "n", "s0", "s1", *parts)
    nodes = nodes.groupBy("fp").agg(*[F.first(c).alias(c) for c in nodes.columns[1:]])
    keys = [F.col("s0").bitwiseAND(F.lit(_signed(m))) for m in masks()] + [F.col(f"p{i}") for i in range(PARTS)]
    rows = nodes.select(F.posexplode(F.array(*keys)).alias("t", "k"), F.col("fp").alias("node"), "n", "s0", "s1")
    sets_for = lambda asked: texts_sets(found.select("fp", "row"), texts, asked)
    first = rows.withColumn("component", F.col("node"))
    met = lambda: stage_only(lambda: candidates(first, False), "candidates")
    one = stage_only(lambda: thinned(stage_only(lambda: verified(met(), sets_for), "verified")), "links")
    big = stage(rows.groupBy("t", "k").count().filter(F.col("count") > SHORT).select("t", "k"), "long-runs")
    if big.isEmpty():
        return one
    again = stage_only(lambda: _long_rows(rows, big, one), "long-run-rows")
    # runs of one component hold nothing new
    split = again.groupBy("t", "k").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low <> _high").select("t", "k")
    again = again.join(split, ["t", "k"], "left_semi")
    blocked = again.filter(F.col("n") <= BLOCK_SHINGLES)
    def in_blocks():
        held = sets_for(blocked.select(F.col("node").alias("fp")))
        return block_links(blocked.join(held.withColumnRenamed("fp", "node"), "node").select(*blocked.columns, "hashes"), SET_BLOCK)

    out = one.unionByName(stage_only(in_blocks, "links"))
    wide = stage_only(lambda: candidates(again.filter(F.col("n") >= SIMILARITY * BLOCK_SHINGLES), True), "candidates")
    return out if wide.isEmpty() else out.unionByName(stage_only(lambda: verified(wide, sets_for), "links"))


def _long_rows(rows: DataFrame, big: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of long runs, with the component that the links so far give their nodes."""
    known = components(links).withColumnRenamed("component", "_c")
    again = rows.join(big, ["t", "k"], "left_semi").join(known, "node", "left")
    return again.select("t", "k", "node", "n", "s0", "s1", F.coalesce("_c", "node").alias("component"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, fp (key of the shingle set), component_id (smallest id reachable).

    Rows are read again for the sets that pairs ask for, so a table that is no plain Parquet read is written first. Two texts
    are linked if the Jaccard similarity of their five-word shingles (A-Z lower-cased, each counting once) is at
    least SIMILARITY. Texts of equal sets are one node; texts without words, null ones too, are one group. Null ids are
    passed over as component ids unless nothing else is in the component. An empty table gives no rows. Other columns of
    docs are not read.
    """
    return _similar(with_row_key(docs), id_col, text_col)


def _similar(keyed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """similar_documents of rows that have ROW_KEY."""
    rows = keyed.select(F.col(id_col).alias("id"), F.xxhash64(ROW_KEY).alias("row"), F.col(text_col).cast("string").alias("text"))
    found = stage(signatures(rows, ["id", "row"], "text"), "signatures")
    out = grouped(found.select("id", "fp"), "id", lambda groups: set_links(found, rows.select("row", "text")))
    return out.select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of similar_documents, with all its columns: that of the smallest id, null ids last. Of rows
    that repeat an id, each is judged by its own text; of those in one group, that of the smallest hashed text stays."""
    keyed = with_row_key(docs)
    text = keyed[text_col].cast("string")
    at = F.struct(keyed[id_col].isNull().alias("none"), keyed[id_col].alias("id"), F.xxhash64(text).alias("h"), keyed[ROW_KEY].alias("key"))

    def kept():
        found = _similar(keyed.select(at.alias("at"), text.alias("text"), ROW_KEY), "at", "text")
        return found.filter(F.col("at").eqNullSafe(F.col("component_id"))).select(F.col("at.key").alias(ROW_KEY))

    return keep_rows(keyed, stage_only(kept, "near"))
