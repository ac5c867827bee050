"""Features of texts in bulk: hashed terms, and counts of character pairs by class; and bounded labelled samples."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import stage, unstage

HASH_BITS = 20
_WORD = re.compile(r"\w+")


# ---------------------------------------------------------------- samples


#: Bytes of sampled texts that the driver holds for each label.
SAMPLE_BYTES = 48 << 20


def longest(docs: DataFrame, id_col: str, text_col: str, *also: Column) -> DataFrame:
    """One row an id: _id, _n (bytes), _k (hash) of its longest text, of equally long ones that of the largest hash, and the
    row's `also`. Rows with null ids or texts are left out. No text is shuffled."""
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].alias("_id"), F.octet_length(text).alias("_n"), F.xxhash64(text).alias("_k"), *also).filter("_id is not null and _n is not null")
    rest = rows.columns[1:]
    return rows.groupBy("_id").agg(F.max(F.struct(*rest)).alias("_r")).select("_id", *[f"_r.{c}" for c in rest])


def sample_rows(keys: DataFrame, docs: DataFrame, per_class: dict, most_bytes: int, id_col: str, text_col: str) -> DataFrame | None:
    """Rows (_y, _id, _t) of at most per_class[value] documents and most_bytes bytes for each value of _y, in the order of
    hashed ids; nothing where there are none.

    keys are rows of longest() with a label _y. A document that the bytes left have no room for is passed over. There is one
    text for each id, however often it repeats. Hashes are counted by label and range first, in ranges a fourth of a power of
    two wide, so no task ranks a label's rows, and about the sample's own number of keys reaches the driver, or all of a
    label that has no more. The picked keys, at most per_class of each label, are broadcast to the texts.
    """
    most = max(per_class.values(), default=0)
    share = F.greatest((F.col("_h").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64), F.lit(2.0**-60))
    hashed = keys.withColumn("_h", F.xxhash64(F.col("_id").cast("string"))).withColumn("_range", F.floor(4 * F.log2(share)))
    hashed = stage(hashed, "sample-keys")
    ends, seen = {}, dict.fromkeys(per_class, 0)
    for r in hashed.groupBy("_y", "_range").count().orderBy("_y", "_range").collect():
        if seen.get(r["_y"], most) < most:
            ends[r["_y"]] = r["_range"]
            seen[r["_y"]] += r["count"]
    picked, left, taken, rank = [], dict.fromkeys(per_class, most_bytes), dict.fromkeys(per_class, 0), dict.fromkeys(per_class, 0)
    if ends:
        end = F.create_map(*[F.lit(x) for pair in ends.items() for x in pair])
        low = hashed.filter(F.col("_range") <= F.try_element_at(end, F.col("_y"))).collect()
        for r in sorted(low, key=lambda r: (r["_y"], r["_h"], r["_id"])):
            y = r["_y"]
            rank[y] += 1
            if rank[y] <= most and taken[y] < per_class[y] and r["_n"] <= left[y]:
                left[y] -= r["_n"]
                taken[y] += 1
                picked.append((r["_id"], r["_k"], y))
    unstage(hashed)
    if not picked:
        return None
    chosen = docs.sparkSession.createDataFrame(picked, hashed.select("_id", "_k", "_y").schema)
    text = docs[text_col].cast("string")
    found = docs.select(docs[id_col].alias("_id"), F.xxhash64(text).alias("_k"), text.alias("_t")).join(F.broadcast(chosen), ["_id", "_k"])
    return found.groupBy("_y", "_id", "_k").agg(F.min("_t").alias("_t")).select("_y", "_id", "_t")


def sampled(keys: DataFrame, docs: DataFrame, per_class: dict, most_bytes: int, id_col: str, text_col: str) -> list[tuple[object, str]]:
    """(label, text) of sample_rows(), on the driver, in the order of ids."""
    rows = sample_rows(keys, docs, per_class, most_bytes, id_col, text_col)
    return [(r["_y"], r["_t"]) for r in sorted(rows.collect(), key=lambda r: r["_id"])] if rows is not None else []


def labelled_keys(docs: DataFrame, labels: DataFrame, rows, label: Column, id_col: str, text_col: str) -> DataFrame:
    """longest() of the documents that have a label, with it as _y.

    labels and docs are joined on the id, `rows(id column)` says which may be learned from. Of labels that repeat an id the
    largest counts, of documents the longest; null ids, labels and texts are left out.
    """
    one = labels.select(F.col(id_col).alias("_id"), label.alias("_y")).filter("_id is not null and _y is not null")
    one = one.filter(rows(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
    return longest(docs, id_col, text_col).join(one, "_id")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows, label: Column, per_class: dict, id_col: str = "doc_id", text_col: str = "text", most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, object]]:
    """(text, label) of at most per_class[value] documents and most_bytes bytes for each value of `label`, as sampled() picks
    from labelled_keys(). Without any the sample is empty."""
    return [(t, y) for y, t in sampled(labelled_keys(docs, labels, rows, label, id_col, text_col), docs, per_class, most_bytes, id_col, text_col)]


# ---------------------------------------------------------------- terms


def chunks(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct white-space chunks, index of each chunk of each text, where each text's chunks begin and end)."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(column, "")))
    coded = split.flatten().dictionary_encode()
    edge = np.asarray(split.offsets) - split.offsets[0].as_py()
    if not len(coded.dictionary):
        return [], np.empty(0, np.int32), edge
    line = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "\x00")[0].as_py()
    words = line.split("\x00") if line.count("\x00") == len(coded.dictionary) - 1 else coded.dictionary.to_pylist()
    return words, coded.indices.to_numpy(), edge


#: Lengths of the beginnings that count as terms beside whole words.
BEGINNINGS = (4, 5, 6)


def _slot(term: str) -> int:
    return xxhash.xxh32_intdigest(term.encode("utf-8", "replace")) >> (32 - HASH_BITS)


class HashedTerms:
    """Which hashed terms each text of a column holds: words, and their beginnings of four to six letters, which inflected
    and compound words share. Terms are slots of 2^HASH_BITS, or places among `selected` ones."""

    def __init__(self, selected: np.ndarray | None):
        self.place = None if selected is None else {int(s): i for i, s in enumerate(selected)}
        self.beginnings: dict[str, tuple[int, ...]] = {}

    def _of(self, slots) -> tuple[int, ...]:
        return tuple(slots) if self.place is None else tuple(self.place[s] for s in slots if s in self.place)

    def _terms(self, chunk: str) -> tuple[int, ...]:
        """Terms of a chunk. Beginnings repeat over many words, so they are remembered; there are few of them."""
        out: tuple[int, ...] = ()
        for w in (chunk,) if chunk.isalpha() else _WORD.findall(chunk):
            head = w[: BEGINNINGS[-1]]
            got = self.beginnings.get(head)
            if got is None:
                if len(self.beginnings) > 200_000:
                    self.beginnings.clear()
                got = self.beginnings[head] = self._of({_slot(f"{n}:{head[:n]}") for n in BEGINNINGS if len(head) >= n})
            slot = xxhash.xxh32_intdigest(w.encode("utf-8", "replace")) >> (32 - HASH_BITS)
            if self.place is None:
                out += (slot, *got)
            elif got or slot in self.place:
                out += (*got, self.place[slot]) if slot in self.place else got
        return out

    def sets(self, column: pa.Array) -> list[np.ndarray]:
        words, index, edge = chunks(column)
        terms = [self._terms(w) for w in words]
        if self.place is None:
            return [np.unique(np.array([t for i in np.unique(index[a:b]) for t in terms[i]], np.int64)) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        hits = np.flatnonzero(np.array([bool(t) for t in terms], bool)[index]) if len(index) else np.empty(0, np.int64)
        cuts = np.searchsorted(hits, edge)
        return [np.array(sorted({t for i in set(index[hits[a:b]].tolist()) for t in terms[i]}), np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def count_terms(sets, classes: np.ndarray, n: int) -> np.ndarray:
    """In how many sets of each of n classes every slot is; sets are read once, one at a time."""
    out = np.zeros((n, 1 << HASH_BITS), np.int32)
    for s, k in zip(sets, classes, strict=True):
        out[k, s] += 1
    return out


def telling_terms(c1: np.ndarray, c0: np.ndarray, n1: float, n0: float, most: int, least: float) -> np.ndarray:
    """Slots whose presence tells most about a 0/1 label by the G-test, at most `most`, each with G of at least `least`.

    c1 and c0 count the rows of each label with a slot, n1 and n0 all rows of each.
    """
    slots = np.flatnonzero(c1 + c0)
    c1, c0 = c1[slots].astype(float), c0[slots].astype(float)
    n, c = n1 + n0, c1 + c0

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    g = 2 * (part(c1, c * n1 / n) + part(c0, c * n0 / n) + part(n1 - c1, (n - c) * n1 / n) + part(n0 - c0, (n - c) * n0 / n))
    best = np.argsort(-g, kind="stable")[:most]
    return np.sort(slots[best[g[best] >= least]])


def select_terms(sets: list[np.ndarray], y: np.ndarray, most: int, least: float) -> np.ndarray:
    """telling_terms() of sets with 0/1 labels."""
    c0, c1 = count_terms(sets, (np.asarray(y) > 0).astype(int), 2)
    return telling_terms(c1, c0, float(y.sum()), float(len(y) - y.sum()), most, least)


def few_at_once(batch: list[str], rows: int = 128, chars: int = 1 << 17):
    """Slices of texts of at most `rows` and `chars` characters, at least one text each."""
    start = held = 0
    for i, t in enumerate(batch):
        if i > start and (i - start >= rows or held + len(t) > chars):
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if start < len(batch):
        yield slice(start, len(batch))


# ---------------------------------------------------------------- character pairs

#: Classes of characters: lower, upper, digit, space, line end, stop, shout, bar, symbol, quote, other letter, other.
CLASSES = 12


def _class_table() -> np.ndarray:
    out = np.full(0x250, 11, np.uint8)
    for i in range(0x250):
        c = chr(i)
        out[i] = (
            4 if c in "\n\r" else 3 if c.isspace() else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit()
            else 5 if c in ".,;:" else 6 if c in "!?" else 7 if c in "|<>{}[]\\/" else 8 if c in "#$%&*+=@^_~`" else 9 if c in "\"'()-" else 10 if c.isalpha() else 11
        )
    return out


_TABLE = _class_table()


def passages(batch: list[str], chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of class-pair counts for each passage, number of passages of each text).

    A passage is `chars` code points of a text, the last what is left; every text has at least one. A pair is a character's
    class with that of the one before it, in the same text or a space.
    """
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in batch]
    length = np.array([len(c) for c in codes], np.int64)
    count = np.maximum(1, -(-length // chars))
    first = np.cumsum(count) - count
    flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
    kind = np.where(flat < 0x250, _TABLE[np.minimum(flat, 0x24F)], np.uint8(10)).astype(np.int64)
    start = np.cumsum(length) - length
    before = np.empty_like(kind)
    if len(kind):
        before[1:] = kind[:-1]
        before[start[length > 0]] = 3
    within = np.arange(len(flat)) - np.repeat(start, length)
    row = np.repeat(first, length) + within // chars
    pairs = CLASSES * CLASSES
    total = int(count.sum())
    out = np.bincount(row * pairs + before * CLASSES + kind, minlength=total * pairs).reshape(total, pairs)
    return out.astype(np.float32), count
