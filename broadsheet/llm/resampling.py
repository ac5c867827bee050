"""Importance resampling towards a target distribution, over a stored sparse matrix of documents by hashed n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import slices, small_batches, stage

#: Buckets that features are hashed to, longest run of words that is a feature, and least words of a document to be drawn.
BUCKETS, ORDERS, LEAST_WORDS = 10_000, 1, 20
#: Per cent of the documents with enough words that are drawn, and the seed of the draw.
PERCENT, SEED = 10, 2024
#: Features whose buckets a worker remembers.
KNOWN = 400_000
#: Documents of a block of the matrix.
BLOCK_ROWS = 512

#: Lower-cases A-Z, keeps a-z, 0-9 and every byte of a character beyond ASCII; all else parts words.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_BYTES).split()


class Hashed(dict):
    """Buckets of features, remembered up to KNOWN features."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        out = self[feature] = zlib.crc32(feature) % self.buckets
        return out

    def row(self, words: list[bytes], orders: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(buckets in order, counts, features) of a document."""
        found = [self[w] for w in words]
        for n in range(2, orders + 1):
            found += [self[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
        at, counts = np.unique(np.array(found, np.uint32), return_counts=True)
        return at, counts.astype(np.uint32), len(found)


def count_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, orders: int = ORDERS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Documents by buckets as CSR blocks, written to the shared folder: ids, words, indptr, indices, counts.

    A block holds up to block_rows whole documents of one Arrow batch: `ids` in their order, `words` how many each has,
    and row i has counts[indptr[i]:indptr[i + 1]] in the buckets indices[indptr[i]:indptr[i + 1]] (little-endian unsigned
    64, 32 and 32 bits). Null and empty texts are empty rows; ids may be null or repeat. Nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").cast("binary").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hashed = Hashed(buckets)
        for b in slices(batches, block_rows):
            words, indptr, indices, counts = [], [0], [], []
            for i in range(b.num_rows):
                text = words_of(b.column(1)[i].as_py() or b"")
                at, n, _ = hashed.row(text, orders)
                words.append(len(text))
                indptr.append(indptr[-1] + len(at))
                indices.append(at)
                counts.append(n)
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(0))
            sizes = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), pa.array(words, pa.int64()))
            raw = [np.array(indptr, "<u8").tobytes(), np.concatenate(indices).astype("<u4").tobytes(), np.concatenate(counts).astype("<u4").tobytes()]
            yield pa.RecordBatch.from_arrays([ids, sizes, *[pa.array([x], pa.binary()) for x in raw]], names=["ids", "words", "indptr", "indices", "counts"])

    return stage(narrow.mapInArrow(run, f"ids array<{kind}>, words array<bigint>, indptr binary, indices binary, counts binary"), "count-matrix")


def _blocks(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(b.column(c)[i] for c in columns)


def column_sums(matrix: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The matrix's sum by bucket. A task sends one row a bucket, and `buckets` numbers reach the driver."""

    def run(batches):
        out = np.zeros(buckets, np.int64)
        for at, n in _blocks(batches, 0, 1):
            np.add.at(out, np.frombuffer(at.as_py(), "<u4"), np.frombuffer(n.as_py(), "<u4").astype(np.int64))
        k = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(out[k])], names=["bucket", "n"])

    sums = np.zeros(buckets, np.int64)
    for r in matrix.select("indices", "counts").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        sums[r.bucket] = r.n
    return sums


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of a bucket's share in the target against its share in the raw data, each count one more than it is."""
    k = float(len(raw))
    s_all, t_all = float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + k) / ((float(s) + 1) * (t_all + k)))) for s, t in zip(raw, target, strict=True)], np.int64)


def weights(matrix: DataFrame, gain: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight): the matrix's product with the gains, divided by a row's features, rounded down."""
    kind = matrix.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for ids, words, indptr, at, n in _blocks(batches, 0, 1, 2, 3, 4):
            edge = np.frombuffer(indptr.as_py(), "<u8").astype(np.int64)
            n = np.frombuffer(n.as_py(), "<u4").astype(np.int64)
            running = lambda x: np.append(0, np.cumsum(x))[edge]
            features = np.diff(running(n))
            total = np.diff(running(n * gain[np.frombuffer(at.as_py(), "<u4")]))
            mean = np.floor_divide(total, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays([ids.values, words.values, pa.array(features), pa.array(mean)], names=[id_col, "n_words", "n_features", "weight"])

    return matrix.mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel number) drawn from the id: the largest of weight plus this is a draw by weight."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def ranked(scored: DataFrame, can_be_drawn: Column, percent: int = PERCENT, id_col: str = "doc_id") -> DataFrame:
    """scored with rank: 1, 2, ... for the floor(percent / 100) of the rows that can be drawn with the highest scores; else null.

    Ties go to smaller ids, null ids last; rows that repeat an id come in the order of weight and features. scored must be a
    stored table with the integer column `score`. Scores are counted first (one row a value, whose number the spread of
    weights bounds), so that only rows of the last score drawn or above are sorted, by ranges; ranges are numbered by their
    sums, and no task sees all rows.
    """
    able = scored.filter(can_be_drawn)
    counts = able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("score").desc()).collect()
    drawn = percent * sum(r.n for r in counts) // 100
    seen, cut = 0, None
    for r in counts:
        if seen >= drawn:
            break
        seen, cut = seen + r.n, r.score
    none = F.lit(None).cast("bigint")
    if cut is None:
        return scored.withColumn("rank", none)
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    high = can_be_drawn & (F.col("score") >= cut)
    parts = max(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = stage(scored.filter(high).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "drawn")
    sizes = dict(dealt.groupBy("_part").count().collect())
    before, at = {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    first = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_part"))
    rank = first + F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    top = dealt.withColumn("rank", rank.cast("bigint")).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("_part")
    return top.unionByName(scored.filter(~F.coalesce(high, F.lit(False))).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", target_id: str = "item_id", buckets: int = BUCKETS, orders: int = ORDERS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per row of docs: id, n_words, n_features, weight, score, rank.

    Features are runs of 1 to `orders` words, hashed to buckets. A document's weight is the mean log ratio of its features'
    buckets in the target against docs, in thousandths, rounded down, and 0 without features; score adds a Gumbel number
    drawn from its id, and the `percent` per cent of documents of at least least_words words with the highest scores are
    drawn (ranks as in ranked()). Null and empty texts have no features and are not drawn; a null id draws as ''. An empty
    docs gives no rows, an empty target counts no feature. Other columns of either table are not read. Every whole text is
    read once; sums, weights and draws come from the stored matrix.
    """
    matrix = count_matrix(docs, id_col, text_col, buckets, orders)
    gain = gains(column_sums(matrix, buckets), column_sums(count_matrix(target, target_id, target_text, buckets, orders), buckets))
    scored = stage(weights(matrix, gain, id_col).withColumn("score", F.col("weight") + gumbel(F.col(id_col), seed)), "weights")
    return ranked(scored, F.col("n_words") >= least_words, percent, id_col)
