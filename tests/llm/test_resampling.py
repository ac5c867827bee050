import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import resampling

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def features(text, orders):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, [" ".join(words[i : i + n]) for n in range(1, orders + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, buckets, orders, least, percent, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(bucket, features(x, orders)[1]))
    for x in target:
        t.update(map(bucket, features(x, orders)[1]))
    n, m = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets)))) for b in s}
    out = []
    for i, x in rows:
        words, found = features(x, orders)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], -r[2]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize(("orders", "percent", "buckets"), [(1, 10, 10_000), (2, 50, 97), (3, 100, 5)])
def test_equals_brute_force(spark, orders, percent, buckets):
    r = np.random.default_rng(orders)
    vocabulary = ["alpha", "Beta", "été", "日本", "x1", "ÉCOLE", "no break", "under_score", "d-e", "🙂"]
    rows = [(i, " ".join(r.choice(vocabulary, int(r.integers(0, 40))))) for i in range(300)]
    rows += [(None, "alpha " * 30), (None, None), (5, None), (6, ""), (7, rows[8][1]), (7, rows[8][1]), (9000, " \x00\t"), (9001, "beta " * 50_000)]
    target = ["Alpha beta", None, "", "日本 été " * 9]
    docs = spark.createDataFrame([(*x, "s", 1) for x in rows], "doc_id long, text string, score string, ids int").repartition(3)
    other = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs, other, buckets=buckets, orders=orders, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target, buckets, orders, 20, percent, 2024)


def test_edges(spark):
    docs = spark.createDataFrame([(i, "same words " * 15) for i in range(10)], "doc_id long, text string")
    other = spark.createDataFrame([], "item_id long, text string")
    got = resampling.resample(docs, other, percent=50).collect()
    assert sum(x.rank is not None for x in got) == 5 and len({x.weight for x in got}) == 1
    assert resampling.resample(docs.limit(0), other).count() == 0
    short = resampling.resample(docs.withColumn("text", F.lit("few words")), other).collect()
    assert len(short) == 10 and all(x.rank is None for x in short)


def test_matrix_rows_and_sums(spark):
    docs = spark.createDataFrame([(i, f"a{i % 3} b b c{i}") for i in range(50)], "doc_id long, text string")
    matrix = resampling.count_matrix(docs, block_rows=7)
    sums = resampling.column_sums(matrix)
    assert sums.sum() == 200 and sums[zlib.crc32(b"b") % 10_000] >= 100
    seen = 0
    for b in matrix.collect():
        edge, n = np.frombuffer(b.indptr, "<u8"), np.frombuffer(b.counts, "<u4")
        assert len(b.ids) == len(edge) - 1 <= 7 and edge[-1] == len(n) == len(b.indices) // 4
        seen += n.sum()
    assert seen == 200
