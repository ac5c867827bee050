import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from broadsheet.llm import exact_dedup, graph, simhash

WORDS = [f"w{i}" for i in range(300)]


def brute_fp(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, linked):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if linked(values[i], values[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(values))]


def docs_with_copies(seed=1, n=150):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        base = [r.choice(WORDS) for _ in range(r.choice([1, 3, 40, 200]))]
        out.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 4])):
            edited = list(base)
            for _ in range(r.choice([0, 1, 2])):
                edited[r.randrange(len(edited))] = r.choice(WORDS)
            out.append(" ".join(edited))
    out += [None, "", "  \t\n", "ÄB äb", "äB äb", "É", "x" * 100_000, " ".join(WORDS) * 200]
    r.shuffle(out)
    return out


def test_exact_dedup_matches_brute_force(spark):
    rows = [(i, t, "other") for i, t in enumerate(docs_with_copies())] + [(None, "lone", "x"), (3, None, "x"), (3, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = exact_dedup.DigestIndex(spark, buckets=3).deduplicate(df).collect()
    norm = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append(i)
    assert len(got) == len(rows)
    by = {hashlib.sha256(k.encode()).digest(): v for k, v in groups.items()}
    kept = 0
    for g in got:
        ids = by[bytes(g.digest)]
        assert g.group_size == len(ids)
        assert g.keep_id == max((x for x in ids if x is not None), default=None)
        assert not g.kept or g.doc_id == g.keep_id
        kept += g.kept
    assert kept == len(groups)


def test_index_persists_and_only_new_texts_stay(spark):
    index = exact_dedup.DigestIndex(spark, buckets=2)
    one = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string")
    assert {r.doc_id for r in index.deduplicate(one).collect() if r.kept} == {2, 3}
    reopened = exact_dedup.DigestIndex(spark, path=index.path, buckets=2)
    two = spark.createDataFrame([(9, "a"), (10, "c"), (11, "c")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in reopened.deduplicate(two).collect()}
    assert got == {9: (2, False, 1), 10: (11, False, 2), 11: (11, True, 2)}
    assert reopened.rows().count() == 3


def test_a_batch_sent_again_gets_the_same_decisions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, buckets=2)
    once = sorted(map(str, index.deduplicate(df).collect()))
    assert sorted(map(str, index.deduplicate(df).collect())) == once and index.rows().count() == 2
    named = exact_dedup.DigestIndex(spark, buckets=2)
    first = {r.doc_id for r in named.deduplicate(df, batch="monday").collect() if r.kept}
    assert first == {2, 3} and not any(r.kept for r in named.deduplicate(df, batch="tuesday").collect())


def test_index_is_opened_again_as_it_was_made(spark):
    index = exact_dedup.DigestIndex(spark, buckets=16)
    texts = [(i, f"text {i}") for i in range(300)]
    assert sum(r.kept for r in index.deduplicate(spark.createDataFrame(texts, "doc_id long, text string")).collect()) == 300
    index.close()
    with pytest.raises(ValueError, match="16 buckets"):
        exact_dedup.DigestIndex(spark, path=index.path, buckets=4)
    with pytest.raises(ValueError, match="type bigint"):
        exact_dedup.DigestIndex(spark, path=index.path, id_type="string")
    again = spark.createDataFrame([(i + 1000, t) for i, t in texts], "doc_id long, text string")
    assert not any(r.kept for r in exact_dedup.DigestIndex(spark, path=index.path).deduplicate(again).collect())


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (1, "B", 7), (2, "b", 6)], "doc_id long, text string, kept int")
    got = sorted(map(tuple, exact_dedup.drop_copies(df).collect()))
    assert got == [(1, "a", 5), (2, "b", 6)]
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0


def test_fingerprint_is_as_specified():
    for t in ["", " ", "a", "A b c d e", "é É ABC\x0bx\x1cy z", "la la la la la la", "w " * 9000]:
        assert simhash.fingerprint(t) == brute_fp(t)


def test_masks_cover_every_pair_within_the_radius():
    cover, r = simhash.masks(), random.Random(0)
    assert len(cover) == 31
    for _ in range(3000):
        diff = sum(1 << b for b in r.sample(range(64), r.randint(1, 4)))
        assert any(m & diff == 0 for m in cover)


@pytest.mark.parametrize("block", [1024, 8])
def test_near_duplicates_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(graph.in_buckets, "__defaults__", (block,))
    texts = docs_with_copies(seed=block)
    fps = [brute_fp(t) for t in texts]
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    df = spark.createDataFrame([Row(doc_id=i, text=t, fp="x", component_id=1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id int")
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [int(got[i].fingerprint, 16) for i in range(len(texts))] == fps
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1000, 5])
def test_a_dense_cluster_of_fingerprints_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(graph.in_buckets, "__defaults__", (block,))
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(40)}
    for c in list(fps)[:3]:
        for _ in range(60):
            fps.add(c ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    fps = sorted(fps)
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = [(int(np.int64(x.a).view(np.uint64)), int(np.int64(x.b).view(np.uint64))) for x in simhash.fp_links(df).collect()]
    at = {f: i for i, f in enumerate(fps)}
    joined = {frozenset((at[a], at[b])) for a, b in links}
    assert brute_components(range(len(fps)), lambda i, j: frozenset((i, j)) in joined) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(300, 420)] + [(7, 7), (900, 899)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(300, 420)} | {got[5]} == {5}
    assert got[900] == got[899] == 899
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
