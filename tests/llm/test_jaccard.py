import random

import numpy as np
import pytest

from broadsheet.llm import graph, simhash
from tests.llm.test_dedup import brute_components

WORDS = [f"w{i}" for i in range(3000)]


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else frozenset()


def alike(a, b):
    return (not a and not b) or 5 * len(a & b) >= 4 * len(a | b)


def edited(r, base, edits):
    out = list(base)
    for at in r.sample(range(len(out)), edits):
        out[at] = r.choice(WORDS)
    return " ".join(out)


def test_pipeline_stage_drops_copies_of_similarity_0_8(spark):
    import corpus_pipeline as pipeline

    r = random.Random(2)
    texts = []
    for _ in range(60):
        base = [r.choice(WORDS) for _ in range(120)]
        texts += [" ".join(base), edited(r, base, 2)]
    sets = [shingles(t) for t in texts]
    pairs = [i for i in range(0, 120, 2) if alike(sets[i], sets[i + 1])]
    far = [i for i in pairs if (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[i + 1])).bit_count() > 4]
    assert len(pairs) > 50 and len(far) > 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {x.doc_id for x in pipeline.near_copies(spark, df, "").collect()}
    assert kept == set(range(120)) - {i + 1 for i in pairs}


@pytest.mark.parametrize("block", [1024, 32])
def test_components_equal_brute_force_in_long_runs(spark, monkeypatch, block):
    monkeypatch.setattr(graph.in_buckets, "__defaults__", (block,))
    monkeypatch.setattr(simhash, "SET_BLOCK", block)
    if block < 100:  # both ways of verifying, each for a part of the sets
        monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 180)
        monkeypatch.setattr(simhash, "COUNTED", 100)
    r = random.Random(block)
    texts = [None, "", " \t", "One", "one", "a b c", "A b  c"]
    for copies, words in ((90, 200), (40, 190), (30, 150), (3, 200)):
        base = [r.choice(WORDS) for _ in range(words)]
        texts += [edited(r, base, r.choice([0, 2, 4, 9, 14])) for _ in range(copies)]
    r.shuffle(texts)
    want = brute_components([shingles(t) for t in texts], alike)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    assert [x.component_id for x in sorted(simhash.similar_documents(df).collect())] == want
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == sorted(set(want))
    assert simhash.similar_documents(df.limit(0)).count() == 0


def test_repeated_ids_keep_one_row(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "A b c d e f"), (None, "x y"), (2, "q")], "doc_id long, text string")
    assert sorted((str(x.doc_id), x.text.lower()) for x in simhash.drop_near_copies(df).collect()) == [("1", "a b c d e f"), ("2", "q"), ("None", "x y")]


def test_unrelated_texts_of_one_id_all_stay(spark):
    rows = [(5, "one two three four five six"), (5, "seven eight nine ten eleven twelve"), (6, "a b c d e f g"), (7, "One two three four five six")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.text for x in simhash.drop_near_copies(df).collect()) == sorted(t for _, t in rows[:3])


def test_parts_of_equal_sets_are_equal_and_short_sets_have_all(spark):
    a = simhash.shingle_set("a b c d e f")
    assert len(a) == 2 and (simhash.part_fingerprints(a) == simhash.part_fingerprints(a[::-1].copy())).all()
    assert not simhash.part_fingerprints(simhash.shingle_set("")).any() and simhash.majority(simhash.shingle_set(None)) == 0
    long = simhash.shingle_set(" ".join(f"w{i}" for i in range(30000)))
    counts = ((long[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
    assert int(simhash.majority(long)) == sum(1 << i for i, c in enumerate(counts) if 2 * c > len(long))


def test_shared_counts_equal_intersections():
    r = np.random.default_rng(3)
    x, y = ([np.unique(r.integers(0, 300, k).astype(np.uint64)) for k in r.integers(1, 90, 20)] for _ in range(2))
    for p, q in ((x, y), (x, x), (x[:1], [np.array([10**6], np.uint64)])):
        assert simhash.shared_counts(p, q).tolist() == [[len(np.intersect1d(a, b)) for b in q] for a in p]


def test_sets_that_no_pair_asks_for_are_not_shuffled(spark, monkeypatch):
    sets = spark.createDataFrame([(i // 2, bytes([i // 2])) for i in range(40)], "fp long, hashes binary")
    nodes = spark.createDataFrame([(i,) for i in (3, 3, 5, 8, 13, 99)], "fp long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keys in (2, 1_000_000):
            monkeypatch.setattr(simhash, "KEYS", keys)
            got = simhash.sets_of(sets, nodes)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
            assert sorted((r.fp, bytes(r.hashes)) for r in got.collect()) == [(i, bytes([i])) for i in (3, 5, 8, 13)]
        assert simhash.sets_of(sets, nodes.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sets_are_not_stored_and_links_are_thinned(spark, monkeypatch):
    """Signatures hold no sets, which are longer than the texts; what goes on to the components grows with the nodes."""
    stored, linked = {}, []
    stage, components = simhash.stage, simhash.components
    monkeypatch.setattr(simhash, "stage", lambda df, what: stored.setdefault(what, df.columns) and stage(df, what))
    monkeypatch.setattr(simhash, "components", lambda links: linked.append((links.count(), len({x for r in links.collect() for x in r}))) or components(links))
    r = random.Random(9)
    base = [r.choice(WORDS) for _ in range(150)]
    texts = [edited(r, base, r.choice([1, 2, 3])) for _ in range(250)]
    want = brute_components([shingles(t) for t in texts], alike)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [x.component_id for x in sorted(simhash.similar_documents(df).collect())] == want
    assert "hashes" not in stored["signatures"] and linked
    assert all(links <= 5 * nodes for links, nodes in linked), linked


def test_thinned_links_connect_the_same_nodes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "THIN", 60)
    r = np.random.default_rng(4)
    pairs = sorted({(int(x), int(y)) for x, y in r.integers(-90, 90, (300, 2)) if x != y and (x + y) % 7})
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    plain = lambda df: sorted(map(tuple, graph.components(df).collect()))
    got = simhash.thinned(links)
    assert plain(got) == plain(links) and got.count() < len(pairs)
    assert simhash.thinned(links.limit(0)).count() == 0
