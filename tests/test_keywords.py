import math
import random
from collections import Counter

from broadsheet.operators import keywords


def brute(rows, features, least):
    tf = Counter()
    for i, c, text in rows:
        w = (text or "").lower().split()
        tf.update((i, c, t) for t in [*w, *map(" ".join, zip(w, w[1:], strict=False))])
    df, total = Counter(t for _, _, t in tf), Counter()
    for (_, _, t), n in tf.items():
        total[t] += n
    known = sorted((t for t in df if df[t] >= least), key=lambda t: (-total[t], t))[:features]
    raw = {k: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df[k[2]])) + 1) for k, n in tf.items() if k[2] in known}
    norm = Counter()
    for k, w in raw.items():
        norm[k[0]] += w * w
    return {k: round(w / math.sqrt(norm[k[0]]), 9) for k, w in raw.items()}


def test_weights_of_the_first_terms_by_total(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    words = ["aa", "ab", "ba", "bb", "cc", "dd", "ee", "zz"]
    rows = [(i // 2, "x" if i % 3 else "y", " ".join(rng.choices(words, [8, 5, 4, 3, 2, 1, 1, 9], k=rng.randint(0, 12)))) for i in range(40)] + [(90, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, cluster string, text string")
    held = keywords.TermCounts(spark, str(tmp_path / "counts"))
    for features in (1, 3, 7, 12, 30, 500):
        for second in (0, 50_000):  # ties of second words are let in either way
            monkeypatch.setattr(keywords, "SECOND", second)
            got = {(r.doc_id, r.cluster, r.term): round(r.weight, 9) for r in keywords.weights(docs, features, 2).collect()}
            assert got == brute(rows, features, 2)
    # a document is one row of a slice there, so with one cluster a document both ways agree
    one = docs.withColumn("cluster", docs.doc_id.cast("string"))
    held.put(one.withColumn("slice", docs.doc_id % 3), ["0", "1", "2"])
    plain = lambda df: sorted((r.doc_id, r.term, round(r.weight, 9)) for r in df.collect())
    for features in (3, 12, 500):
        assert plain(keywords.weights(one, features, 2, held.rows())) == plain(keywords.weights(one, features, 2))


def test_weights_are_made_within_the_row_of_a_document(spark):
    docs = spark.createDataFrame([(1, "x", "aa bb aa"), (2, "x", "aa bb")], "doc_id long, cluster string, text string")
    plan = keywords.weights(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Generate" not in plan


def test_a_word_alone_sends_no_pairs_of_rare_words(spark):
    docs = keywords.whole(spark.createDataFrame([(1, "x", "aa bb cc dd"), (2, "x", "aa bb")], "doc_id long, cluster string, text string"))
    asked = []

    def pairs(a, b):
        asked.append((a, b))
        return keywords.counted(docs, lambda w: keywords._pairs(w, a, b))

    assert keywords.vocabulary(keywords.counted(docs, lambda w: w), pairs, 10, 2) == {"aa": 2, "aa bb": 2, "bb": 2}
    assert asked == [({"aa", "bb"}, {"aa", "bb"})]
