from datetime import date

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import clustering, collocations, entities, evaluation, explain, keywords, news, preprocess, requests

DAY = date(2024, 1, 5)


def counts(spark, rows):
    return spark.createDataFrame([("DE", d, e, w, c) for d, e, w, c in rows], "country_code string, collected_date date, canonical string, lemma string, c11 long")


def test_daily_marginals(spark):
    df = collocations.daily_association(counts(spark, [(DAY, "Trump", "tariff", 5), (DAY, "Trump", "meet", 3), (DAY, "Merkel", "meet", 2)]))
    got = {(r.canonical, r.lemma): (r.r, r.t, r.n) for r in df.collect()}
    assert got == {("Trump", "tariff"): (8, 5, 10), ("Trump", "meet"): (8, 5, 10), ("Merkel", "meet"): (2, 5, 10)}


def test_window_profile_sums_days_again(spark):
    days = [date(2024, 1, d) for d in (1, 3, 5)]
    df = counts(spark, [*[(d, "T", "tariff", c) for d, c in zip(days, (3, 5, 2), strict=True)], (DAY, "T", "meet", 6), (date(2023, 12, 1), "T", "tariff", 99)])
    p = collocations.profiles(df, "2024-01-05", (7, 30)).filter("window_days = 7").first()
    assert (p.coverage_days, p.total_cooccurrences) == (3, 16) and {c.lemma: c.c11 for c in p.top_collocates} == {"tariff": 10, "meet": 6}


def test_twenty_collocates_are_kept(spark):
    df = counts(spark, [(DAY, "T", f"w{i:02d}", 2 + i) for i in range(25)])
    assert len(collocations.profiles(df, "2024-01-05", (7,)).first().top_collocates) == 20


def test_frames(spark):
    lex = spark.createDataFrame([("economy", "economic"), ("war", "conflict"), ("war", "security")], "lemma string, frame string")
    top = lambda rows: spark.createDataFrame(rows, "k int, lemma string, llr double")
    got = {r.k: r for r in collocations.frame_intensities(top([(1, "economy", 30.0), (1, "war", 10.0), (2, "war", -5.0), (2, "economy", 10.0), (3, "war", 0.0), (4, "other", 5.0)]), lex, ["k"]).collect()}
    assert (got[1].economic, got[1].security, got[1].conflict) == (0.75, 0.25, 0.0) and got[2].economic == 1.0 and set(got) == {1, 2}


def test_window_is_within_the_sentence(spark):
    text = "Alpha beta Donald gamma. Delta omega " + "x " * 12 + "far"
    df = spark.createDataFrame([(1, "DE", DAY, text)], "id long, country_code string, collected_date date, text string")
    got = {(r.canonical, r.lemma) for r in collocations.token_windows(df).collect()}
    assert ("Donald", "gamma") in got and ("Donald", "delta") not in got and ("Delta", "omega") in got and ("Delta", "far") not in got


def test_drift_needs_enough_days(spark):
    rows = [("DE", date(2024, 1, d), "positive" if k % 2 else "negative", k) for d in range(1, 12) for k in range(60)]
    df = spark.createDataFrame(rows, "country_code string, collected_date date, sentiment_label string, k int")
    got = {r.collected_date.day: r for r in news.drift(df).collect()}
    assert got[7].status == "insufficient_data" and got[7].psi is None
    assert got[8].status == "ok" and got[8].psi == 0 and got[8].severity == "stable" and got[11].baseline_days == 10


def test_parse_quality(spark):
    rows = [("Good", "a", "parsed", 300), ("Good", "a", "parsed", 500), ("Bad", "b", "parsed", 100), ("Bad", "b", "empty", 0), ("Bad", None, None, 0)]
    df = spark.createDataFrame(rows, "source_name string, category string, parse_status string, article_chars int")
    got = {(r.source, r.category): r for r in news.parse_quality(df, 2, 60).collect()}
    assert got[(None, None)].coverage_pct == 80.0 and got[(None, None)].parsed_pct_fetched == 75.0
    assert got[("Bad", None)].needs_attention and not got[("Good", None)].needs_attention and got[("Good", None)].avg_chars == 400


def test_rescore_modes_exclude_one_another(spark):
    with pytest.raises(ValueError):
        news.to_rescore(spark.range(1), only_missing=True, only_stale=True)


def test_aliases_and_cache(spark):
    aliases = spark.createDataFrame([("DE", "PER", "Angela Merkel", "Angela Merkel", "Q567", 0), ("DE", "PER", "Merkel", "Angela Merkel", "Q567", 1), ("DE", "ORG", "Siemens AG", "Siemens", None, 2)], "country_code string, entity_type string, alias string, canonical string, wikidata_qid string, ordinal int")
    m = spark.createDataFrame([(1, "DE", "Kanzlerin MERKEL", "PER"), (2, "DE", "Merkel", "ORG"), (3, "DE", "siemens-ag", "LOC"), (4, "FR", "Merkel", "PER")], "mention_id int, country_code string, entity_text string, entity_type string")
    out = entities.canonicalize(m, aliases)
    got = {r.mention_id: (r.canonical, r.wikidata_qid, r.confidence, r.resolver_method) for r in out.collect()}
    assert got[1] == got[2] == ("Angela Merkel", "Q567", 1.0, "local_alias") and got[3] == ("Siemens", None, 1.0, "local_alias") and got[4] == ("Merkel", None, 0.0, "normalized")
    cache = spark.createDataFrame([("FR", "PER", "merkel", "Merkel (FR)", "Q9", 0.7)], "country_code string, entity_type string, normalized_text string, canonical string, wikidata_qid string, confidence double")
    got = {r.mention_id: r for r in entities.with_cache(out, cache).collect()}
    assert (got[4].canonical, got[4].resolver_method, got[1].resolver_method) == ("Merkel (FR)", "cache", "local_alias")


def test_metrics_and_gates(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "actual int, predicted int")
    m = evaluation.class_metrics(pairs, [0, 1, 2])
    got = {r.label: r for r in m.collect()}
    assert (got[0].precision, got[0].recall, got[1].f1, got[2].f1, got[0].accuracy) == (0.5, 0.5, 0.8, 0.0, 0.6) and got[0].macro_f1 == 0.4333
    assert not evaluation.gates(m).first().passed
    assert evaluation.agreement(pairs).first().agreement == 0.6 and evaluation.agreement(pairs.limit(0)).first().agreement == 0.0


def test_balance(spark):
    rows = spark.createDataFrame([(i, l) for i, l in enumerate([1, 1, 1, 2, 2, 0])], "id int, label int")
    got = evaluation.balanced(rows, "label", "id").groupBy("label").agg(F.sum("copies").alias("n")).collect()
    assert {r.label: r.n for r in got} == {0: 3, 1: 3, 2: 3}


def test_german_phrases(spark):
    ranked = spark.createDataFrame([(1, "sofa", 1), (1, "das sofa", 2), (1, "bett", 3)], "cluster int, term string, rank int")
    pairs = spark.createDataFrame([(1, "das sofa"), (1, "rotes sofa")], "cluster int, term string")
    assert {(r.term, r["rank"]) for r in keywords.german_phrases(ranked, pairs, ["das"]).collect()} == {("das sofa", 1), ("bett", 3)}


def test_kept_document_frequencies(spark, tmp_path):
    rows = [(1, "a", "red fox red", "d1"), (2, "a", "red hen", "d1"), (3, "b", "blue hen", "d2"), (4, "b", None, "d2"), (5, "b", "blue fox", "d3"), (5, "b", "blue fox", "d3")]
    docs = spark.createDataFrame(rows, "doc_id long, cluster string, text string, slice string").withColumn("df", F.lit("x"))
    held = keywords.TermCounts(spark, str(tmp_path / "counts"))
    assert held.rows().collect() == []
    for day in ("d1", "d2", "d3", "d2"):
        held.put(docs, [day])
    plain = lambda df: sorted((r.doc_id, r.term, round(r.weight, 9)) for r in df.collect())
    assert plain(keywords.weights(docs, least=1, counts=held.rows())) == plain(keywords.weights(docs, least=1)) != []
    day = docs.filter("slice = 'd2'")
    assert plain(keywords.weights(day, least=1, counts=held.rows())) == [x for x in plain(keywords.weights(docs, least=1)) if x[0] in (3, 4)]
    held.put(docs.filter("slice <> 'd3'"), ["d3"])
    assert plain(keywords.weights(docs.filter("slice <> 'd3'"), least=1, counts=held.rows())) == plain(keywords.weights(docs.filter("slice <> 'd3'"), least=1))


def test_kmeans_and_silhouette(spark):
    rows = spark.createDataFrame([(i, [float(i % 2) * 9 + 1, float(1 - i % 2) * 9 + 1 + i * 0.01]) for i in range(20)], "vec_id int, embedding array<double>")
    c = clustering.kmeans(rows, 2)
    assert c.select("cluster_id").distinct().count() == 2 and clustering.silhouette(rows, c) > 0.9
    assert clustering.silhouette(rows, c.withColumn("cluster_id", F.lit(-1))) == 0.0


def test_titles(spark):
    k = spark.createDataFrame([(1, "wahl", 1), (2, "berlin", 1)], "cluster_id int, term string, rank int")
    e = spark.createDataFrame([(1, "Merkel"), (1, "Merkel"), (1, "##rk"), (2, "Berlin"), (3, "Paris")], "cluster_id int, name string")
    assert {r.cluster_id: r.title for r in clustering.titles(k, e).collect()} == {1: "Wahl · Merkel", 2: "Berlin", 3: "Genel · Paris"}


def test_explanations_are_grounded(spark):
    profile = spark.createDataFrame([("DE", "Merkel", [("tariff", 2.5, 30.04), ("ghost", 1.0, 2.0)])], "country_code string, canonical string, top_collocates array<struct<lemma:string,pmi:double,llr:double>>")
    cand = spark.createDataFrame([("DE", "Merkel", 1, 0, "Merkel on a TARIFF deal"), ("DE", "Merkel", 2, 1, "Merkel and the tariff"), ("DE", "Merkel", 3, 2, "Nothing here")], "country_code string, canonical string, id int, rank int, text string")
    found = explain.evidence(cand, profile)
    assert [(r.snippet_id, r.id) for r in found.orderBy("snippet_id").collect()] == [("S1", 2), ("S2", 1), ("S3", 3)]
    c = explain.claims(profile, found).collect()
    assert len(c) == 1 and c[0].citations == ["S1", "S2"] and 'co-occurred with "tariff" (PMI=2.50, LLR=30.0)' in c[0].claim
    assert explain.sufficiency(found).first().sufficient


def test_all_texts_are_candidates(spark):
    """The oldest of 60 texts is the only one that holds a lemma; a lemma counts inside a word, as it does for one profile."""
    made = "country_code string, canonical string, top_collocates array<struct<lemma:string,pmi:double,llr:double>>"
    profile = spark.createDataFrame([("DE", "Merkel", [("tariff", 2.5, 30.04), ("zoll", 1.0, 2.0)]), ("DE", "Scholz", [("zoll", 1.0, 2.0)]), ("DE", "Nobody", [("zoll", 1.0, 2.0)]), ("FR", "Merkel", [("here", 1.0, 2.0)])], made)
    texts = [("DE", i, i, "Merkel was here") for i in range(59)] + [("DE", 59, 59, "Merkel on TARIFFS, Scholz on Zollfragen"), ("FR", 60, 0, "Merkel here"), ("DE", 61, 0, ""), ("DE", 62, 0, None)]
    articles = spark.createDataFrame(texts, "country_code string, id int, rank int, text string")
    found = entities.default_names(articles).join(articles, "id").select("country_code", F.col("entity_text").alias("canonical"), "id")
    got = explain.matches(found, articles, profile)
    assert got.count() == 62
    top = {(r.country_code, r.canonical): (r.id, r.matched) for r in explain.ranked(got).filter("snippet_id = 'S1'").collect()}
    assert top == {("DE", "Merkel"): (59, ["tariff", "zoll"]), ("DE", "Scholz"): (59, ["zoll"]), ("FR", "Merkel"): (60, ["here"])}
    one = explain.evidence(found.join(articles, ["country_code", "id"]), profile)
    rows = lambda df: sorted(map(tuple, df.select("country_code", "canonical", "snippet_id", "id", "matched").collect()))
    assert rows(explain.ranked(got)) == rows(one)


def test_lemmas_held_by_a_text():
    """As a plain search finds them: words, parts of longer words, with marks and spaces, other scripts, at a word's either end."""
    import itertools

    texts = ["the free-trade zone, freetrade! e-mail_x i\u0307stanbul köln/bonn 日本語\u00a0text", "", "aaa", "ab b", "x\ty\nz ab"]
    parts = {t[i:j] for t in texts for i, j in itertools.combinations(range(len(t) + 1), 2) if j - i < 12}
    lemmas = parts | {"zzz", "tradefree", "aaaa", "b a", "ba", "nba", "ab ab", "freetradee"}
    for t in texts:
        assert explain.held_by(t, lemmas) == {x for x in lemmas if x in t}


def test_default_names(spark):
    """The names of default_mentions, with marks, digits and other letters beside them, once a text."""
    texts = ["Berlin, Berlin und Ömer; Köln_ Xberlin berlin _Paris Paris2 PARis Pari Par Élodie's Straße\u0301 Ärztin\nBonn", "", None, "Wien " * 1500]
    a = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    old = entities.default_mentions(a).select("id", "entity_text").distinct()
    got = [tuple(r) for r in entities.default_names(a).collect()]
    assert len(got) == len(set(got)) and set(got) == {tuple(r) for r in old.collect()} and (0, "Élodie") in got and (3, "Wien") in got


def test_preprocess(spark):
    df = spark.createDataFrame([(1, "<b>The Title</b> is here", "and the rest of it", "2024-01-02T03:04:05Z"), (2, "kurz", "", None), (3, "Der Titel und die Lage", "nicht das", "not a date")], "id int, title string, summary string, published_date string")
    got = {r.id: r for r in preprocess.preprocess(df, "en", "2024-01-30 00:00:00").collect()}
    assert set(got) == {1, 3} and got[1].cleaned_title == "the title is here" and got[1].is_target_language and not got[3].is_target_language
    assert got[1].published_at.isoformat() == "2024-01-02T03:04:05" and got[3].published_at.isoformat() == "2024-01-30T00:00:00"


def test_scoring_provider(spark):
    df = spark.createDataFrame([(1, "great win"), (2, "war and crisis"), (3, None)], "id int, text string")
    got = {r.id: r for r in preprocess.scored(df, F.col("text"), target=F.col("id") < 3).collect()}
    assert (got[1].sentiment_label, got[2].sentiment_label, got[3].sentiment_label) == ("positive", "negative", None)
    assert got[1].calibrated_sentiment_score < got[1].raw_sentiment_score


def test_a_sentence_of_forty_thousand_words(spark):
    words = " ".join("Berlin" if i % 10 == 0 else f"word{i % 50}" for i in range(40_000))
    df = spark.createDataFrame([(i, "DE", words) for i in range(4)], "id long, country_code string, text string").withColumn("collected_date", F.lit("2024-01-01").cast("date"))
    pairs = collocations.token_windows(df)
    assert pairs.count() == 4 * sum(min(i, 10) + min(39_999 - i, 10) for i in range(0, 40_000, 10))


def test_requests():
    assert requests.checked_countries(" de,FR, de", {"DE", "FR"}) == ["DE", "FR"]
    for bad in (lambda: requests.checked_countries("xx", {"DE"}), lambda: requests.checked_countries("", {"DE"}), lambda: requests.checked_window(8)):
        with pytest.raises(ValueError):
            bad()
