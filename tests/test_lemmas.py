import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import lemmas
from broadsheet.operators.lemmas import CLOSED, ENDINGS, TAGS, SuffixTrie, viterbi


def test_longest_ending_that_leaves_a_stem():
    r = random.Random(1)
    for language, endings in ENDINGS.items():
        trie = SuffixTrie(endings)
        words = ["".join(r.choice("abcdeinsrtä") for _ in range(r.randint(0, 7))) + e for e in endings for _ in range(30)]
        for w in [*words, "", "a", "s", "ing"]:
            fit = [e for e in endings if w.endswith(e) and len(w) - len(e) >= 3]
            best = max(fit, key=len, default=None)
            assert trie.lemma(w) == (w if best is None else w[: len(w) - len(best)] + endings[best]), (language, w)
    en = SuffixTrie(ENDINGS["en"])
    assert [en.lemma(w) for w in ("cities", "classes", "reported", "news", "is", "bus")] == ["city", "class", "report", "new", "is", "bus"]


def test_viterbi_equals_brute_force():
    r = np.random.default_rng(2)
    k = 3
    lengths = np.array([3, 1, 5, 0, 2, 4, 5, 1])
    emissions, first, moves = (np.log(r.dirichlet(np.ones(k), n)) for n in (lengths.sum(), 1, k))
    got, at = viterbi(emissions, lengths, first[0], moves), 0
    for n in lengths:
        score = lambda path, at=at: first[0][path[0]] + sum(emissions[at + i][t] for i, t in enumerate(path)) + sum(moves[a][b] for a, b in itertools.pairwise(path))
        if n:
            assert tuple(got[at : at + n]) == max(itertools.product(range(k), repeat=int(n)), key=score)
        at += n
    assert len(viterbi(np.empty((0, k)), np.array([0, 0]), first[0], moves)) == 0


@pytest.fixture
def articles(spark):
    rows = [(i, "UK", f"2024-01-{i % 3 + 1:02d}", "The city of London reported large classes. He reported it quickly and Paris was running 12 tests.") for i in range(20)]
    rows += [(30, "FR", "2024-01-01", "Le chat de Marie est dans la maison. Les animaux et les journaux."), (31, None, "2024-01-01", "no country Here"), (32, "UK", "2024-01-01", None), (33, "UK", "2024-01-01", ""), (34, "DE", "2024-01-01", "x" * 5000 + " und " + "Wort " * 3000)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "id long, country_code string, collected_date string, text string, lemmas string")


def test_tags_are_fitted_from_counts(spark, articles):
    tokens = lemmas.tokens_of(articles)
    model = lemmas.fit_tags(tokens, rounds=2)
    rows = lemmas.tagged(tokens, model).collect()
    assert len(rows) == tokens.count()
    seen = {}
    for r in rows:
        assert len(r.words) == len(r.lemmas) == len(r.tags) and set(r.tags) <= set(TAGS)
        for w, lemma, t in zip(r.words, r.lemmas, r.tags, strict=True):
            seen.setdefault((r.language, w), set()).add((lemma, t))
            fixed = [tag for tag, ws in CLOSED.get(r.language, {}).items() if w.lower() in ws.split()]
            assert not fixed or t == fixed[0]
    assert seen["en", "London"] == {("london", "PROPN")} and seen["en", "classes"] == {("class", "NOUN")} and seen["en", "12"] == {("12", "NUM")}
    assert seen["en", "reported"] == {("report", "VERB")} and seen["fr", "animaux"] == {("animal", "NOUN")}
    few = lemmas.fit_tags(tokens, features=3)
    assert all(len(v) <= 3 for v in few.features.values())
    assert lemmas.fit_tags(tokens.limit(0)).features == {}


def test_first_counts_are_those_of_the_rules(spark, articles):
    tokens = lemmas.tokens_of(articles.filter("country_code = 'UK'"))
    model, counts = lemmas.fit_tags(tokens), Counter()
    for r in tokens.collect():
        tags = [lemmas.seed(w, i, "en") for i, w in enumerate(r.words)]
        counts.update(itertools.pairwise(tags))
    det = TAGS.index("DET")
    row = np.array([counts[det, t] for t in range(len(TAGS))]) + lemmas.SMOOTH
    assert np.allclose(model.moves["en"][det], np.log(row / row.sum()))


def test_windows_by_lemma_and_tag(spark, articles):
    tokens = lemmas.tokens_of(articles.filter("country_code = 'UK'"))
    tokens = lemmas.tagged(tokens, lemmas.fit_tags(tokens))
    got = {(r.canonical, r.lemma, r.pos): r.n for r in lemmas.lemma_windows(tokens, ["large"]).groupBy("canonical", "lemma", "pos").agg(F.count("*").alias("n")).collect()}
    assert got["London", "class", "NOUN"] == 20 and ("London", "large", "ADJ") not in got and not any(p in ("DET", "ADP") for *_, p in got)
    assert any(p == "DET" for *_, p in {(r.canonical, r.lemma, r.pos) for r in lemmas.lemma_windows(tokens, keep=None).collect()})
    assert all(r.c11 >= 2 for r in lemmas.lemma_counts(lemmas.lemma_windows(tokens)).collect())


def test_tagging_goes_by_different_words(spark, articles, monkeypatch):
    """Pieces, a step's two ways and a lexicon that forgets give the same rows; counts are those of the rows, and no word leaves
    a task of its own."""
    tokens = lemmas.tokens_of(articles)
    model = lemmas.fit_tags(tokens)
    rows = sorted(tuple(r) for r in lemmas.tagged(tokens, model).collect())
    told = Counter((r.language, x, t) for r in lemmas.tagged(tokens, model).collect() for x, t in zip(r.lemmas, r.tags, strict=True))
    counts = lemmas.tag_counts(tokens, model)
    assert {(r.language, r.lemma, r.pos): r.n for r in counts.collect()} == told
    assert "Generate explode(arrays_zip" not in counts._jdf.queryExecution().executedPlan().toString()
    b = tokens.select("language", "words").toArrow().combine_chunks().to_batches()[0]
    whole = {}
    for known, words, many in ((100_000, 1 << 18, 64), (3, 20, 1), (3, 20, 10**6)):
        for name, value in (("KNOWN", known), ("WORDS", words), ("MANY", many)):
            monkeypatch.setattr(lemmas, name, value)
        lexicon, got = lemmas.Lexicon(model), {}
        for k, p in lemmas.pieces(b):
            ends = np.cumsum(p.lengths)
            tags = lexicon.tags(k, p, lexicon.entries(k, p.words)).tolist()
            got |= {int(i): tags[e - n : e] for i, e, n in zip(p.rows, ends, p.lengths, strict=True)}
        whole = whole or got
        assert got == whole and len(got) == b.num_rows
    assert len(rows) == b.num_rows


def test_sentences_extract_words_once(spark):
    from broadsheet.operators.collocations import sentences

    odd = spark.createDataFrame([(1, "DE", "2024-01-01", "... A b!? c. . déİ_1.e ?\nf"), (2, "DE", "2024-01-01", " . ! "), (3, "DE", "2024-01-01", None)], "id long, country_code string, collected_date string, text string")
    assert [r.words for r in sentences(odd).orderBy("sentence").collect()] == [["A", "b"], ["c"], ["déİ_1", "e"], ["f"]]
    plan = sentences(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
