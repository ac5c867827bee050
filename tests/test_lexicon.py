"""Terms of a lexicon in texts against a search that tries every term at every word."""

import re
import time

import numpy as np
import pytest

from broadsheet.operators import lexicon


def plain(text, terms, gap, accents, overlapping):
    words = list(re.finditer(lexicon.WORD, text))
    forms = [lexicon.folded(m.group(), accents) for m in words]
    known = {}
    for t in sorted(terms):
        known.setdefault(tuple(lexicon.folded(w, accents) for w in re.findall(lexicon.WORD, t)), t)
    known.pop((), None)

    def fits(i, seq):
        if tuple(forms[i : i + len(seq)]) != seq:
            return False
        return gap is None or all(re.fullmatch(gap, text[words[j].end() : words[j + 1].start()]) for j in range(i, i + len(seq) - 1))

    out, i = [], 0
    while i < len(words):
        here = sorted((s for s in known if fits(i, s)), key=len, reverse=True)
        for seq in here if overlapping else here[:1]:
            a, b = words[i].start(), words[i + len(seq) - 1].end()
            out.append((a, b, text[a:b], known[seq]))
        i += 1 if overlapping or not here else len(here[0])
    return sorted(out)


@pytest.mark.parametrize("overlapping", [False, True])
@pytest.mark.parametrize(("gap", "accents"), [(lexicon.GAP, False), (None, True)])
def test_equals_plain(spark, overlapping, gap, accents):
    r = np.random.default_rng(7)
    forms, joins = ["a", "B", "b", "É", "e", "c", "İz", "x́", "x", "straße", "STRASSE", "9"], [" ", "  ", "-", ", ", ".", "\n", "’"]
    texts = ["".join(str(r.choice(forms)) + str(r.choice(joins, p=[0.6, 0.05, 0.1, 0.1, 0.05, 0.05, 0.05])) for _ in range(int(r.integers(0, 60)))) for _ in range(120)]
    terms = [" ".join(r.choice(forms, int(n))) for n in r.integers(1, 6, 60)] + ["", "...", "a", "A"]
    rows = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, word string")
    known = spark.createDataFrame([(t,) for t in [*terms, *terms[:5], None]], "term string")
    got = {}
    for x in lexicon.find_terms(rows, known, ["doc_id"], gap=gap, accents=accents, overlapping=overlapping).collect():
        got.setdefault(x.doc_id, []).append((x.start, x.end, x.surface, x.term))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == plain(t, terms, gap, accents, overlapping), t


def test_rows_and_edges(spark):
    rows = spark.createDataFrame([(1, "New York, new york"), (1, "New York"), (None, "New-York"), (2, None), (3, ""), (4, "New. York")], "id int, text string")
    known = spark.createDataFrame([("New York",), ("york",)], "term string")
    got = sorted((str(r.id), r.start, r.surface, r.term) for r in lexicon.find_terms(rows, known, ["id"]).collect())
    assert got == [("1", 0, "New York", "New York"), ("1", 0, "New York", "New York"), ("1", 10, "new york", "New York"), ("4", 5, "York", "york"), ("None", 0, "New-York", "New York")]
    assert lexicon.find_terms(rows, known.limit(0), ["id"]).collect() == lexicon.find_terms(rows.limit(0), known, ["id"]).collect() == []
    with pytest.raises(ValueError, match="more than 1 terms"):
        lexicon.find_terms(rows, known, ["id"], most=1)
    with pytest.raises(ValueError, match="named like results"):
        lexicon.find_terms(rows.withColumnRenamed("id", "start"), known, ["start"])


def test_many_terms_and_words_take_one_pass():
    """Terms that begin alike, in a text that keeps nearly meeting them: linear in the words."""
    auto = lexicon.Automaton([" ".join(["a"] * n + ["b"]) for n in range(1, 400)] + [f"t{i} u{i}" for i in range(10_000)])
    syms = [auto.symbols["a"]] * 300_000
    began = time.perf_counter()
    assert list(auto.longest(syms, [0] * len(syms))) == []
    assert list(auto.longest([*syms, auto.symbols["b"]], [0] * (len(syms) + 1))) == [(len(syms) - 399, len(syms) + 1, auto.terms.index(" ".join(["a"] * 399 + ["b"])))]
    assert time.perf_counter() - began < 5
