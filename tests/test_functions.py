import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import association as a
from broadsheet.functions import scores, text, urls, vectors
from broadsheet.functions.entities import candidate_score, display_name, normal_name


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def measures(spark, rows):
    df = spark.createDataFrame(rows, "c long, r long, t long, n long")
    args = [F.col(x) for x in "crtn"]
    return [(x.p, x.l) for x in df.select(a.pmi(*args).alias("p"), a.llr(*args).alias("l")).collect()]


def test_pmi_and_llr_anchors(spark):
    got = measures(spark, [(10, 20, 20, 1000), (1, 100, 100, 1000), (10, 100, 100, 1000), (5, 10, 15, 20), (0, 0, 0, 0)])
    assert got[0][0] == pytest.approx(math.log(25)) and got[0][1] == pytest.approx(56.755, abs=0.01)
    assert got[1][0] == pytest.approx(math.log(0.1))
    assert got[2] == (pytest.approx(0), pytest.approx(0, abs=1e-9))
    assert got[3][1] >= 0 and math.isfinite(got[3][1])
    assert got[4] == (None, 0.0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(0, 50), st.integers(0, 50), st.integers(0, 500)), min_size=20, max_size=20))
def test_llr_is_never_negative_and_zero_at_independence(spark, cells):
    rows = [(x, x + b, x + c, x + b + c + d) for x, b, c, d in cells] + [(x * y, x * (y + b), y * (x + c), (x + c) * (y + b)) for x, y, b, c in [(2, 3, 4, 5), (1, 1, 1, 1)]]
    got = measures(spark, rows)
    assert all(v >= 0 for _, v in got)
    assert all(p == pytest.approx(0) and v == pytest.approx(0, abs=1e-8) for p, v in got[-2:])


def test_psi_and_severity(spark):
    psi = sum((a.psi_term(F.lit(x), F.lit(y)) for x, y in ((0.2, 0.5), (0.5, 0.3), (0.3, 0.2))), F.lit(0.0))
    same = sum((a.psi_term(F.lit(x), F.lit(x)) for x in (0.0, 0.4, 0.6)), F.lit(0.0))
    r = one(spark, psi.alias("p"), same.alias("s"), a.severity(F.lit(0.05)).alias("x"), a.severity(F.lit(0.1)).alias("y"), a.severity(F.lit(0.25)).alias("z"))
    assert r.p == pytest.approx(sum((x - y) * math.log(x / y) for x, y in ((0.2, 0.5), (0.5, 0.3), (0.3, 0.2)))) and r.s == 0
    assert (r.x, r.y, r.z) == ("stable", "moderate", "significant")


def scored(**kv):
    return F.create_map(*[F.lit(x) for p in kv.items() for x in p])


def test_calibration(spark):
    low = scored(positive=0.91, neutral=0.86, negative=0.03)
    high = scored(positive=0.97, neutral=0.02, negative=0.01)
    r = one(spark, scores.calibrated(F.lit("positive"), low).alias("a"), scores.calibrated(F.lit("positive"), high).alias("b"), scores.calibrated(F.lit("neutral"), low).alias("c"), scores.top_label(scored(positive=0.4, negative=0.4)).alias("t"), scores.margin(low).alias("m"), scores.calibrated_scores(F.lit("positive"), low).alias("s"))
    assert r.a == pytest.approx(0.91 * (0.65 + 0.35 * 0.05 / 0.75), abs=1e-6) and r.b == pytest.approx(0.97)
    assert r.c == pytest.approx(0.86 * 0.65, abs=1e-6) and r.t == "negative" and r.m == pytest.approx(0.05)
    assert r.s["neutral"] == 0.86 and r.s["positive"] == r.a


def test_urls(spark):
    raw = "HTTPS://Example.com/path/article/?utm_source=x&b=2&a=1#section"
    r = one(spark, urls.normal_url(F.lit(raw)).alias("n"), urls.normal_url(F.lit(" no url ")).alias("x"), urls.category(F.lit("https://a/rss/ekonomi.xml")).alias("c"), urls.role(F.lit("https://a/rss/ekonomi.xml")).alias("r"), urls.role(F.lit("https://a/rss")).alias("g"), urls.role(F.lit("https://a/")).alias("h"))
    assert r.n == "https://example.com/path/article?a=1&b=2" and r.x == "no url"
    assert (r.c, r.r, r.g, r.h) == ("economy_finance", "category", "general_discovery", "general_discovery")
    df = spark.createDataFrame([(raw,), ("http://h/?q=a%20b&z=%C3%A9",), (None,), ("x",), ("http://h/p//?b=~*&b=%7e&&a+c=1%zz&k",), ("http://h?#f",)], "u string").select(urls.normal_url(F.col("u")).alias("n"))
    assert [x.n for x in df.collect()] == ["https://example.com/path/article?a=1&b=2", "http://h/?q=a+b&z=%C3%A9", "", "x", "http://h/p?a+c=1%25zz&b=~&b=~%2A&k=", "http://h/"]


def test_text(spark):
    long = "word " * 100 + "needle " + "tail " * 100
    r = one(spark, text.clean(F.lit(" a \t\n b c ")).alias("c"), text.analysis_text(F.lit(" T "), F.lit(""), F.lit("body text"), 4).alias("t"), text.turkish_stem(F.lit("Vergilerin")).alias("s"), text.turkish_stem(F.lit("ada")).alias("u"), text.snippet(F.lit("short"), F.lit("x")).alias("w"), text.snippet(F.lit(long), F.lit("NEEDLE")).alias("m"), text.snippet(F.lit(long), F.lit("absent")).alias("h"))
    assert r.c == "a b c" and r.t == "T. body" and r.s == "vergi" and r.u == "ada" and r.w == "short"
    assert "needle" in r.m and r.m.startswith("…") and r.m.endswith("…") and len(r.m) < 330
    assert r.h.endswith("…") and len(r.h) <= 321
    assert text.plain_text("<p>a &amp; <b>b</b></p>") == "a &  b" and text.plain_text("x & y") == "x & y"


def test_names(spark):
    assert normal_name("Dr. Prime Minister José  ÇALIŞ!") == "jose calis" and normal_name("Dr.") == "" and normal_name(None) == ""
    assert normal_name(normal_name("Bundeskanzlerin Änne Müller")) == "anne muller"
    r = one(spark, display_name(F.lit("eu komMISSION öl")).alias("d"))
    assert r.d == "EU Kommission Öl"


def test_candidate_scores(spark):
    arr = lambda *x: F.array(*map(F.lit, x))
    full = candidate_score(F.lit("x y"), F.lit("x y"), arr(), F.lit("politician from germany"), arr("politician"), arr("germany"), F.lit("Q1"))
    page = candidate_score(F.lit("x y"), F.lit("x y"), arr(), F.lit("surname"), arr("politician"), arr("germany"), F.lit("Q1"))
    part = candidate_score(F.lit("x y"), F.lit("x"), arr("z"), F.lit(None).cast("string"), arr("politician"), arr(""), F.lit(None).cast("string"))
    r = one(spark, full.alias("f"), page.alias("p"), part.alias("q"))
    assert r.f == 0.8500000000000001 and r.p == 0 and r.q == 0.35


def test_cosine(spark):
    arr = lambda *x: F.array(*map(F.lit, x))
    r = one(spark, vectors.cosine(arr(1.0, 0.0), arr(1.0, 1.0)).alias("c"), vectors.cosine(arr(0.0), arr(1.0)).alias("z"))
    assert r.c == pytest.approx(1 / math.sqrt(2)) and r.z is None


def test_positions_of_mentions_do_not_grow_an_array(spark):
    import re

    from broadsheet.operators.entities import default_mentions

    texts = ["Der Hund und Berlin, 3 Äpfel: Paris", "Zug " * 3000 + "Ende Wien", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted((r.id, r.position, r.entity_text) for r in default_mentions(df).collect())
    assert got == [(i, m.start(), m[0]) for i, t in enumerate(texts) for m in re.finditer(r"\w+", t or "") if re.fullmatch(r"[A-ZÄÖÜ][a-zäöüß]{3,}", m[0])]
    plan = default_mentions(df).select("id", "entity_text")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "array_join" not in plan and "Window" not in plan
