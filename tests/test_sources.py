import textwrap

import pytest
from pyspark.sql import functions as F

from broadsheet.sources import config, feeds, pages, store
from broadsheet.streaming import news as stream

RSS = """<rss><channel><item><title>A</title><link>http://a/1</link><description>d</description><pubDate>Mon, 01 Jan 2024 10:00:00 +0100</pubDate><category>x</category></item>
<item><title>B</title><link>http://a/1</link></item></channel></rss>"""
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>C</title><link href="http://a/2"/><updated>2024-01-02T00:00:00Z</updated><category term="t"/></entry></feed>'
SITEMAP = '<urlset xmlns="http://s" xmlns:news="http://n"><url><loc>http://a/3</loc><news:news><news:title>D</news:title><news:publication_date>2024-01-03</news:publication_date></news:news></url><url><loc>http://a/4</loc></url></urlset>'


def test_feeds(spark):
    files = spark.createDataFrame([("s1", "rss", "u1", RSS), ("s2", "rss", "u2", ATOM), ("s3", "sitemap", "u3", SITEMAP), ("s4", "rss", "u4", "<broken")], "source_name string, source_type string, discovery_url string, xml string")
    got = {r.title: r for r in feeds.items(files, "now").collect()}
    assert set(got) == {"A", "B", "C", "D"} and got["A"].published_date == "2024-01-01T09:00:00+00:00" and got["B"].published_date == "now"
    assert (got["A"].category, got["C"].category, got["C"].link, got["D"].link) == ("x", "t", "http://a/2", "http://a/3")
    assert feeds.distinct_items(feeds.items(files, "now")).count() == 3
    h = {r.source_name: r for r in feeds.health(files, "now").collect()}
    assert (h["s1"].item_count, h["s1"].unique_url_count, h["s4"].parse_ok) == (2, 1, False) and "ParseError" in h["s4"].error


def test_article_parser(spark):
    body = "<p>" + "A long enough paragraph of text. " * 8 + "</p>"
    page = f"<html><head><title>T | Site</title><meta property='og:description' content='S'></head><body><nav><p>{'menu ' * 20}</p></nav><article>{body}<p>reklam {'x' * 40}</p></article></body></html>"
    title, summary, when, text, cleaned, status = pages.parse_article(page)
    assert (title, summary, when, status) == ("T | Site", "S", None, "parsed") and "menu" not in text and "reklam" not in text
    assert pages.parse_article("<p>short one that is not long enough at all</p>")[-1] == "empty" and pages.parse_article(None)[-1] == "empty"
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    assert pages.parsed_articles(df).first().parse_status == "parsed"
    m = pages.page_meta(spark.createDataFrame([(1, "<title>It&#x27;s a &quot;Test&quot; | Politika</title>")], "page_id int, html string")).first()
    assert m.title == 'It\'s a "Test"' and m.summary == ""


def test_config(spark, tmp_path):
    (tmp_path / "de.yaml").write_text(
        textwrap.dedent("""
        country_code: DE
        country_slug: germany
        country_name: Germany
        language: de
        sources: [{name: A, urls: [u1, u2]}, {name: B, url: u3, enabled: false}]
        entity_narrative: {aliases: {people: {Angela Merkel: {aliases: [Merkel], wikidata_qid: Q567}}, organizations: {Siemens: [Siemens AG]}}}
        """),
        encoding="utf-8",
    )
    cfg = config.load_countries(str(tmp_path))
    assert config.country(cfg, "GERMANY") is config.country(cfg, "de")
    with pytest.raises(KeyError):
        config.country(cfg, "xx")
    assert config.sources(spark, cfg).count() == 2
    assert {(r.alias, r.wikidata_qid) for r in config.aliases(spark, cfg).collect()} == {("Angela Merkel", "Q567"), ("Merkel", "Q567"), ("Siemens", None), ("Siemens AG", None)}
    (tmp_path / "x.yaml").write_text("language: en")
    with pytest.raises(ValueError):
        config.load_countries(str(tmp_path))
    assert config.words(str(tmp_path / "none.yaml")) == []


def test_slices_are_replaced_and_cleared(spark, tmp_path):
    s = store.SliceStore(spark, str(tmp_path / "t"))
    schema = "id int, country_code string, collected_date date"
    rows = lambda *x: spark.createDataFrame([(i, c, d) for i, c, d in x], "id int, country_code string, d string").select("id", "country_code", F.to_date("d").alias("collected_date"))
    one, two = {"country_code": "DE", "collected_date": "2024-01-01"}, {"country_code": "DE", "collected_date": "2024-01-02"}
    for _ in range(2):  # writing again changes nothing
        s.replace(rows((1, "DE", "2024-01-01"), (2, "DE", "2024-01-02")), [one, two])
        assert sorted(r.id for r in s.rows(schema).collect()) == [1, 2]
    s.replace(rows((3, "DE", "2024-01-01")), [one])
    assert sorted(r.id for r in s.rows(schema).collect()) == [2, 3]
    s.replace(rows((4, "DE", "2024-01-01")).limit(0), [one])
    assert [r.id for r in s.rows(schema).collect()] == [2]
    with pytest.raises(Exception, match="outside of the slices"):
        s.replace(rows((9, "FR", "2024-01-01")), [one])
    assert [r.id for r in s.rows(schema).collect()] == [2]


def test_write_semantics(spark):
    df = lambda rows: spark.createDataFrame(rows, "id int, link string, v string")
    held, new = df([(1, "a", "x"), (2, None, "x")]), df([(3, "a", "y"), (4, "b", "y"), (5, "b", "z"), (6, None, "y")])
    assert sorted(r.id for r in store.insert_ignore(held, new, "link", "id").collect()) == [4, 6]
    got = {r.link: r.v for r in store.upsert(df([(1, "a", "x"), (2, "c", "x")]), df([(3, "a", "y"), (4, "a", "z")]), ["link"], F.col("id")).collect()}
    assert got == {"a": "z", "c": "x"}
    up = store.update(df([(1, "a", "x"), (2, "b", "x")]), df([(1, None, None)]), "id", ("link",))
    assert {r.id: (r.link, r.v) for r in up.collect()} == {1: ("a", None), 2: ("b", "x")}


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    label = F.when(F.col("event_type") == "error", "negative").when(F.col("event_type").isin("purchase", "signup"), "positive").otherwise("neutral")
    rows = stream.distinct(stream.stream(spark, str(tmp_path / "in")).withColumn("sentiment_label", label), "event_id")
    out = str(tmp_path / "out")

    def write(batch, days):
        batch.groupBy("collected_date").count().write.mode("append").parquet(out)

    q = stream.to_slices(rows.withColumn("collected_date", F.to_date("ts")), write, str(tmp_path / "cp"))
    q.awaitTermination()
    got = {r.collected_date: r.n for r in spark.read.parquet(out).groupBy("collected_date").agg(F.sum("count").alias("n")).collect()}
    want = {r.d: r["count"] for r in events.groupBy(F.to_date("ts").alias("d")).count().collect()}
    assert got == want
    batch = events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("sentiment_label", label)
    assert stream.daily_labels(batch).agg(F.sum("total")).first()[0] == events.count()
    assert stream.rolling(batch).count() >= 30 and stream.sessions(batch, "user_id").agg(F.sum("n")).first()[0] == events.count()


def test_noise_that_is_never_closed_ends_with_the_element_around_it():
    long = "a paragraph of the article that is long enough to be kept in the text" + " and goes on" * 20
    for noise in ("form", "nav", "header", "aside"):
        text = pages.parse_article(f"<body><div><{noise}><input><p>{long} of noise</div><article><p>{long}</p></article></body>")
        assert text[3] == long and text[-1] == "parsed", noise
        assert pages.parse_article(f"<article><p>{long}</p><{noise}><div><p>{long} noise</p></div></{noise}><p>Second {long}</p></article>")[3].count("Second") == 1
    assert pages.parse_article(f"<body><nav><p>{long}</p>")[-1] == "empty"
    assert pages.parse_article("</div></p></nav>" * 1000 + f"<p>{long}</p>")[-1] == "parsed"


def test_a_large_file_is_read_an_element_at_a_time():
    import tracemalloc

    item = "<item><title>t%d</title><link>https://a.example/%d</link><category>c</category></item>"
    xml = "<rss><channel>" + "".join(item % (i, i) for i in range(30_000)) + "</channel></rss>"
    tracemalloc.start()
    assert sum(1 for _ in feeds.feed_items(xml, "s", "n")) == 30_000
    assert tracemalloc.get_traced_memory()[1] < 4_000_000  # the tree of all items takes 20 times that
    tracemalloc.stop()


def test_items_and_health_of_files_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(feeds, "CHARS_AT_ONCE", 7)
    inner = "<item><title>a</title><item><title>b</title></item></item>"
    files = [("r", "rss", "u", f"<rss><item><title>x</title><link>l</link></item>tail{inner}</rss>"), ("cut", "rss", "u", "<rss><item><title>x</title></item>"), ("none", "rss", "u", None), ("odd", "atom", "u", "<a/>")]
    df = spark.createDataFrame(files, "source_name string, source_type string, discovery_url string, xml string")
    assert sorted((r.source_name, r.title) for r in feeds.items(df, "n").collect()) == [("r", "a"), ("r", "b"), ("r", "x")]
    assert [x[0] for x in feeds.feed_items(files[0][3], "s", "n")] == ["x", "a", "b"]
    got = {r.source_name: (r.parse_ok, r.item_count, r.unique_url_count, r.latest_item_date) for r in feeds.health(df, "n").collect()}
    assert got == {"r": (True, 3, 1, "n"), "cut": (False, 0, 0, None), "none": (False, 0, 0, None), "odd": (False, 0, 0, None)}


def test_pages_are_parsed_a_few_at_a_time(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pages, "PAGES_AT_ONCE", 3)
    b = pa.RecordBatch.from_arrays([pa.array(range(7))], names=["page_id"])
    assert [x.column(0).to_pylist() for x in pages._few_pages(b)] == [[0, 1, 2], [3, 4, 5], [6]]
