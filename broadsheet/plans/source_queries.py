"""Queries on sources: feeds, sitemaps, fetched pages, configuration, reviews."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import text, urls
from broadsheet.operators import preprocess
from broadsheet.plans.registry import query
from broadsheet.sources import config, feeds, pages, reviews, store, tables

NOW = "2024-01-30T00:00:00+00:00"


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share, for files that a query writes and reads again."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/broadsheet"
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- feeds


def _part(event_id: Column) -> Column:
    """The file of a source that an event is in: sources publish files of bounded size, and more of them as events come."""
    return F.floor(event_id / 100_000).alias("part")


def _feeds(spark: SparkSession, d: str) -> DataFrame:
    """Feeds of the events, one for each user and 100,000 events: dates in two forms or unreadable, categories as terms, texts or absent."""
    e, i = tables.table(spark, d, "events"), F.col("event_id")
    when = F.when(i % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+03:00")).when(i % 3 == 1, F.date_format("ts", "dd MMM yyyy HH:mm:ss +0000")).otherwise("soon")
    tag = F.when(i % 4 == 0, F.concat(F.lit('<category term="'), "event_type", F.lit('"/><category>second</category>'))).when(i % 4 == 1, F.concat(F.lit("<category>"), "event_type", F.lit("</category>"))).otherwise("")
    item = F.concat(F.lit("<item><title>t"), i.cast("string"), F.lit("</title><pubDate>"), when, F.lit("</pubDate>"), tag, F.lit("</item>"))
    xml = e.groupBy((F.col("user_id") % 50).alias("f"), _part(i)).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("xml"))
    files = xml.select(F.concat(F.lit("src"), "f").alias("source_name"), F.lit("rss").alias("source_type"), "xml")
    return feeds.items(files, NOW)


@query(f"""SELECT 't' || event_id AS title, CASE event_id % 3 WHEN 0 THEN strftime(date_trunc('second', ts) - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') || '+00:00'
  WHEN 1 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' ELSE '{NOW}' END AS published_date FROM events""")
def src03_entry_dates(spark: SparkSession, d: str) -> DataFrame:
    return _feeds(spark, d).select("title", "published_date")


@query("SELECT 't' || event_id AS title, 'src' || (user_id % 50) AS source_name, CASE WHEN event_id % 4 < 2 THEN event_type END AS category FROM events")
def src04_entry_categories(spark: SparkSession, d: str) -> DataFrame:
    return _feeds(spark, d).select("title", "source_name", "category")


def _sitemaps(spark: SparkSession, d: str) -> DataFrame:
    e, i = tables.table(spark, d, "events"), F.col("event_id")
    part = lambda tag, value: F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))
    loc = F.when(i % 11 != 0, part("loc", F.concat(F.lit("https://news.example/"), i.cast("string")))).otherwise("")
    title = F.when(i % 7 != 0, part("n:title", F.col("event_type"))).otherwise("")
    body = F.concat(F.lit("<url>"), loc, F.lit("<n:news>"), title, part("n:publication_date", F.date_format("ts", "yyyy-MM-dd")), part("n:keywords", (i % 5).cast("string")), F.lit("</n:news></url>"))
    xml = e.groupBy((F.col("user_id") % 20).alias("f"), _part(i)).agg(F.concat(F.lit('<urlset xmlns:n="http://news">'), F.array_join(F.collect_list(body), ""), F.lit("</urlset>")).alias("xml"))
    broken = spark.createDataFrame([("broken", "sitemap", "<urlset><url>")], "source_name string, source_type string, xml string")
    return xml.select(F.concat(F.lit("map"), "f").alias("source_name"), F.lit("sitemap").alias("source_type"), "xml").unionByName(broken)


@query("SELECT 'https://news.example/' || event_id AS link, event_type AS title, '' AS summary, 'map' || (user_id % 20) AS source_name, strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' AS published_date, CAST(event_id % 5 AS VARCHAR) AS category FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def src05_sitemap_items(spark: SparkSession, d: str) -> DataFrame:
    return feeds.items(_sitemaps(spark, d), NOW)


@query("SELECT 'map' || (user_id % 20) AS source_name, true AS parse_ok, CAST(count(*) AS INTEGER) AS item_count FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY 1 UNION ALL SELECT 'broken', false, 0")
def src02_feed_health(spark: SparkSession, d: str) -> DataFrame:
    files = _sitemaps(spark, d).withColumn("discovery_url", F.lit("https://x.example"))
    return feeds.health(files, NOW).groupBy("source_name").agg(F.bool_and("parse_ok").alias("parse_ok"), F.sum("item_count").cast("int").alias("item_count"))


_TITLE = r"""trim(regexp_replace(string_split(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '|')[1], '[ \t\r\n]+', ' ', 'g'))"""
_UNESCAPED = f"replace(replace(replace(replace(replace(replace({_TITLE}, '&quot;', chr(34)), '&#x27;', ''''), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


#: What the normal form makes of the table's own URLs.
_URL_KEY = r"rtrim(regexp_replace(regexp_replace(url, '#.*$', ''), '[?]utm_source=[^&]*$', ''), '/')"
_LAST = f"SELECT page_id, html, last_value(html) OVER (PARTITION BY {_URL_KEY} ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_html FROM pages"


def _links(p: DataFrame) -> DataFrame:
    """Links to the pages as feeds write them, with tracking keys and fragments; every third leads nowhere."""
    bare = F.regexp_replace("url", "#.*$", "")
    said = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("/?"), F.lit("utm_medium=map#top"))
    gone = F.concat(F.lit("https://gone.example/"), F.col("page_id").cast("string"))
    return p.select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 3 == 0, gone).otherwise(said).alias("link"))


@query(f"WITH l AS ({_LAST}), t AS (SELECT page_id, {_UNESCAPED.replace('html', 'last_html')} AS title FROM l) SELECT page_id AS id, title FROM t WHERE page_id % 3 <> 0 AND title <> ''")
def src06_html_sitemap(spark: SparkSession, d: str) -> DataFrame:
    """Listed URLs, a third of which nothing was fetched for: those are dropped, the rest has titles."""
    p = tables.table(spark, d, "pages")
    return pages.scraped(_links(p), p).select("id", "title")


@query(f"SELECT page_id AS id, page_id % 3 = 0 AS failed, CASE WHEN page_id % 3 <> 0 THEN length(last_html) END AS page_chars FROM ({_LAST})")
def src07_fetched_articles(spark: SparkSession, d: str) -> DataFrame:
    """Candidates joined with stored pages by normal URL: found ones are parsed, others have the status fetch_error."""
    p = tables.table(spark, d, "pages")
    got = pages.fetched_articles(_links(p), p)
    return got.select("id", (F.col("parse_status") == "fetch_error").alias("failed"), "page_chars")


@query("""WITH m AS (SELECT l_orderkey AS url, CASE WHEN l_linenumber % 2 = 0 THEN 'category' ELSE 'general_discovery' END AS role, l_linenumber AS position FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY (role = 'category') DESC, position) AS k FROM m) SELECT 'https://x.example/' || url AS url, role, position FROM r WHERE k = 1""")
def src08_discovery_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Records as lines of JSON, one best record a URL."""
    k = F.col("l_linenumber")
    rows = tables.table(spark, d, "lineitem").select(F.to_json(F.struct(F.concat(F.lit("https://x.example/"), F.col("l_orderkey").cast("string")).alias("url"), F.when(k % 2 == 0, "category").otherwise("general_discovery").alias("discovery_role"), F.lit("other").alias("canonical_category"), k.alias("position"))).alias("value"))
    path = scratch(spark, "discovery")
    rows.write.text(path)
    return feeds.best_metadata(feeds.metadata_records(spark, path)).select("url", F.col("discovery_role").alias("role"), "position")


@query("""WITH d AS (SELECT DISTINCT 'https://news.example/' || (user_id % 900) AS url FROM events)
SELECT n.id, d.url IS NOT NULL AS known FROM (SELECT id, link FROM news WHERE link IS NOT NULL) n LEFT JOIN d ON d.url = n.link""", ("news",))
def join09_article_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Articles to discovery records by normal URL, whatever tracking keys or fragments either side has."""
    n = tables.news(spark, d).filter("link is not null").select("id", urls.normal_url(F.concat("link", F.lit("/?utm_source=feed#top"))).alias("url"))
    known = tables.table(spark, d, "events").select(urls.normal_url(F.concat(F.lit("HTTPS://News.example/"), (F.col("user_id") % 900).cast("string"), F.lit("?fbclid=1"))).alias("url")).distinct()
    return n.join(known.withColumn("known", F.lit(True)), "url", "left").select("id", F.coalesce("known", F.lit(False)).alias("known"))


# ---------------------------------------------------------------- configuration

_COUNTRIES = {
    "germany.yaml": "country_code: de\ncountry_slug: germany\ncountry_name: Germany\nlanguage: de\nsources:\n  - name: one\n    urls: [https://a.example/rss, https://b.example/rss]\n    category: sports\n  - name: off\n    url: https://c.example\n    enabled: false\n",
    "turkey.yml": "country_code: TR\ncountry_slug: turkey\ncountry_name: Turkey\nlanguage: tr\nsources:\n  - name: map\n    type: sitemap\n    url: https://d.example/map.xml\n    min_expected_items: 5\n",
}


def _configs(files: dict[str, str] = _COUNTRIES) -> dict[str, dict]:
    with tempfile.TemporaryDirectory() as folder:  # configuration is read on the driver
        for name, body in files.items():
            (Path(folder) / name).write_text(body, encoding="utf-8")
        return config.load_countries(folder)


@query("SELECT * FROM (VALUES ('DE', 'one', 'rss', 'https://a.example/rss', 'sports', 'category', 0), ('DE', 'one', 'rss', 'https://b.example/rss', 'sports', 'category', 0), ('TR', 'map', 'sitemap', 'https://d.example/map.xml', 'other', 'category', 5)) v(country_code, source_name, source_type, discovery_url, canonical_category, discovery_role, min_expected_items)")
def src09_source_descriptors(spark: SparkSession, d: str) -> DataFrame:
    return config.sources(spark, _configs())


@query("SELECT country_code, articles, name FROM (SELECT country_code, count(*) AS articles FROM news GROUP BY 1) JOIN (VALUES ('DE', 'Germany'), ('TR', 'Turkey')) v(country_code, name) USING (country_code)", ("news",))
def src10_countries(spark: SparkSession, d: str) -> DataFrame:
    configs = _configs()
    known = spark.createDataFrame([(c, config.country(configs, cfg["country_slug"].upper())["country_name"]) for c, cfg in configs.items()], "country_code string, name string")
    return tables.news(spark, d).groupBy("country_code").agg(F.count(F.lit(1)).alias("articles")).join(known, "country_code")


@query("SELECT doc_id, len(list_filter(string_split(lower(text), ' '), lambda w: w IN ('the', 'and'))) AS stopwords, len(list_filter(string_split(lower(text), ' '), lambda w: w IN ('war', 'peace', 'market'))) AS seeds FROM documents")
def src11_word_lists(spark: SparkSession, d: str) -> DataFrame:
    with tempfile.TemporaryDirectory() as folder:
        (Path(folder) / "stop.yaml").write_text("stopwords: [The, and]\n")
        (Path(folder) / "frames.yaml").write_text("frames:\n  conflict: [War, peace]\n  economic: [market]\n")
        stop = config.words(f"{folder}/stop.yaml") + config.words(f"{folder}/absent.yaml")
        seeds = [r.lemma for r in config.lexicon(spark, f"{folder}/frames.yaml").collect()]
    words = F.split(F.lower("text"), " ")
    count = lambda listed: F.size(F.filter(words, lambda w: w.isin(*listed))).cast("bigint")
    return tables.table(spark, d, "documents").select("doc_id", count(stop).alias("stopwords"), count(seeds).alias("seeds"))


# ---------------------------------------------------------------- reviews

_LABEL = "CASE {} % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'neutral' WHEN 2 THEN 'negative' ELSE '?' END"


def _label(c: Column) -> Column:
    return F.when(c % 4 == 0, "positive").when(c % 4 == 1, "neutral").when(c % 4 == 2, "negative").otherwise("?")


@query(f"SELECT CAST(event_id AS VARCHAR) AS id, {_LABEL.format('event_id')} AS predicted, {_LABEL.format('user_id')} AS reviewed FROM events WHERE event_id % 4 <> 3 AND user_id % 4 <> 3")
def src12_reviewed_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "reviews")
    e = tables.table(spark, d, "events").select(F.col("event_id").alias("id"), _label(F.col("event_id")).alias("predicted"), _label(F.col("user_id")).alias("reviewed"))
    reviews.write_reviews(e, path, ["id", "predicted", "reviewed"])
    return reviews.reviewed_rows(spark, path, "predicted", "reviewed")


@query("SELECT text, CAST(item_id % 3 AS INTEGER) AS label, CAST(item_id AS VARCHAR) AS row_id FROM benchmark WHERE item_id % 4 <> 3 AND trim(text) <> ''")
def src13_gold_rows(spark: SparkSession, d: str) -> DataFrame:
    path, i = scratch(spark, "gold"), F.col("item_id")
    reviews.write_gold(tables.table(spark, d, "benchmark").select("text", F.when(i % 4 == 3, 9).otherwise(i % 3).cast("int").alias("label"), i.cast("string").alias("row_id")), path)
    return reviews.gold_rows(spark, path).select("text", "label", "row_id")


@query(f"SELECT CAST(item_id AS VARCHAR) AS id, {_LABEL.format('item_id')} AS human_label, text FROM benchmark WHERE item_id % 4 <> 3 AND item_id % 2 = 0")
def src14_human_evaluation(spark: SparkSession, d: str) -> DataFrame:
    b, path = tables.table(spark, d, "benchmark"), scratch(spark, "evaluation")
    items = b.agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("item_id").cast("string").alias("id"), _label(F.col("item_id")).alias("human_label"))).alias("items"))).alias("value"))
    items.coalesce(1).write.text(path)
    return reviews.human_evaluation(spark, path, b.filter("item_id % 2 = 0").select(F.col("item_id").cast("string").alias("id"), "text"))


@query("SELECT 2 AS n, 'source_health_20240102.json' AS file")
def src15_latest_report(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch(spark, "health")
    for day in (1, 2):
        store.put_text(spark, f"{folder}/source_health_2024010{day}.json", f'{{"n": {day}}}')
    return reviews.latest(spark, folder).select(F.col("n").cast("int").alias("n"), "file")


@query("SELECT doc_id, CASE quality WHEN 1 THEN 2 ELSE 0 END AS label FROM labels ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def src16_sentiment_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Mapped labels, shuffled by a seed and sliced: the slice is the feature."""
    rows = tables.table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, 2).otherwise(0).alias("label"))
    return preprocess.shuffled(rows, "doc_id", 42).limit(100)


# ---------------------------------------------------------------- scalars of ingestion


@query(r"SELECT item_id, 'a & b' || ' ' || item_id AS clean FROM benchmark")
def sca01_strip_markup(spark: SparkSession, d: str) -> DataFrame:
    markup = F.concat(F.lit("<p>a &amp;\n <b>b</b></p> \t"), F.col("item_id").cast("string"), F.lit("<br/>"))
    return tables.table(spark, d, "benchmark").select("item_id", text.strip_markup(markup).alias("clean"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE true END AS in_german FROM events")
def sca04_target_language(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    line = F.when(i % 4 == 0, "der Hund und die Katze").when(i % 4 == 1, "the dog and the cat of war").when(i % 4 == 2, "").otherwise("xyz")
    return tables.table(spark, d, "events").select("event_id", F.coalesce(preprocess.detected_language(line) == "de", F.lit(True)).alias("in_german"))


@query("SELECT conv_id, turn FROM conversations WHERE length(trim(regexp_replace(concat_ws(' ', nullif(trim(role), ''), nullif(trim(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n]+', ' ', 'g')), '')), '[ \\t\\r\\n]+', ' ', 'g'))) >= 10")
def fil14_long_items(spark: SparkSession, d: str) -> DataFrame:
    c = text.clean(F.coalesce("text", F.lit("")))
    both = F.trim(F.concat_ws(" ", F.nullif(F.trim("role"), F.lit("")), F.nullif(c, F.lit(""))))
    return tables.table(spark, d, "conversations").filter(F.length(both) >= text.MIN_CHARS).select("conv_id", "turn")


@query("SELECT source_name, count(*) AS n FROM (SELECT 'src' || (user_id % 50) AS source_name FROM events UNION ALL SELECT 'map' || (user_id % 20) FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0) GROUP BY 1")
def set02_all_sources(spark: SparkSession, d: str) -> DataFrame:
    """Items of all sources together; repeats across sources stay until they are inserted."""
    return _feeds(spark, d).unionByName(feeds.items(_sitemaps(spark, d), NOW)).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
