"""Queries on writes, resolution, ingestion, the interface and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions import entities as names
from broadsheet.functions import text, urls
from broadsheet.functions.association import entropy_bits, percent
from broadsheet.functions.scores import LABELS
from broadsheet.operators import clustering, density, entities, keywords, news, preprocess
from broadsheet.plans.news_queries import AS_OF
from broadsheet.plans.registry import query
from broadsheet.sources import feeds, pages, store, tables

_COUNTS = ", ".join(f"count(*) FILTER (sentiment_label = '{k}') AS {k}" for k in LABELS)


# ---------------------------------------------------------------- writes


@query("""WITH c AS (SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN 'parsed' ELSE 'fetch_error' END AS parse_status, CASE WHEN event_id % 4 = 0 THEN 'sports' END AS category FROM events WHERE event_id % 3 = 0)
SELECT n.id, CASE WHEN c.id IS NOT NULL THEN c.parse_status ELSE n.parse_status END AS parse_status, CASE WHEN c.id IS NOT NULL THEN coalesce(c.category, n.category) ELSE n.category END AS category FROM news n LEFT JOIN c USING (id)""", ("news",))
def snk02_update_parse(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    changes = tables.table(spark, d, "events").filter(i % 3 == 0).select(i.alias("id"), F.when(i % 2 == 0, "parsed").otherwise("fetch_error").alias("parse_status"), F.when(i % 4 == 0, "sports").alias("category"))
    return store.update(tables.news(spark, d).select("id", "parse_status", "category"), changes, "id", keep_if_null=("category",))


@query("SELECT mention_id, article_id, 'old' AS origin FROM mentions WHERE article_id NOT IN (SELECT article_id FROM mentions WHERE mention_id % 5 = 0) UNION ALL SELECT mention_id, article_id, 'new' FROM mentions WHERE mention_id % 5 = 0", ("mentions",))
def snk06_replace_mentions(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d)
    new = m.filter("mention_id % 5 = 0").select("mention_id", "article_id", F.lit("new").alias("origin"))
    return store.replace_by_parent(m.select("mention_id", "article_id", F.lit("old").alias("origin")), new, new, "article_id")


@query("""WITH r AS (SELECT entity_text, entity_type, country_code, mention_id AS latest, row_number() OVER (PARTITION BY entity_text, entity_type, country_code ORDER BY (mention_id % 2 = 1) DESC, printf('%020d', mention_id) DESC) AS k FROM mentions WHERE mention_id % 2 = 1)
SELECT entity_text, entity_type, country_code, latest FROM r WHERE k = 1""", ("mentions",))
def snk08_upsert_cache(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d).select("entity_text", "entity_type", "country_code", F.col("mention_id").alias("latest"))
    keys = ["entity_text", "entity_type", "country_code"]
    new = m.filter("latest % 2 = 1")
    held = m.join(new, keys, "left_semi").filter("latest % 2 = 0").dropDuplicates(keys)
    return store.upsert(held, new, keys, F.format_string("%020d", "latest"))


@query("SELECT collected_date, country_code, count(*) AS n FROM news WHERE id % 2 = 0 OR collected_date <> DATE '2024-01-05' OR country_code <> 'DE' GROUP BY ALL", ("news",))
def snk09_replace_slice(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d)
    in_slice = (F.col("collected_date") == F.lit("2024-01-05").cast("date")) & (F.col("country_code") == "DE")
    replaced = n.filter(~in_slice).unionByName(n.filter(in_slice & (F.col("id") % 2 == 0)))
    return replaced.groupBy("collected_date", "country_code").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- set operations


@query("WITH u AS (SELECT id, source_name, link, row_number() OVER (PARTITION BY source_name, link ORDER BY collected_date, title) AS k FROM news WHERE coalesce(link, '') <> '') SELECT source_name, count(*) AS n FROM (SELECT source_name FROM u WHERE k = 1 UNION ALL SELECT source_name FROM news WHERE coalesce(link, '') = '') GROUP BY 1", ("news",))
def set01_union_distinct_links(spark: SparkSession, d: str) -> DataFrame:
    return feeds.distinct_items(tables.news(spark, d), "collected_date").groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, quality, unnest(generate_series(1, CASE WHEN quality = 0 THEN 3 ELSE 1 END)) AS copy FROM labels")
def set03_replicated_union(spark: SparkSession, d: str) -> DataFrame:
    rows = tables.table(spark, d, "labels").select("doc_id", "quality")
    return rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col("quality") == 0, 3).otherwise(1).cast("long"))).alias("copy"))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'view' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase'")
def set05_difference(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "events")
    return e.filter("event_type = 'view'").select("user_id").subtract(e.filter("event_type = 'purchase'").select("user_id"))


# ---------------------------------------------------------------- resolution


_ALIASES = [("DE", "PER", "Name 5", "Five", "Q5", 0), ("DE", "ORG", "Name 6 Jr", "Six", "Q6", 1), ("FR", "PER", "name 7", "Seven", None, 2), ("FR", "PER", "NAME 7!", "Seven again", "Q7", 3)]


@query("""WITH a AS (SELECT * FROM (VALUES ('DE', 'PER', 'name 5', 'Five', 'Q5'), ('DE', 'ORG', 'name 6 jr', 'Six', 'Q6'), ('FR', 'PER', 'name 7', 'Seven again', 'Q7')) v(country_code, kind, k, canon, qid)),
m AS (SELECT mention_id, country_code, entity_type, entity_text, lower(entity_text) AS k FROM mentions)
SELECT mention_id, coalesce(o.canon, p.canon, g.canon, CASE WHEN entity_text LIKE '% Jr' THEN regexp_replace(entity_text, 'Jr$', 'JR') ELSE entity_text END) AS canonical, coalesce(o.qid, p.qid, g.qid) AS wikidata_qid,
 CASE WHEN coalesce(o.canon, p.canon, g.canon) IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence, CASE WHEN coalesce(o.canon, p.canon, g.canon) IS NULL THEN 'normalized' ELSE 'local_alias' END AS resolver_method
FROM m LEFT JOIN a o ON o.country_code = m.country_code AND o.kind = entity_type AND o.k = m.k LEFT JOIN a p ON p.country_code = m.country_code AND p.kind = 'PER' AND p.k = m.k LEFT JOIN a g ON g.country_code = m.country_code AND g.kind = 'ORG' AND g.k = m.k""", ("mentions",))
def join03_alias_resolution(spark: SparkSession, d: str) -> DataFrame:
    aliases = spark.createDataFrame(_ALIASES, "country_code string, entity_type string, alias string, canonical string, wikidata_qid string, ordinal int")
    return entities.canonicalize(tables.mentions(spark, d), aliases).select("mention_id", "canonical", "wikidata_qid", "confidence", "resolver_method")


@query("""SELECT mention_id, CASE WHEN entity_text = 'Name 9' AND country_code = 'IT' THEN 'cache' ELSE 'normalized' END AS resolver_method FROM mentions""", ("mentions",))
def join04_resolution_cache(spark: SparkSession, d: str) -> DataFrame:
    kinds = [("IT", t, "name 9", "Nine", "Q9", 0.9) for t in ("PER", "ORG", "LOC")]
    cache = spark.createDataFrame(kinds, "country_code string, entity_type string, normalized_text string, canonical string, wikidata_qid string, confidence double")
    none = spark.createDataFrame([], "country_code string, entity_type string, alias string, canonical string, wikidata_qid string, ordinal int")
    return entities.with_cache(entities.canonicalize(tables.mentions(spark, d), none), cache).select("mention_id", "resolver_method")


@query("""WITH c AS (SELECT s_suppkey % 3 AS key, s_suppkey AS ordinal, 0.0::DOUBLE + CASE WHEN s_suppkey % 4 = 0 THEN 0.55::DOUBLE WHEN s_suppkey % 4 = 1 THEN 0.55::DOUBLE WHEN s_suppkey % 4 = 2 THEN 0.35::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN s_suppkey % 2 = 0 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END + 0.10::DOUBLE * 0 + 0.05::DOUBLE AS score, s_suppkey % 5 = 0 AS page FROM supplier),
r AS (SELECT key, ordinal, CASE WHEN page THEN 0 ELSE score END AS s, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN page THEN 0 ELSE score END DESC, ordinal) AS k FROM c)
SELECT key, 'Q' || ordinal AS wikidata_qid, round(s, 4) AS confidence FROM r WHERE k = 1 AND s >= 0.5""")
def top11_best_candidate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    label = F.when(k % 4 == 0, "jane doe").when(k % 4 == 2, "jane").otherwise("other")
    c = tables.table(spark, d, "supplier").select(
        (k % 3).alias("key"), k.alias("ordinal"), F.lit("Jane Doe").alias("label_raw"), F.lit("jane doe").alias("text"), label.alias("label"),
        F.when(k % 4 == 1, F.array(F.lit("jane doe"))).alias("aliases"),
        F.concat(F.when(k % 2 == 0, "a politician").otherwise("someone"), F.when(k % 5 == 0, " surname").otherwise("")).alias("description"),
        F.array(F.lit("politician")).alias("type_words"), F.array(F.lit("germany")).alias("country_terms"), F.concat(F.lit("Q"), k.cast("string")).alias("qid"),
    )
    return entities.best_candidate(c, 0.5).select("key", "wikidata_qid", "confidence")


@query("SELECT mention_id, replace(replace(lower(entity_text), 'dr ', ''), '.', '') AS normal, CASE WHEN entity_text LIKE '% Jr' THEN regexp_replace(entity_text, 'Jr$', 'JR') ELSE entity_text END AS display FROM mentions", ("mentions",))
def sca12_normal_names(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d)
    return m.select("mention_id", names.normal_names(F.concat(F.lit("Dr. "), "entity_text")).alias("normal"), names.display_name(F.col("entity_text")).alias("display"))


# ---------------------------------------------------------------- ingestion


def _stem_sql(w: str) -> str:
    cases = " ".join(f"WHEN ends_with({w}, '{e}') AND length({w}) >= {len(e) + text.TURKISH_STEM} THEN left({w}, length({w}) - {len(e)})" for e in text.TURKISH_ENDINGS)
    return f"CASE {cases} ELSE {w} END"


@query(f"WITH w AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[\\p{{L}}]+'))) AS w FROM documents) SELECT w, {_stem_sql('w')} AS stem FROM w")
def sca18_turkish_stem(spark: SparkSession, d: str) -> DataFrame:
    words = tables.table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("w")).select(F.lower("w").alias("w")).distinct()
    return words.select("w", text.turkish_stem(F.col("w")).alias("stem"))


@query("""SELECT event_id, (['category', 'general_discovery', 'category', 'category', 'general_discovery', 'general_discovery', 'category', 'general_discovery'])[(event_id % 8) + 1] AS role FROM events""")
def sca09_discovery_role(spark: SparkSession, d: str) -> DataFrame:
    paths = ["/rss/ekonomi.xml", "/rss", "/a/spor-haber_1", "/dunya.rss", "/", "/son-dakika/x", "/blog/item", "/x/anasayfa.xml"]
    url = F.concat(F.lit("https://x.example"), F.element_at(F.array(*map(F.lit, paths)), (F.col("event_id") % 8 + 1).cast("int")))
    return tables.table(spark, d, "events").select("event_id", urls.role(url).alias("role"))


@query()
def sca10_parsed_articles(spark: SparkSession, d: str) -> DataFrame:
    return pages.parsed_articles(tables.table(spark, d, "pages"))


@query()
def src02_feed_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of feeds written from the pages table, one feed for each ten pages."""
    p = pages.page_meta(tables.table(spark, d, "pages")).select((F.col("page_id") % 10).alias("f"), F.replace(F.replace("title", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")).alias("t"), F.replace("url", F.lit("&"), F.lit("&amp;")).alias("u"))
    item = F.concat(F.lit("<item><title>"), "t", F.lit("</title><link>"), "u", F.lit("</link></item>"))
    xml = p.groupBy("f").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.sort_array(F.collect_list(item)), ""), F.lit("</channel></rss>")).alias("xml"))
    return feeds.items(xml.select(F.concat(F.lit("src"), "f").alias("source_name"), F.lit("rss").alias("source_type"), "xml"), "2024-01-30T00:00:00+00:00")


@query("""WITH m AS (SELECT l_orderkey AS url, CASE WHEN l_linenumber % 2 = 0 THEN 'category' ELSE 'general_discovery' END AS role, CASE WHEN l_linenumber % 3 = 0 THEN 'sports' ELSE 'other' END AS category, l_linenumber AS position FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY (role = 'category') DESC, (category <> 'other') DESC, position) AS k FROM m) SELECT url, role, category, position FROM r WHERE k = 1""")
def agg19_best_metadata(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_linenumber")
    m = tables.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("url"), F.when(k % 2 == 0, "category").otherwise("general_discovery").alias("discovery_role"), F.when(k % 3 == 0, "sports").otherwise("other").alias("canonical_category"), k.alias("position"))
    return feeds.best_metadata(m).select("url", F.col("discovery_role").alias("role"), F.col("canonical_category").alias("category"), "position")


@query()
def sca05_preprocess(spark: SparkSession, d: str) -> DataFrame:
    items = tables.table(spark, d, "conversations").select("conv_id", "turn", F.col("role").alias("title"), F.col("text").alias("summary"), F.lit("Mon, 01 Jan 2024 10:00:00 +0100").alias("published_date"))
    return preprocess.preprocess(items, "en", "2024-01-30 00:00:00").select("conv_id", "turn", "char_count", "is_target_language", "cleaned_title", "published_at")


@query()
def ml01_sentiment(spark: SparkSession, d: str) -> DataFrame:
    rows = preprocess.scored(tables.table(spark, d, "conversations"), F.col("text"), target=F.col("turn") % 5 != 4)
    return rows.select("conv_id", "turn", "sentiment_label", "raw_sentiment_score", "calibrated_sentiment_score")


# ---------------------------------------------------------------- vectors and clusters


@query()
def ml08_kmeans(spark: SparkSession, d: str) -> DataFrame:
    return clustering.kmeans(tables.table(spark, d, "embeddings"), 10)


@query()
def ml09_density_clusters(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "embeddings").withColumn("day", (F.col("vec_id") % 4).cast("int"))
    return density.density_clusters(density.reduced(e), ["day"])


@query("SELECT count(*) AS rows FROM benchmark")
def ml07_hashed_embedding(spark: SparkSession, d: str) -> DataFrame:
    e = clustering.hashed_embedding(tables.table(spark, d, "benchmark"), "item_id", "text", 64)
    return e.filter(F.size("embedding") == 64).agg(F.count(F.lit(1)).alias("rows"))


@query("""WITH k AS (SELECT country_code, cluster_id, title, count(*) AS n FROM news WHERE cluster_id >= 0 GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY country_code, cluster_id ORDER BY n DESC, title) AS rank FROM k)
SELECT country_code, cluster_id, string_agg(title, '|' ORDER BY rank) AS keywords FROM r WHERE rank <= 5 GROUP BY ALL""", ("news",))
def api04_clusters(spark: SparkSession, d: str) -> DataFrame:
    k = tables.news(spark, d).filter("cluster_id >= 0").groupBy("country_code", "cluster_id", "title").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("country_code", "cluster_id").orderBy(F.col("n").desc(), "title")
    top = k.withColumn("rank", F.row_number().over(w)).filter("rank <= 5")
    return top.groupBy("country_code", "cluster_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]), "|").alias("keywords"))


# ---------------------------------------------------------------- interface


@query(f"WITH s AS (SELECT * FROM news WHERE country_code = 'DE' AND collected_date = DATE '2024-01-10') SELECT count(*) AS total, {_COUNTS}, coalesce(round(100 * count(*) FILTER (sentiment_label = 'positive')::DOUBLE / nullif(count(*), 0), 1), 0.0) AS positive_pct, count(DISTINCT source_name) AS sources, count(DISTINCT cluster_id) FILTER (cluster_id >= 0) AS clusters FROM s", ("news",))
def api03_today(spark: SparkSession, d: str) -> DataFrame:
    s = news.in_slice(tables.news(spark, d), "2024-01-10", "DE")
    out = s.agg(F.count(F.lit(1)).alias("total"), *news.counts_of("sentiment_label", LABELS), F.count_distinct("source_name").alias("sources"), F.count_distinct(F.when(F.col("cluster_id") >= 0, F.col("cluster_id"))).alias("clusters"))
    return out.withColumn("positive_pct", percent(F.col("positive"), F.col("total")))


@query("SELECT id, title, source_name, sentiment_label FROM news WHERE country_code = 'FR' AND collected_date = DATE '2024-01-12' AND cluster_id = 2", ("news",))
def api05_topic(spark: SparkSession, d: str) -> DataFrame:
    return news.in_slice(tables.news(spark, d), "2024-01-12", "FR").filter("cluster_id = 2").select("id", "title", "source_name", "sentiment_label")


@query(f"SELECT source_name, count(*) AS total, {_COUNTS} FROM news WHERE country_code = 'IT' AND collected_date = DATE '2024-01-09' GROUP BY 1", ("news",))
def api06_source_comparison(spark: SparkSession, d: str) -> DataFrame:
    return news.source_comparison(news.in_slice(tables.news(spark, d), "2024-01-09", "IT")).select("source_name", "total", *LABELS)


@query(f"WITH s AS (SELECT collected_date, {_COUNTS}, count(*) AS total FROM news WHERE country_code = 'TR' AND sentiment_label IS NOT NULL AND collected_date >= DATE '{AS_OF}' - 30 GROUP BY 1) SELECT *, round(100 * positive::DOUBLE / total, 1) AS positive_pct FROM s", ("news",))
def api08_trend(spark: SparkSession, d: str) -> DataFrame:
    return news.trend_percent(tables.news(spark, d).filter("country_code = 'TR'"), AS_OF, 30).drop("country_code")


@query("WITH r AS (SELECT country_code, collected_date, status, psi FROM (SELECT country_code, collected_date, 'ok' AS status, 0.0 AS psi, count(*) AS n FROM news WHERE sentiment_label IS NOT NULL GROUP BY ALL)) SELECT country_code, count(*) AS reports, max(collected_date) AS latest FROM r GROUP BY 1", ("news",))
def api11_drift_history(spark: SparkSession, d: str) -> DataFrame:
    return news.drift(tables.news(spark, d), least_rows=5).groupBy("country_code").agg(F.count(F.lit(1)).alias("reports"), F.max("collected_date").alias("latest"))


@query("""WITH g AS (SELECT country_code, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS mentions FROM mentions WHERE wikidata_qid = 'Q5' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY mentions DESC, name) AS k FROM g) SELECT country_code, name, mentions FROM r WHERE k = 1""", ("mentions",))
def api15_compare(spark: SparkSession, d: str) -> DataFrame:
    g = tables.mentions(spark, d).filter("wikidata_qid = 'Q5'").groupBy("country_code", entities.filled_name().alias("name")).agg(F.count(F.lit(1)).alias("mentions"))
    w = Window.partitionBy("country_code").orderBy(F.col("mentions").desc(), "name")
    return g.withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")


@query("SELECT collected_date, count(*) AS mention_count FROM mentions WHERE wikidata_qid = 'Q7' AND country_code = 'DE' GROUP BY 1", ("mentions",))
def api16_timeline(spark: SparkSession, d: str) -> DataFrame:
    return tables.mentions(spark, d).filter("wikidata_qid = 'Q7' and country_code = 'DE'").groupBy("collected_date").agg(F.count(F.lit(1)).alias("mention_count"))


# ---------------------------------------------------------------- dashboard


@query("""WITH c AS (SELECT source_name, count(*) FILTER (sentiment_label = 'negative') AS neg, count(*) FILTER (sentiment_label = 'neutral') AS neu, count(*) FILTER (sentiment_label = 'positive') AS pos FROM news GROUP BY 1)
SELECT source_name, CASE WHEN neg >= neu AND neg >= pos THEN 'negative' WHEN neu >= pos THEN 'neutral' ELSE 'positive' END AS badge, round(pos::DOUBLE / nullif(neg + neu + pos, 0), 6) AS positive_share FROM c""", ("news",))
def dsh02_badges(spark: SparkSession, d: str) -> DataFrame:
    c = tables.news(spark, d).groupBy("source_name").agg(*news.counts_of("sentiment_label", LABELS))
    best = F.greatest(*LABELS)
    badge = F.when(F.col("negative") == best, "negative").when(F.col("neutral") == best, "neutral").otherwise("positive")
    return c.select("source_name", badge.alias("badge"), F.round(F.try_divide(F.col("positive").cast("double"), sum(F.col(k) for k in LABELS)), 6).alias("positive_share"))


@query("""WITH c AS (SELECT country_code, category, count(*) AS n FROM news WHERE category IS NOT NULL GROUP BY ALL), p AS (SELECT country_code, n::DOUBLE / (sum(n) OVER (PARTITION BY country_code))::DOUBLE AS p FROM c)
SELECT country_code, round(-sum(p * log2(p)), 6) AS bits FROM p GROUP BY 1""", ("news",))
def dsh07_category_entropy(spark: SparkSession, d: str) -> DataFrame:
    c = tables.news(spark, d).filter("category is not null").groupBy("country_code", "category").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("country_code").agg(F.collect_list(F.col("n").cast("double")).alias("w")).select("country_code", F.round(entropy_bits(F.col("w")), 6).alias("bits"))


@query("SELECT event_id, CAST(ts + INTERVAL 3 HOUR AS DATE) AS local_day FROM events")
def dsh10_local_day(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "events")
    return e.select("event_id", F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Europe/Istanbul")).alias("local_day"))


@query()
def ml10_cluster_titles(spark: SparkSession, d: str) -> DataFrame:
    docs = tables.table(spark, d, "documents").select("doc_id", F.col("lang").alias("cluster"), "text")
    top = keywords.top_keywords(docs, ["the", "and"], 3).select(F.col("cluster").alias("cluster_id"), "term", "rank")
    found = tables.articles(spark, d).select("country_code", F.explode(F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{Ll}{5,}"), F.lit(0))).alias("name"))
    lang = F.create_map(*[F.lit(x) for p in (("DE", "de"), ("UK", "en"), ("FR", "fr"), ("ES", "es")) for x in p])
    return clustering.titles(top, found.select(F.element_at(lang, F.col("country_code")).alias("cluster_id"), "name"))
