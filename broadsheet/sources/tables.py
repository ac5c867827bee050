"""The driver's tables, and domain views over them with the same expressions as ADAPTERS has in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTRIES = ("TR", "DE", "FR", "IT", "ES", "UK")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an article, from `events`."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    label = F.when(i % 17 == 0, F.lit(None)).when(F.col("event_type").isin("purchase", "signup"), "positive").when(F.col("event_type") == "error", "negative").otherwise("neutral")
    status = F.when(i % 7 == 0, F.lit(None)).when(i % 7 == 1, "fetch_error").when(i % 7 == 2, "parse_error").when(i % 7 == 3, "empty").otherwise("parsed")
    score = F.col("value") / (F.col("value") + 50)
    return e.select(
        i.alias("id"),
        F.to_date("ts").alias("collected_date"),
        F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.col("user_id") % 6 + 1).cast("int")).alias("country_code"),
        F.concat(F.lit("src"), (i % 10).cast("string")).alias("source_name"),
        F.when(i % 5 == 1, "politics_governance").when(i % 5 == 2, "economy_finance").when(i % 5 == 3, "sports").when(i % 5 == 4, "other").alias("category"),
        F.when(i % 13 != 0, F.concat(F.lit("https://news.example/"), (i % 900).cast("string"))).alias("link"),
        F.concat(F.col("event_type"), F.lit(" "), (F.col("user_id") % 50).cast("string")).alias("title"),
        label.alias("sentiment_label"),
        F.when(label.isNotNull(), score).alias("sentiment_score"),
        F.when(label.isNotNull() & (i % 3 != 0), score * 0.9).alias("calibrated_sentiment_score"),
        status.alias("parse_status"),
        F.when(status == "parsed", i * 37 % 5000).otherwise(0).alias("article_chars"),
        F.when(label.isNotNull(), i % 48).alias("analyzed_hour"),
        F.when(status.isNotNull(), i * 7 % 48).alias("fetched_hour"),
        F.when(i % 11 != 0, (i % 8 - 1).cast("int")).alias("cluster_id"),
        (i % 4 != 0).alias("is_target_language"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: id, country_code, collected_date, source_name, text."""
    lang = F.create_map(*[F.lit(x) for pair in (("de", "DE"), ("en", "UK"), ("fr", "FR"), ("es", "ES")) for x in pair])
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.element_at(lang, F.col("lang")).alias("country_code"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("collected_date"),
        F.col("source").alias("source_name"),
        "text",
    )


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a mention, from `orders`: the article is a customer, names repeat by priority and status."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    qid = F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("Q"), (k % 23).cast("string")))
    return o.select(
        k.alias("mention_id"),
        F.col("o_custkey").alias("article_id"),
        F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.col("o_custkey") % 6 + 1).cast("int")).alias("country_code"),
        F.to_date("o_orderdate").alias("collected_date"),
        F.concat(F.lit("Name "), (k % 37).cast("string"), F.when(k % 2 == 0, "").otherwise(" Jr")).alias("entity_text"),
        F.element_at(F.array(F.lit("PER"), F.lit("ORG"), F.lit("LOC")), (k % 3 + 1).cast("int")).alias("entity_type"),
        qid.alias("wikidata_qid"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, "").otherwise(F.concat(F.lit("Name "), (k % 37).cast("string"))).alias("canonical"),
        F.when(k % 19 == 0, F.lit(None)).otherwise((k * 31 % 400).cast("int")).alias("position_in_article"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "local_alias").when(k % 5 == 2, "wikidata").otherwise("normalized").alias("resolver_method"),
    )


#: The same views as DuckDB common table expressions.
ADAPTERS = {
    "news": """news AS (
  SELECT event_id AS id, CAST(ts AS DATE) AS collected_date, (['TR','DE','FR','IT','ES','UK'])[(user_id % 6) + 1] AS country_code,
         'src' || (event_id % 10) AS source_name,
         CASE event_id % 5 WHEN 1 THEN 'politics_governance' WHEN 2 THEN 'economy_finance' WHEN 3 THEN 'sports' WHEN 4 THEN 'other' END AS category,
         CASE WHEN event_id % 13 <> 0 THEN 'https://news.example/' || (event_id % 900) END AS link,
         event_type || ' ' || (user_id % 50) AS title,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_type IN ('purchase','signup') THEN 'positive' WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         CASE WHEN event_id % 17 <> 0 THEN value / (value + 50) END AS sentiment_score,
         CASE WHEN event_id % 17 <> 0 AND event_id % 3 <> 0 THEN value / (value + 50) * 0.9::DOUBLE END AS calibrated_sentiment_score,
         CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'fetch_error' WHEN 2 THEN 'parse_error' WHEN 3 THEN 'empty' ELSE 'parsed' END AS parse_status,
         CASE WHEN event_id % 7 >= 4 THEN event_id * 37 % 5000 ELSE 0 END AS article_chars,
         CASE WHEN event_id % 17 <> 0 THEN event_id % 48 END AS analyzed_hour,
         CASE WHEN event_id % 7 <> 0 THEN event_id * 7 % 48 END AS fetched_hour,
         CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 8 - 1 AS INTEGER) END AS cluster_id,
         event_id % 4 <> 0 AS is_target_language
  FROM events)""",
    "articles": """articles AS (
  SELECT doc_id AS id, CASE lang WHEN 'de' THEN 'DE' WHEN 'en' THEN 'UK' WHEN 'fr' THEN 'FR' WHEN 'es' THEN 'ES' END AS country_code,
         DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS collected_date, source AS source_name, text
  FROM documents)""",
    "mentions": """mentions AS (
  SELECT o_orderkey AS mention_id, o_custkey AS article_id, (['TR','DE','FR','IT','ES','UK'])[(o_custkey % 6) + 1] AS country_code,
         CAST(o_orderdate AS DATE) AS collected_date,
         'Name ' || (o_orderkey % 37) || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE ' Jr' END AS entity_text,
         (['PER','ORG','LOC'])[(o_orderkey % 3) + 1] AS entity_type,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'Q' || (o_orderkey % 23) END AS wikidata_qid,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' ELSE 'Name ' || (o_orderkey % 37) END AS canonical,
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey * 31 % 400 AS INTEGER) END AS position_in_article,
         CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'local_alias' WHEN 2 THEN 'wikidata' ELSE 'normalized' END AS resolver_method
  FROM orders)""",
}
