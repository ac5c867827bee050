"""Queries over articles and mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions.scores import LABELS, bucket, calibrated, margin, top_label
from broadsheet.operators import entities, news
from broadsheet.plans.registry import query
from broadsheet.sources import tables

AS_OF = "2024-01-30"
_LABEL_COUNTS = ", ".join(f"count(*) FILTER (sentiment_label = '{k}') AS {k}" for k in LABELS)
_LABEL_PCTS = ", ".join(f"coalesce(round(100 * {k}::DOUBLE / nullif(total, 0), 1), 0.0) AS {k}_pct" for k in LABELS)


@query("SELECT id, source_name, sentiment_label FROM news WHERE collected_date = DATE '2024-01-10' AND country_code = 'DE'", ("news",))
def src01_slice_scan(spark: SparkSession, d: str) -> DataFrame:
    return news.in_slice(tables.news(spark, d), "2024-01-10", "DE").select("id", "source_name", "sentiment_label")


@query(f"SELECT country_code, collected_date, {_LABEL_COUNTS}, count(*) AS total FROM news WHERE sentiment_label IS NOT NULL AND collected_date >= DATE '{AS_OF}' - 14 GROUP BY ALL", ("news",))
def agg02_sentiment_trend(spark: SparkSession, d: str) -> DataFrame:
    return news.trend(tables.news(spark, d), AS_OF, 14)


@query("SELECT coalesce(canonical, entity_text) AS name, entity_type, count(*) AS mentions FROM mentions GROUP BY ALL", ("mentions",))
def agg03_mention_counts(spark: SparkSession, d: str) -> DataFrame:
    return entities.mention_counts(tables.mentions(spark, d))


@query("SELECT entity_text, entity_type, count(*) AS mentions FROM mentions WHERE wikidata_qid IS NULL AND (resolver_method IS NULL OR resolver_method = 'normalized') GROUP BY ALL ORDER BY mentions DESC, entity_text, entity_type LIMIT 20", ("mentions",))
def agg04_top_unresolved(spark: SparkSession, d: str) -> DataFrame:
    return entities.top_unresolved(tables.mentions(spark, d), 20)


@query("SELECT entity_type, coalesce(nullif(canonical, ''), entity_text) AS name, entity_text, wikidata_qid, resolver_method, count(*) AS mentions FROM mentions GROUP BY ALL", ("mentions",))
def agg05_resolution_groups(spark: SparkSession, d: str) -> DataFrame:
    return entities.audit_groups(tables.mentions(spark, d))


@query("SELECT country_code, max(collected_date) AS latest, count(DISTINCT collected_date) AS days FROM news GROUP BY country_code", ("news",))
def agg07_latest_date(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).groupBy("country_code").agg(F.max("collected_date").alias("latest"), F.count_distinct("collected_date").alias("days"))


@query("SELECT DISTINCT collected_date FROM news WHERE country_code = 'FR'", ("news",))
def agg08_available_dates(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).filter("country_code = 'FR'").select("collected_date").distinct().orderBy("collected_date")


@query(f"WITH s AS (SELECT country_code, collected_date, count(*) AS total, {_LABEL_COUNTS} FROM news GROUP BY ALL) SELECT *, {_LABEL_PCTS} FROM s", ("news",))
def agg09_day_summary(spark: SparkSession, d: str) -> DataFrame:
    return news.day_summary(tables.news(spark, d))


@query(f"WITH s AS (SELECT source_name, count(*) AS total, {_LABEL_COUNTS}, round(avg(coalesce(calibrated_sentiment_score, sentiment_score)), 4) AS avg_score FROM news GROUP BY ALL) SELECT *, {_LABEL_PCTS} FROM s", ("news",))
def agg10_source_comparison(spark: SparkSession, d: str) -> DataFrame:
    return news.source_comparison(tables.news(spark, d))


@query(f"WITH s AS (SELECT country_code, collected_date, {_LABEL_COUNTS}, count(*) AS total FROM news WHERE sentiment_label IS NOT NULL AND collected_date >= DATE '{AS_OF}' - 30 GROUP BY ALL) SELECT *, coalesce(round(100 * positive::DOUBLE / nullif(total, 0), 1), 0.0) AS positive_pct FROM s", ("news",))
def agg11_trend_percent(spark: SparkSession, d: str) -> DataFrame:
    return news.trend_percent(tables.news(spark, d), AS_OF, 30)


_DRIFT_SQL = """
WITH daily AS (SELECT country_code, collected_date, count(*)::DOUBLE AS total, count(*) FILTER (sentiment_label = 'negative') / count(*)::DOUBLE AS negative,
    count(*) FILTER (sentiment_label = 'neutral') / count(*)::DOUBLE AS neutral, count(*) FILTER (sentiment_label = 'positive') / count(*)::DOUBLE AS positive
  FROM news WHERE sentiment_label IS NOT NULL GROUP BY ALL),
m AS (SELECT t.country_code, t.collected_date, t.total, t.negative, t.neutral, t.positive, count(b.total) AS days,
    avg(b.negative) AS bn, avg(b.neutral) AS bu, avg(b.positive) AS bp
  FROM daily t LEFT JOIN daily b ON b.country_code = t.country_code AND b.total >= {rows} AND b.collected_date < t.collected_date AND b.collected_date >= t.collected_date - 30
  GROUP BY ALL),
p AS (SELECT *, (greatest(negative, 1e-6::DOUBLE) - greatest(bn, 1e-6::DOUBLE)) * ln(greatest(negative, 1e-6::DOUBLE) / greatest(bn, 1e-6::DOUBLE))
   + (greatest(neutral, 1e-6::DOUBLE) - greatest(bu, 1e-6::DOUBLE)) * ln(greatest(neutral, 1e-6::DOUBLE) / greatest(bu, 1e-6::DOUBLE))
   + (greatest(positive, 1e-6::DOUBLE) - greatest(bp, 1e-6::DOUBLE)) * ln(greatest(positive, 1e-6::DOUBLE) / greatest(bp, 1e-6::DOUBLE)) AS psi FROM m)
SELECT country_code, collected_date, CASE WHEN days >= 7 THEN 'ok' ELSE 'insufficient_data' END AS status, CASE WHEN days >= 7 THEN round(psi, 4) END AS psi,
  CASE WHEN days >= 7 THEN CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END END AS severity,
  days AS baseline_days, CAST(total AS BIGINT) AS today_total,
  CASE WHEN days >= 7 THEN round(negative - bn, 4) END AS delta_negative, CASE WHEN days >= 7 THEN round(neutral - bu, 4) END AS delta_neutral,
  CASE WHEN days >= 7 THEN round(positive - bp, 4) END AS delta_positive FROM p
"""


@query(_DRIFT_SQL.format(rows=5), ("news",))
def agg16_psi_drift(spark: SparkSession, d: str) -> DataFrame:
    return news.drift(tables.news(spark, d), least_rows=5)


@query(f"""WITH r AS ({_DRIFT_SQL.format(rows=5).strip().removeprefix("WITH ").join(["WITH ", ""])}), l AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY collected_date DESC) AS k FROM r)
SELECT country_code, unnest(['drift_psi', 'drift_severity', 'drift_baseline_days', 'drift_delta_negative', 'drift_delta_neutral', 'drift_delta_positive']) AS metric,
  unnest([psi, CASE WHEN status <> 'ok' THEN -1.0 WHEN severity = 'stable' THEN 0.0 WHEN severity = 'moderate' THEN 1.0 ELSE 2.0 END, baseline_days::DOUBLE, delta_negative, delta_neutral, delta_positive]) AS value
FROM l WHERE k = 1""", ("news",))  # fmt: skip
def snk21_drift_gauges(spark: SparkSession, d: str) -> DataFrame:
    return news.drift_gauges(news.drift(tables.news(spark, d), least_rows=5))


@query("""WITH links AS (SELECT source_name, count(DISTINCT link) AS unique_urls FROM news GROUP BY 1),
c AS (SELECT source_name, category, count(*) AS items, count(*) FILTER (parse_status = 'fetch_error') AS failures FROM news GROUP BY 1, 2),
s AS (SELECT source_name, count(*) AS checks, CAST(sum(items) AS BIGINT) AS raw_items, CAST(sum(failures) AS BIGINT) AS failures, count(*) FILTER (items < 20) AS low_categories FROM c GROUP BY 1)
SELECT source_name, checks, raw_items, failures, low_categories, unique_urls, coalesce(round(100 * (raw_items - unique_urls)::DOUBLE / nullif(raw_items, 0), 1), 0.0) AS dedupe_loss_pct FROM s JOIN links USING (source_name)""", ("news",))
def agg17_source_health(spark: SparkSession, d: str) -> DataFrame:
    return news.source_health(tables.news(spark, d))


_STATUS_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in news.STATUSES)


@query(f"""WITH r AS (SELECT coalesce(nullif(source_name, ''), 'unknown') AS source, coalesce(nullif(category, ''), 'unknown') AS category, coalesce(parse_status, 'unfetched') AS status, article_chars FROM news),
g AS (SELECT source, category, count(*) AS total, {_STATUS_COUNTS}, coalesce(round(avg(article_chars) FILTER (status = 'parsed'), 1), 0.0) AS avg_chars, coalesce(max(article_chars) FILTER (status = 'parsed'), 0) AS max_chars
  FROM r GROUP BY GROUPING SETS ((source), (category), ())),
p AS (SELECT *, total - unfetched AS fetched, coalesce(round(100 * (total - unfetched)::DOUBLE / nullif(total, 0), 1), 0.0) AS coverage_pct, coalesce(round(100 * parsed::DOUBLE / nullif(total - unfetched, 0), 1), 0.0) AS parsed_pct_fetched FROM g)
SELECT *, source IS NOT NULL AND fetched >= 10 AND parsed_pct_fetched < 85.0 AS needs_attention FROM p""", ("news",))
def agg20_parse_quality_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return news.parse_quality(tables.news(spark, d))


_AVGS = ", ".join(f"round(avg(sentiment_score) FILTER (sentiment_label = '{k}'), 4) AS avg_{k}" for k in LABELS)


@query(f"""SELECT source_name, count(*) AS total, {_LABEL_COUNTS}, {_AVGS}, round(avg(sentiment_score), 4) AS avg_raw, round(avg(calibrated_sentiment_score), 4) AS avg_calibrated,
count(*) FILTER (sentiment_score >= 0.9) AS raw_high, count(*) FILTER (calibrated_sentiment_score >= 0.9) AS calibrated_high,
count(*) FILTER (sentiment_label IS NOT NULL AND analyzed_hour < fetched_hour) AS stale, count(*) FILTER (sentiment_label IS NOT NULL AND analyzed_hour >= fetched_hour) AS after_body FROM news GROUP BY 1""", ("news",))
def agg21_sentiment_audit(spark: SparkSession, d: str) -> DataFrame:
    return news.sentiment_audit(tables.news(spark, d))


@query("""WITH g AS (SELECT entity_type, coalesce(nullif(canonical, ''), entity_text) AS name, count(DISTINCT entity_text) AS aliases, count(DISTINCT wikidata_qid) AS qids, count(*) AS mentions, coalesce(bool_or(resolver_method = 'local_alias'), false) AS local FROM mentions GROUP BY ALL)
SELECT *, aliases > 1 AS merged, aliases > 1 AND (qids > 1 OR (aliases >= 5 AND NOT local)) AS suspicious FROM g""", ("mentions",))
def agg22_entity_audit(spark: SparkSession, d: str) -> DataFrame:
    return entities.resolution_audit(tables.mentions(spark, d))


@query(f"""WITH f AS (SELECT * FROM news WHERE cluster_id >= 0), s AS (SELECT country_code, cluster_id, source_name, count(*) AS n FROM f GROUP BY ALL),
t AS (SELECT country_code, cluster_id, source_name AS top_source, count(*) OVER (PARTITION BY country_code, cluster_id) AS n_sources, row_number() OVER (PARTITION BY country_code, cluster_id ORDER BY n DESC, source_name) AS k FROM s),
z AS (SELECT country_code, cluster_id, count(*) AS size, {_LABEL_COUNTS} FROM f GROUP BY ALL)
SELECT z.*, n_sources, top_source FROM z JOIN t USING (country_code, cluster_id) WHERE k = 1""", ("news",))
def agg25_cluster_summaries(spark: SparkSession, d: str) -> DataFrame:
    return news.cluster_summaries(tables.news(spark, d))


@query("""WITH s AS (SELECT country_code, cluster_id, count(*) AS n, count(*) FILTER (coalesce(category, 'unknown') = 'unknown') AS u FROM news GROUP BY ALL),
a AS (SELECT country_code, sum(n) AS items, max(n) FILTER (cluster_id >= 0) AS largest, count(*) FILTER (cluster_id >= 0 AND n < 5) AS small, count(*) FILTER (cluster_id >= 0) AS clusters, coalesce(sum(n) FILTER (cluster_id = -1), 0) AS noise, sum(u) AS unknown FROM s GROUP BY 1),
p AS (SELECT country_code, clusters, coalesce(round(100 * largest::DOUBLE / items::DOUBLE, 2), 0.0) AS largest_cluster_pct, coalesce(round(100 * small::DOUBLE / nullif(clusters, 0), 2), 0.0) AS small_cluster_pct, coalesce(round(100 * noise::DOUBLE / items::DOUBLE, 2), 0.0) AS noise_pct, coalesce(round(100 * unknown::DOUBLE / items::DOUBLE, 2), 0.0) AS unknown_category_pct FROM a)
SELECT *, concat_ws(',', CASE WHEN largest_cluster_pct > 25 THEN 'dominant_cluster' END, CASE WHEN noise_pct > 40 THEN 'high_noise' END) AS warnings FROM p""", ("news",))
def agg26_cluster_quality(spark: SparkSession, d: str) -> DataFrame:
    return news.cluster_quality(tables.news(spark, d))


@query("SELECT coalesce(parse_status, 'unfetched') AS status, count(*) AS n FROM news GROUP BY 1", ("news",))
def agg33_fetch_status(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).groupBy(F.coalesce("parse_status", F.lit("unfetched")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY id) AS rank FROM news WHERE link IS NOT NULL AND (parse_status IS NULL OR parse_status IN ('fetch_error', 'parse_error', 'empty')))
SELECT id, source_name, link, parse_status FROM r WHERE rank <= 15 ORDER BY source_name, id LIMIT 100""", ("news",))
def win01_per_source_limit(spark: SparkSession, d: str) -> DataFrame:
    return news.fetch_candidates(tables.news(spark, d), True, 15, 100).select("id", "source_name", "link", "parse_status")


@query("SELECT id FROM news WHERE parse_status IS NULL AND link IS NOT NULL", ("news",))
def fil02_unfetched(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).filter(F.col("parse_status").isNull() & F.col("link").isNotNull()).select("id")


@query("SELECT id, 'missing' AS mode FROM news WHERE sentiment_label IS NULL UNION ALL SELECT id, 'stale' FROM news WHERE sentiment_label IS NOT NULL AND analyzed_hour < fetched_hour AND article_chars > 0", ("news",))
def fil03_to_rescore(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d)
    missing = news.to_rescore(n, only_missing=True).select("id", F.lit("missing").alias("mode"))
    return missing.unionByName(news.to_rescore(n, only_stale=True, only_with_body=True).select("id", F.lit("stale").alias("mode")))


@query("SELECT id, sentiment_label, round(sentiment_score, 6) AS score FROM news WHERE sentiment_label IS NOT NULL AND sentiment_score >= 0.6 ORDER BY collected_date DESC, id DESC LIMIT 500", ("news",))
def fil06_high_confidence(spark: SparkSession, d: str) -> DataFrame:
    return news.high_confidence(tables.news(spark, d), 0.6, 500).select("id", "sentiment_label", F.round("sentiment_score", 6).alias("score"))


@query("SELECT mention_id, entity_text FROM mentions WHERE canonical IS NULL OR resolver_method IS NULL OR resolver_method = 'normalized'", ("mentions",))
def fil07_unresolved(spark: SparkSession, d: str) -> DataFrame:
    return entities.unresolved(tables.mentions(spark, d), True).select("mention_id", "entity_text")


@query("SELECT id, title FROM news WHERE title ILIKE '%URCHASE 1%' AND collected_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND country_code = ANY(['DE', 'FR'])", ("news",))
def fil10_search(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d)
    return n.filter(F.col("title").ilike("%URCHASE 1%") & F.col("collected_date").between("2024-01-05", "2024-01-12") & F.col("country_code").isin("DE", "FR")).select("id", "title")


@query("""WITH c AS (SELECT entity_type, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS mentions FROM mentions GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY mentions DESC, name) AS rank FROM c) SELECT * FROM r WHERE rank <= 10""", ("mentions",))
def win02_top_entities(spark: SparkSession, d: str) -> DataFrame:
    return entities.top_entities(tables.mentions(spark, d), 10)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY collected_date DESC, sentiment_score DESC NULLS LAST, id) AS k FROM news) SELECT country_code, id, collected_date FROM r WHERE k = 1""", ("news",))
def win03_latest_per_country(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("country_code").orderBy(F.col("collected_date").desc(), F.col("sentiment_score").desc_nulls_last(), "id")
    return tables.news(spark, d).withColumn("k", F.row_number().over(w)).filter("k = 1").select("country_code", "id", "collected_date")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY position_in_article NULLS LAST, mention_id) AS k FROM mentions)
SELECT r.article_id, mention_id, source_name FROM r JOIN news n ON n.id = r.article_id WHERE k = 1 ORDER BY n.collected_date DESC, r.article_id LIMIT 200""", ("news", "mentions"))
def win04_first_mention_per_article(spark: SparkSession, d: str) -> DataFrame:
    return entities.first_per_article(tables.mentions(spark, d), tables.news(spark, d), 200).select("article_id", "mention_id", "source_name")


@query("WITH c AS (SELECT country_code, collected_date, source_name, count(*) AS n FROM news GROUP BY ALL) SELECT *, round(n::DOUBLE / (sum(n) OVER (PARTITION BY country_code, collected_date))::DOUBLE, 6) AS share FROM c", ("news",))
def win11_day_share(spark: SparkSession, d: str) -> DataFrame:
    out = news.source_counts(tables.news(spark, d))
    return out.withColumn("share", F.round("share", 6))


@query("""WITH s AS (SELECT coalesce(source_name, 'unknown') AS source, coalesce(sentiment_label, 'missing') AS label, CASE WHEN sentiment_score IS NULL THEN 'missing' WHEN sentiment_score < 0.55 THEN 'low' WHEN sentiment_score < 0.75 THEN 'mid' ELSE 'high' END AS confidence,
 article_chars > 0 AS has_body, coalesce(category, 'unknown') AS stratum_category FROM news) SELECT *, least(3, count(*)) AS n FROM s GROUP BY ALL""", ("news",))
def win10_stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    keys = ["source", "label", "confidence", "has_body", "stratum_category"]
    return news.review_sample(tables.news(spark, d), 3).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT m.mention_id, n.source_name, n.sentiment_label FROM mentions m JOIN news n ON n.id = m.article_id WHERE m.position_in_article IS NOT NULL", ("news", "mentions"))
def join01_mentions_with_articles(spark: SparkSession, d: str) -> DataFrame:
    m, n = tables.mentions(spark, d), tables.news(spark, d)
    return m.filter("position_in_article is not null").join(n.withColumnRenamed("id", "article_id"), "article_id").select("mention_id", "source_name", "sentiment_label")


@query("""WITH old AS (SELECT DISTINCT link FROM news WHERE collected_date < DATE '2024-01-15' AND link IS NOT NULL), new AS (SELECT * FROM news WHERE collected_date >= DATE '2024-01-15'),
f AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS k FROM new WHERE link IS NOT NULL AND link NOT IN (SELECT link FROM old))
SELECT id, link FROM f WHERE k = 1 UNION ALL SELECT id, link FROM new WHERE link IS NULL""", ("news",))
def join13_insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    from broadsheet.sources.store import insert_ignore

    n = tables.news(spark, d)
    return insert_ignore(n.filter("collected_date < '2024-01-15'"), n.filter("collected_date >= '2024-01-15'"), "link", "id").select("id", "link")


@query("WITH w AS (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS collected_date) SELECT collected_date FROM w WHERE collected_date NOT IN (SELECT collected_date FROM news WHERE country_code = 'TR')", ("news",))
def join14_backfill_dates(spark: SparkSession, d: str) -> DataFrame:
    want = spark.range(1).select(F.explode(F.sequence(F.lit("2023-12-25").cast("date"), F.lit("2024-02-05").cast("date"))).alias("collected_date"))
    return want.join(tables.news(spark, d).filter("country_code = 'TR'").select("collected_date").distinct(), "collected_date", "left_anti")


_SCORES_SQL = "n.sentiment_score * 0.6::DOUBLE AS a, (1 - n.sentiment_score) * 0.5::DOUBLE AS b, 0.2::DOUBLE AS c"


@query(f"""WITH s AS (SELECT id, sentiment_label AS label, {_SCORES_SQL} FROM news n WHERE sentiment_label IS NOT NULL),
t AS (SELECT *, CASE label WHEN 'negative' THEN a WHEN 'neutral' THEN b ELSE c END AS own, CASE label WHEN 'negative' THEN greatest(b, c) WHEN 'neutral' THEN greatest(a, c) ELSE greatest(a, b) END AS rest, list_reverse_sort([a, b, c]) AS z FROM s)
SELECT id, label, round(least(1, greatest(0, own * (0.65::DOUBLE + 0.35::DOUBLE * least(1, greatest(0, own - rest) / 0.75::DOUBLE)))), 6) AS calibrated, round(z[1] - z[2], 6) AS margin,
 CASE WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral' ELSE 'positive' END AS top, CASE WHEN own < 0.55 THEN 'low' WHEN own < 0.75 THEN 'mid' ELSE 'high' END AS confidence FROM t""", ("news",))
def sca17_calibrate(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d).filter("sentiment_label is not null")
    s = F.col("sentiment_score")
    scores = F.create_map(F.lit("negative"), s * 0.6, F.lit("neutral"), (1 - s) * 0.5, F.lit("positive"), F.lit(0.2))
    n = n.select("id", F.col("sentiment_label").alias("label"), scores.alias("scores"))
    return n.select("id", "label", calibrated(F.col("label"), F.col("scores")).alias("calibrated"), F.round(margin(F.col("scores")), 6).alias("margin"), top_label(F.col("scores")).alias("top"), bucket(F.element_at("scores", F.col("label"))).alias("confidence"))


@query("WITH s AS (SELECT entity_type, country_code, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS mentions FROM mentions GROUP BY ALL), p AS (SELECT name, entity_type, sum(mentions) FILTER (country_code = 'DE') AS DE, sum(mentions) FILTER (country_code = 'FR') AS FR, sum(mentions) FILTER (country_code = 'UK') AS UK FROM s WHERE country_code IN ('DE','FR','UK') GROUP BY ALL) SELECT name, entity_type, CAST(coalesce(DE, 0) AS BIGINT) AS DE, CAST(coalesce(FR, 0) AS BIGINT) AS FR, CAST(coalesce(UK, 0) AS BIGINT) AS UK FROM p", ("mentions",))
def join18_compare_countries(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d).filter(F.col("country_code").isin("DE", "FR", "UK"))
    return m.groupBy(entities.filled_name().alias("name"), "entity_type").pivot("country_code", ["DE", "FR", "UK"]).count().fillna(0)


@query("WITH t AS (SELECT n.collected_date, count(*) AS mention_count, round(avg(n.sentiment_score), 6) AS avg_score FROM mentions m JOIN news n ON n.id = m.article_id WHERE coalesce(nullif(m.canonical, ''), m.entity_text) = 'Name 5' GROUP BY 1) SELECT * FROM t", ("news", "mentions"))
def agg06_entity_timeline(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d).filter(entities.filled_name() == "Name 5")
    n = tables.news(spark, d).select(F.col("id").alias("article_id"), F.col("collected_date").alias("day"), "sentiment_score")
    return m.join(n, "article_id").groupBy(F.col("day").alias("collected_date")).agg(F.count(F.lit(1)).alias("mention_count"), F.round(F.avg("sentiment_score"), 6).alias("avg_score"))
