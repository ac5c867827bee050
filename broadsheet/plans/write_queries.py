"""Queries on writes: what each write step leaves in its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.association import pmi
from broadsheet.functions.scores import LABELS
from broadsheet.operators import clustering, entities, news
from broadsheet.plans.news_queries import _DRIFT_SQL
from broadsheet.plans.registry import query
from broadsheet.plans.source_queries import scratch
from broadsheet.sources import reviews, store, tables

_DRIFT = f"drift AS ({_DRIFT_SQL.format(rows=5).strip()})"


@query("""WITH held AS (SELECT DISTINCT link FROM news WHERE id % 2 = 0 AND link IS NOT NULL), fresh AS (SELECT country_code, collected_date, link, row_number() OVER (PARTITION BY link ORDER BY id) AS k FROM news WHERE id % 2 = 1 AND (link IS NULL OR link NOT IN (SELECT link FROM held)))
SELECT country_code, count(*) AS inserted FROM fresh WHERE link IS NULL OR k = 1 GROUP BY 1""", ("news",))
def snk01_insert_raw(spark: SparkSession, d: str) -> DataFrame:
    """New rows by country after a bulk insert that ignores links that are there; rows without a link always go in."""
    n = tables.news(spark, d).select("id", "country_code", "collected_date", "link")
    return store.insert_ignore(n.filter("id % 2 = 0"), n.filter("id % 2 = 1"), "link", "id").groupBy("country_code").agg(F.count(F.lit(1)).alias("inserted"))


@query("SELECT id, CASE WHEN id % 3 = 0 THEN lower(title) || '!' ELSE title END AS title, CASE WHEN id % 3 = 0 THEN true ELSE is_target_language END AS is_target_language FROM news WHERE id % 10 <> 0", ("news",))
def snk03_update_preprocessed(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d).select("id", "title", "is_target_language")
    changes = n.filter("id % 3 = 0").select("id", F.concat(F.lower("title"), F.lit("!")).alias("title"), F.lit(True).alias("is_target_language"))
    return store.update(n.join(n.filter("id % 10 = 0").select("id"), "id", "left_anti"), changes, "id")


@query("SELECT id, CASE WHEN id % 2 = 0 THEN 'neutral' ELSE sentiment_label END AS sentiment_label, CASE WHEN id % 2 = 0 THEN 0.5::DOUBLE ELSE sentiment_score END AS sentiment_score FROM news", ("news",))
def snk04_update_sentiment(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d).select("id", "sentiment_label", "sentiment_score")
    return store.update(n, n.filter("id % 2 = 0").select("id", F.lit("neutral").alias("sentiment_label"), F.lit(0.5).alias("sentiment_score")), "id")


@query("SELECT article_id AS id, CAST(count(*) AS BIGINT) AS entity_count, count(DISTINCT entity_type) AS kinds, max(entity_text) FILTER (entity_type = 'ORG') AS last_org FROM mentions GROUP BY 1", ("mentions",))
def snk05_update_ner(spark: SparkSession, d: str) -> DataFrame:
    """Articles with a map of surfaces by type, and their number."""
    m = tables.mentions(spark, d)
    held = m.select(F.col("article_id").alias("id")).distinct().withColumns({"entities": F.lit(None).cast("map<string,array<string>>"), "entity_count": F.lit(None).cast("long")})
    by = m.groupBy("article_id", "entity_type").agg(F.array_sort(F.collect_set("entity_text")).alias("names"), F.count(F.lit(1)).alias("n"))
    changes = by.groupBy(F.col("article_id").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("entity_type", "names"))).alias("entities"), F.sum("n").alias("entity_count"))
    out = store.update(held, changes, "id")
    return out.select("id", "entity_count", F.size("entities").cast("bigint").alias("kinds"), F.element_at(F.try_element_at("entities", F.lit("ORG")), -1).alias("last_org"))


@query("SELECT mention_id, CASE WHEN mention_id % 4 = 0 THEN upper(entity_text) ELSE canonical END AS canonical, CASE WHEN mention_id % 4 = 0 THEN 'cache' ELSE resolver_method END AS resolver_method FROM mentions", ("mentions",))
def snk07_update_resolution(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d).select("mention_id", "entity_text", "canonical", "resolver_method")
    changes = m.filter("mention_id % 4 = 0").select("mention_id", F.upper("entity_text").alias("canonical"), F.lit("cache").alias("resolver_method"))
    return store.update(m.drop("entity_text"), changes, "mention_id")


@query("""WITH c AS (SELECT country_code, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS c11 FROM mentions GROUP BY ALL), m AS (SELECT *, sum(c11) OVER (PARTITION BY country_code) AS r, sum(c11) OVER (PARTITION BY name) AS t, sum(c11) OVER () AS n FROM c)
SELECT country_code, name, c11, CASE WHEN c11 >= 20 THEN round(ln(c11::DOUBLE * n::DOUBLE / (r::DOUBLE * t::DOUBLE)), 6) END AS pmi FROM m""", ("mentions",))
def snk10_collocation_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics in the same projection as their counts; rows below the threshold have none."""
    c = tables.mentions(spark, d).groupBy("country_code", entities.filled_name().alias("name")).agg(F.count(F.lit(1)).alias("c11"))
    r, t = c.groupBy("country_code").agg(F.sum("c11").alias("r")), c.groupBy("name").agg(F.sum("c11").alias("t"))
    n = F.broadcast(r.agg(F.sum("r").alias("n")))  # one row
    m = c.join(r, "country_code").join(t, "name").join(n)
    return m.select("country_code", "name", "c11", F.when(F.col("c11") >= 20, F.round(pmi(F.col("c11"), F.col("r"), F.col("t"), F.col("n")), 6)).alias("pmi"))


@query("""SELECT country_code, CAST(collected_date AS VARCHAR) AS collected_date, count(*) AS profiles FROM (SELECT DISTINCT country_code, collected_date, title FROM news WHERE country_code IN ('DE', 'FR') AND collected_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-05' AND NOT (country_code = 'DE' AND collected_date = DATE '2024-01-04') AND (country_code <> 'FR' OR collected_date <> DATE '2024-01-04' OR id % 2 = 0)) GROUP BY ALL""", ("news",))
def snk11_replace_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Slices of a stored table: one is cleared by an empty write, one replaced by fewer rows, the rest stay."""
    n = tables.news(spark, d).filter(F.col("country_code").isin("DE", "FR") & F.col("collected_date").between("2024-01-03", "2024-01-05"))
    rows = n.select("country_code", "collected_date", "title").distinct()
    held = store.SliceStore(spark, scratch(spark, "profiles"))
    held.replace(rows, [{"country_code": c, "collected_date": f"2024-01-0{k}"} for c in ("DE", "FR") for k in (3, 4, 5)])
    half = n.filter("country_code = 'FR' and collected_date = date'2024-01-04' and id % 2 = 0").select("country_code", "collected_date", "title").distinct()
    held.replace(half, [{"country_code": c, "collected_date": "2024-01-04"} for c in ("DE", "FR")])
    out = held.rows("title string, country_code string, collected_date date")
    return out.groupBy("country_code", F.col("collected_date").cast("string").alias("collected_date")).agg(F.count(F.lit(1)).alias("profiles"))


@query("""WITH r AS (SELECT wikidata_qid, country_code, entity_type, mention_id, row_number() OVER (PARTITION BY wikidata_qid, country_code, entity_type ORDER BY mention_id % 2 DESC, mention_id DESC) AS k FROM mentions WHERE wikidata_qid IS NOT NULL AND (mention_id % 2 = 1 OR mention_id % 4 = 0))
SELECT wikidata_qid, country_code, entity_type, mention_id FROM r WHERE k = 1""", ("mentions",))
def snk12_explanation_cache(spark: SparkSession, d: str) -> DataFrame:
    """An upsert on a key of several parts: the newest of the new rows, else what was held."""
    m = tables.mentions(spark, d).filter("wikidata_qid is not null")
    keys = ["wikidata_qid", "country_code", "entity_type"]
    held = m.filter("mention_id % 4 = 0").groupBy(*keys).agg(F.max("mention_id").alias("mention_id"))
    new = m.filter("mention_id % 2 = 1").select(*keys, "mention_id")
    return store.upsert(held, new, keys, F.format_string("%020d", "mention_id"))


@query("SELECT id, CASE WHEN id % 3 = 0 THEN coalesce(CAST(id % 5 - 1 AS INTEGER), -1) ELSE cluster_id END AS cluster_id, CASE WHEN id % 3 = 0 AND id % 5 > 0 THEN 'topic ' || (id % 5 - 1) END AS cluster_title FROM news", ("news",))
def snk13_update_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters by id; noise is written as -1 and has no title."""
    n = tables.news(spark, d).select("id", "cluster_id", F.lit(None).cast("string").alias("cluster_title"))
    number = (F.col("id") % 5 - 1).cast("int")
    changes = n.filter("id % 3 = 0").select("id", number.alias("cluster_id"), F.when(number >= 0, F.concat(F.lit("topic "), number.cast("string"))).alias("cluster_title"))
    return store.update(n, changes, "id")


@query("""SELECT country_code, CAST(collected_date AS VARCHAR) AS collected_date, CAST(cluster_id AS INTEGER) AS cluster_id, count(*) AS size FROM news WHERE country_code = 'IT' AND collected_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-07' AND cluster_id >= 0 AND (collected_date <> DATE '2024-01-07' OR cluster_id < 2) GROUP BY ALL""", ("news",))
def snk14_cluster_summaries(spark: SparkSession, d: str) -> DataFrame:
    """A second run with fewer clusters leaves none of the first run's behind."""
    n = tables.news(spark, d).filter("country_code = 'IT' and cluster_id >= 0").filter(F.col("collected_date").between("2024-01-06", "2024-01-07"))
    sums = n.groupBy("country_code", "collected_date", "cluster_id").agg(F.count(F.lit(1)).alias("size"))
    held = store.SliceStore(spark, scratch(spark, "summaries"))
    held.replace(sums, [{"country_code": "IT", "collected_date": f"2024-01-0{k}"} for k in (6, 7)])
    held.replace(sums.filter("collected_date = date'2024-01-07' and cluster_id < 2"), [{"country_code": "IT", "collected_date": "2024-01-07"}])
    return held.rows("cluster_id int, size long, country_code string, collected_date date").withColumn("collected_date", F.col("collected_date").cast("string"))


@query("SELECT vec_id, round(CASE WHEN vec_id % 2 = 0 THEN 2 * list_sum(embedding::DOUBLE[]) ELSE list_sum(embedding::DOUBLE[]) END, 4) AS total FROM embeddings")
def snk15_update_embeddings(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    out = store.update(e, e.filter("vec_id % 2 = 0").select("vec_id", F.transform("embedding", lambda x: 2 * x).alias("embedding")), "vec_id")
    return out.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query(f"WITH {_DRIFT} SELECT country_code, collected_date, CASE WHEN country_code = 'DE' THEN 'again' ELSE status END AS status, psi FROM drift", ("news",))
def snk16_upsert_drift(spark: SparkSession, d: str) -> DataFrame:
    held = news.drift(tables.news(spark, d), least_rows=5).select("country_code", "collected_date", "status", "psi")
    return store.upsert(held, held.filter("country_code = 'DE'").withColumn("status", F.lit("again")), ["country_code", "collected_date"])


@query(f"WITH {_DRIFT} SELECT country_code, status, count(*) AS reports, round(sum(psi), 3) AS psi FROM drift GROUP BY ALL", ("news",))
def snk17_json_reports(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "reports")
    reviews.write_report(news.drift(tables.news(spark, d), least_rows=5), path)
    back = spark.read.schema("country_code string, status string, psi double").json(path)
    return back.groupBy("country_code", "status").agg(F.count(F.lit(1)).alias("reports"), F.round(F.sum("psi"), 3).alias("psi"))


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role FROM conversations ORDER BY md5('7:' || conv_id), conv_id, turn LIMIT 40")
def snk18_csv_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sample for review, whose size is the feature, written with a fixed header and read again."""
    path = scratch(spark, "sample")
    rows = tables.table(spark, d, "conversations").orderBy(F.md5(F.concat(F.lit("7:"), F.col("conv_id").cast("string"))), "conv_id", "turn").limit(40)
    reviews.write_reviews(rows, path, ["conv_id", "turn", "role"])
    return spark.read.csv(path, header=True)


@query(f"""WITH {_DRIFT} SELECT country_code, CAST(collected_date AS VARCHAR) AS day, '### Drift ' || country_code || ' ' || collected_date || ': ' || status AS head, CASE WHEN status = 'ok' THEN severity END AS severity FROM drift""", ("news",))
def snk19_step_summary(spark: SparkSession, d: str) -> DataFrame:
    """Reports in words, as the daily step shows them: the first line, and the severity that the text names."""
    out = news.drift(tables.news(spark, d), least_rows=5).withColumn("text", reviews.drift_text())
    found = F.regexp_extract("text", r"PSI [0-9.-]+ \((\w+)\)", 1)
    return out.select("country_code", F.col("collected_date").cast("string").alias("day"), F.split("text", "\n")[0].alias("head"), F.nullif(found, F.lit("")).alias("severity"))


@query("SELECT 'score' AS step, unnest(['rows', 'labelled', 'mean_score']) AS metric, unnest([count(*)::DOUBLE, count(sentiment_label)::DOUBLE, round(avg(sentiment_score), 6)]) AS value FROM news", ("news",))
def snk20_metrics(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d)
    return reviews.metrics("score", n, rows=F.count(F.lit(1)), labelled=F.count("sentiment_label"), mean_score=F.round(F.avg("sentiment_score"), 6))


# ---------------------------------------------------------------- clusters


@query("""WITH u AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings WHERE embedding IS NOT NULL),
x AS (SELECT vec_id, label, list_transform(e, lambda v: v / n) AS e FROM u WHERE n > 0), p AS (SELECT a.vec_id, a.label AS own, b.label AS other, avg(1 - list_inner_product(a.e, b.e)) FILTER (a.vec_id <> b.vec_id) AS dist, count(*) AS size FROM x a, x b GROUP BY ALL),
s AS (SELECT vec_id, own, max(dist) FILTER (own = other) AS a, min(dist) FILTER (own <> other) AS b, max(size) FILTER (own = other) AS size FROM p GROUP BY ALL)
SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 5) AS silhouette, count(*) AS vectors FROM s""")
def agg27_label_silhouette(spark: SparkSession, d: str) -> DataFrame:
    """Cosine silhouette of given clusters from their sums, without pairs: equal to the mean over all pairs."""
    e = tables.table(spark, d, "embeddings").select("vec_id", F.col("label").alias("cluster_id"), "embedding")
    return clustering.silhouette_rows(e).agg(F.round(F.avg("silhouette"), 5).alias("silhouette"), F.count(F.lit(1)).alias("vectors"))


@query("""WITH s AS (SELECT country_code, collected_date, cluster_id, count(*) AS size, count(*) FILTER (sentiment_label = 'negative') AS negative FROM news WHERE is_target_language AND cluster_id IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY country_code, collected_date ORDER BY size DESC, cluster_id) AS rank FROM s WHERE cluster_id >= 0)
SELECT country_code, collected_date, cluster_id, size, negative, rank FROM r WHERE rank <= 5""", ("news",))
def top06_largest_clusters(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d).filter("is_target_language and cluster_id >= 0")
    return clustering.largest(n, ["country_code", "collected_date"], 5, negative=F.count_if(F.col("sentiment_label") == LABELS[0]))


@query("""WITH s AS (SELECT country_code, collected_date, cluster_id, count(*) AS size FROM news WHERE is_target_language AND cluster_id >= 0 GROUP BY ALL)
SELECT n.id, n.country_code, coalesce(s.size, 0) AS cluster_size FROM news n LEFT JOIN s USING (country_code, collected_date, cluster_id)""", ("news",))
def join10_cluster_members(spark: SparkSession, d: str) -> DataFrame:
    """Articles with the size of their cluster; noise and articles of other languages have none."""
    n = tables.news(spark, d)
    keys = ["country_code", "collected_date", "cluster_id"]
    sizes = n.filter("is_target_language and cluster_id >= 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return n.join(sizes, keys, "left").select("id", "country_code", F.coalesce("size", F.lit(0)).alias("cluster_size"))


@query("""WITH a AS (SELECT vec_id % 4 AS day, vec_id, CAST(label % 3 AS INTEGER) - 1 AS cluster_id FROM embeddings), c AS (SELECT day, cluster_id, count(*) AS size FROM a WHERE cluster_id >= 0 GROUP BY ALL),
q AS (SELECT day, count(*) AS n, round(count(*) FILTER (cluster_id < 0) / count(*)::DOUBLE, 6) AS noise FROM a GROUP BY 1)
SELECT q.day, count(c.cluster_id) AS clusters, max(c.size) AS largest, any_value(noise) AS noise, coalesce(max(c.size) / any_value(n)::DOUBLE > 0.25, false) OR any_value(noise) > 0.4 AS warn FROM q LEFT JOIN c USING (day) GROUP BY 1""")
def ml11_clustering_run(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of each day with their metrics and warnings; the labels stand for a clusterer's output."""
    e = tables.table(spark, d, "embeddings").select((F.col("vec_id") % 4).alias("day"), "vec_id", ((F.col("label") % 3).cast("int") - 1).alias("cluster_id"))
    return clustering.run_metrics(e, ["day"])
