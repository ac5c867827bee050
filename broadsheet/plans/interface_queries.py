"""Queries of the interface, the dashboard and the monitors, and the selections and scalars that they rest on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions import entities as names
from broadsheet.functions import text
from broadsheet.functions.association import llr, percent, pmi, ratio
from broadsheet.functions.scores import LABELS
from broadsheet.functions.urls import CATEGORIES
from broadsheet.operators import collocations, entities, explain, news, requests, similarity
from broadsheet.plans.news_queries import _DRIFT_SQL, AS_OF
from broadsheet.plans.registry import query
from broadsheet.sources import tables

_DRIFT = f"drift AS ({_DRIFT_SQL.format(rows=5).strip()})"
_COUNTS = ", ".join(f"count(*) FILTER (sentiment_label = '{k}') AS {k}" for k in LABELS)


# ---------------------------------------------------------------- selections


@query("SELECT id, title FROM news WHERE country_code = 'DE' AND collected_date = DATE '2024-01-05'", ("news",))
def fil01_slice(spark: SparkSession, d: str) -> DataFrame:
    return news.in_slice(tables.news(spark, d), "2024-01-05", "DE").select("id", "title")


@query("SELECT unnest(['missing', 'missing and stale', 'limit 0']) AS mode, unnest([true, false, false]) AS allowed")
def fil04_modes(spark: SparkSession, d: str) -> DataFrame:
    asked = {"missing": {"only_missing": True, "limit": 5}, "missing and stale": {"only_missing": True, "only_stale": True}, "limit 0": {"limit": 0}}

    def allowed(kw):
        try:
            requests.checked_mode(**kw)
        except ValueError:
            return False
        return True

    return spark.createDataFrame([(k, allowed(kw)) for k, kw in asked.items()], "mode string, allowed boolean")


@query("SELECT country_code, collected_date, count(*) AS n FROM news WHERE collected_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-09' GROUP BY ALL", ("news",))
def fil08_date_range(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d).filter(F.col("collected_date").between("2024-01-03", "2024-01-09"))
    return n.groupBy("country_code", "collected_date").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT mention_id FROM mentions WHERE wikidata_qid IN ('Q1', 'Q5', 'Q9')", ("mentions",))
def fil11_any_of(spark: SparkSession, d: str) -> DataFrame:
    return tables.mentions(spark, d).filter(F.col("wikidata_qid").isin("Q1", "Q5", "Q9")).select("mention_id")


@query(f"SELECT id, coalesce(category IN {CATEGORIES}, false) AS known FROM news WHERE country_code IN ('DE', 'FR')", ("news",))
def fil13_validated(spark: SparkSession, d: str) -> DataFrame:
    """Articles of the countries that a request asks for, with whether their category is in the vocabulary."""
    asked = requests.checked_countries("de, fr,DE", set(tables.COUNTRIES))
    requests.checked_window(7)
    return tables.news(spark, d).filter(F.col("country_code").isin(*asked)).select("id", F.coalesce(requests.valid_vocabulary(F.col("category"), F.lit("category")), F.lit(False)).alias("known"))


@query("SELECT DISTINCT term, len(list_filter(string_split(term, ' '), lambda x: x NOT IN ('view', '1', '2') AND length(x) > 1)) > 0 AS informative FROM (SELECT title AS term FROM news UNION SELECT 'view 1')", ("news",))
def fil18_informative_terms(spark: SparkSession, d: str) -> DataFrame:
    stop = F.array(*map(F.lit, ("view", "1", "2")))
    terms = tables.news(spark, d).select(F.col("title").alias("term")).unionByName(spark.createDataFrame([("view 1",)], "term string")).distinct()
    return terms.select("term", F.exists(F.split("term", " "), lambda t: ~F.array_contains(stop, t) & (F.length(t) > 1)).alias("informative"))


@query("SELECT id, title, source_name, category, sentiment_label FROM news WHERE sentiment_label IS NOT NULL", ("news",))
def fil19_api_columns(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).filter("sentiment_label is not null").select("id", "title", "source_name", "category", "sentiment_label")


@query("SELECT country_code, count(*) AS articles FROM news WHERE country_code IN ('DE', 'FR') GROUP BY 1", ("news",))
def fil21_step_gates(spark: SparkSession, d: str) -> DataFrame:
    """Articles of the countries whose section is on: DE says so, FR has it without a flag, IT turns it off, TR lacks it."""
    rows = [("DE", {"frames": True}), ("FR", {"frames": None}), ("IT", {"frames": False}), ("TR", {"ner": True})]
    on = requests.enabled(spark.createDataFrame(rows, "country_code string, sections map<string,boolean>"), "frames")
    return tables.news(spark, d).join(on, "country_code").groupBy("country_code").agg(F.count(F.lit(1)).alias("articles"))


@query("""WITH m AS (SELECT article_id, mention_id, collected_date, row_number() OVER (PARTITION BY article_id ORDER BY position_in_article NULLS LAST, mention_id) AS k FROM mentions WHERE wikidata_qid = 'Q4' AND collected_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31')
SELECT m.article_id, m.mention_id, n.source_name FROM m JOIN news n ON n.id = m.article_id WHERE k = 1 ORDER BY n.collected_date DESC, m.article_id LIMIT 40""", ("mentions", "news"))
def join02_entity_articles(spark: SparkSession, d: str) -> DataFrame:
    """The newest forty articles of an entity in a range of days, each with its first mention."""
    m = tables.mentions(spark, d).filter(entities.ref_filter("Q4") & F.col("collected_date").between("1994-01-01", "1996-12-31"))
    return entities.first_per_article(m, tables.news(spark, d), 40).select("article_id", "mention_id", "source_name")


_MARGINALS = "SELECT country_code, name, kind, c11, CAST(sum(c11) OVER (PARTITION BY country_code, name) AS BIGINT) AS r, CAST(sum(c11) OVER (PARTITION BY country_code, kind) AS BIGINT) AS t, CAST(sum(c11) OVER (PARTITION BY country_code) AS BIGINT) AS n FROM (SELECT country_code, coalesce(nullif(canonical, ''), entity_text) AS name, entity_type AS kind, count(*) AS c11 FROM mentions GROUP BY ALL)"


def _marginals(spark: SparkSession, d: str) -> DataFrame:
    c = tables.mentions(spark, d).groupBy("country_code", entities.filled_name().alias("canonical"), F.col("entity_type").alias("lemma")).agg(F.count(F.lit(1)).alias("c11"))
    return collocations.with_marginals(c, ["country_code"]).withColumnsRenamed({"canonical": "name", "lemma": "kind"})


@query(_MARGINALS, ("mentions",))
def win06_marginals(spark: SparkSession, d: str) -> DataFrame:
    return _marginals(spark, d).select("country_code", "name", "kind", "c11", "r", "t", "n")


@query(f"SELECT country_code, name, kind, round(ln(c11::DOUBLE * n / (r::DOUBLE * t)), 6) AS pmi FROM ({_MARGINALS})", ("mentions",))
def sca14_pmi(spark: SparkSession, d: str) -> DataFrame:
    return _marginals(spark, d).select("country_code", "name", "kind", F.round(pmi(F.col("c11"), F.col("r"), F.col("t"), F.col("n")), 6).alias("pmi"))


_XLX = "CASE WHEN {0} > 0 THEN ({0})::DOUBLE * ln(({0})::DOUBLE) ELSE 0 END"
_LLR = "greatest(0, 2 * (" + " + ".join(_XLX.format(x) for x in ("c11", "(r - c11)", "(t - c11)", "(n - r - t + c11)")) + " - " + " - ".join(_XLX.format(x) for x in ("r", "(n - r)", "t", "(n - t)")) + " + " + _XLX.format("n") + "))"


@query(f"SELECT country_code, name, kind, round({_LLR}, 4) AS llr FROM ({_MARGINALS})", ("mentions",))
def sca15_llr(spark: SparkSession, d: str) -> DataFrame:
    return _marginals(spark, d).select("country_code", "name", "kind", F.round(llr(F.col("c11"), F.col("r"), F.col("t"), F.col("n")), 4).alias("llr"))


@query("SELECT country_code, strftime(DATE '2024-01-30' - 7, '%Y-%m-%d') AS since, strftime(max(collected_date), '%Y-%m-%d') AS latest, date_diff('day', max(collected_date), DATE '2024-03-01') AS days_ago FROM news GROUP BY 1", ("news",))
def sca26_dates(spark: SparkSession, d: str) -> DataFrame:
    top = F.max("collected_date")
    return tables.news(spark, d).groupBy("country_code").agg(F.date_format(F.date_sub(F.lit("2024-01-30").cast("date"), 7), "yyyy-MM-dd").alias("since"), F.date_format(top, "yyyy-MM-dd").alias("latest"), F.datediff(F.lit("2024-03-01").cast("date"), top).cast("bigint").alias("days_ago"))


@query("SELECT DISTINCT entity_text, CASE WHEN entity_text LIKE '% Jr' THEN regexp_replace(entity_text, 'Jr$', 'JR') ELSE entity_text END AS shown FROM mentions", ("mentions",))
def sca13_display_names(spark: SparkSession, d: str) -> DataFrame:
    return tables.mentions(spark, d).select("entity_text").distinct().select("entity_text", names.display_name(F.col("entity_text")).alias("shown"))


@query("""WITH t AS (SELECT item_id, text, instr(lower(text), 'the') AS at FROM benchmark)
SELECT item_id, length(text) <= 320 AS whole, CASE WHEN length(text) <= 320 THEN text END AS snippet FROM t""")
def sca20_short_snippets(spark: SparkSession, d: str) -> DataFrame:
    """Short texts whole; of longer ones only that they were cut, which the unit tests look into."""
    s = text.snippet(F.col("text"), F.lit("the"))
    whole = ~s.contains("…") | (F.length("text") <= text.SNIPPET_CHARS)
    return tables.table(spark, d, "benchmark").select("item_id", whole.alias("whole"), F.when(whole, s).alias("snippet"))


@query("""SELECT entity_type, sha256('{"top_collocates":[],"frame_intensities":{},"avg_pmi":0.5,"avg_llr":2.0,"total_mentions":' || count(*) || ',"coverage_days":' || count(DISTINCT collected_date) || '}') AS profile_hash FROM mentions GROUP BY 1""", ("mentions",))
def sca21_profile_hash(spark: SparkSession, d: str) -> DataFrame:
    p = tables.mentions(spark, d).groupBy("entity_type").agg(F.count(F.lit(1)).alias("total_mentions"), F.count_distinct("collected_date").alias("coverage_days"))
    p = p.withColumns({"top_collocates": F.array().cast("array<string>"), "frame_intensities": F.create_map().cast("map<string,double>"), "avg_pmi": F.lit(0.5), "avg_llr": F.lit(2.0)})
    return p.select("entity_type", explain.profile_hash().alias("profile_hash"))


@query("SELECT doc_id, regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])(krieg|war)[\\p{L}\\p{N}_]*') OR regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])the($|[^\\p{L}\\p{N}_])') AS cue FROM documents")
def sca23_cues(spark: SparkSession, d: str) -> DataFrame:
    return tables.table(spark, d, "documents").select("doc_id", text.has_cue(F.lower("text"), ["krieg", "war", "=the"]).alias("cue"))


@query("SELECT id, coalesce(analyzed_hour < fetched_hour, false) AS stale, coalesce(analyzed_hour >= fetched_hour, false) AS after_body FROM news WHERE sentiment_label IS NOT NULL", ("news",))
def sca24_staleness(spark: SparkSession, d: str) -> DataFrame:
    a, f = F.col("analyzed_hour"), F.col("fetched_hour")
    return tables.news(spark, d).filter("sentiment_label is not null").select("id", F.coalesce(a < f, F.lit(False)).alias("stale"), F.coalesce(a >= f, F.lit(False)).alias("after_body"))


@query("SELECT s_suppkey, round(CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE CASE s_suppkey % 4 WHEN 0 THEN 0.55 WHEN 2 THEN 0.35 ELSE 0 END + CASE WHEN s_suppkey % 2 = 0 THEN 0.15 ELSE 0 END + CASE WHEN s_suppkey % 3 = 0 THEN 0.10 ELSE 0 END + 0.05 END::DOUBLE, 4) AS score FROM supplier")
def sca25_candidate_score(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    label = F.when(k % 4 == 0, "jane doe").when(k % 4 == 2, "jane").otherwise("other")
    told = F.concat(F.when(k % 2 == 0, "a politician").otherwise("someone"), F.when(k % 3 == 0, " of germany").otherwise(""), F.when(k % 5 == 0, " surname").otherwise(""))
    score = names.candidate_score(F.lit("jane doe"), label, F.lit(None).cast("array<string>"), told, F.array(F.lit("politician")), F.array(F.lit("germany")), F.concat(F.lit("Q"), k.cast("string")))
    return tables.table(spark, d, "supplier").select("s_suppkey", F.round(score, 4).alias("score"))


@query("""SELECT conv_id AS batch, conv_id % 3 <> 1 AS usable, CASE WHEN conv_id % 3 <> 1 THEN CAST(count(*) AS BIGINT) END AS labelled FROM conversations GROUP BY 1""")
def sca30_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Answers with an array in the midst of words; those of every third batch have a label that is not known."""
    c = tables.table(spark, d, "conversations").select(F.col("conv_id").alias("batch"), F.col("turn").cast("string").alias("id")).distinct()
    label = F.when(F.col("batch") % 3 == 1, "angry").otherwise("neutral")
    answers = c.groupBy("batch").agg(F.concat(F.lit("Here it is: "), F.to_json(F.collect_list(F.struct("id", label.alias("label"), F.lit("w " * 20).alias("rationale")))), F.lit(" done")).alias("answer"))
    out = requests.annotations(answers, c, LABELS)
    short = F.forall("items", lambda i: F.size(F.split(i["rationale"], " ")) == requests.MOST_RATIONALE)
    return out.select("batch", "usable", F.when(F.col("usable") & short, F.size("items").cast("bigint")).alias("labelled"))


@query("SELECT conv_id, turn FROM conversations WHERE conv_id % 2 = 1")
def ml15_resumed_annotation(spark: SparkSession, d: str) -> DataFrame:
    c = tables.table(spark, d, "conversations").select("conv_id", "turn")
    return requests.still_to_do(c, c.filter("conv_id % 2 = 0").select("conv_id").distinct(), "conv_id")


@query("SELECT country_code, strftime(max(collected_date), '%Y-%m-%d') AS end_date, 0 AS collocates, count(*) AS total_mentions FROM mentions GROUP BY 1", ("mentions",))
def sca31_served_profiles(spark: SparkSession, d: str) -> DataFrame:
    p = tables.mentions(spark, d).groupBy("country_code").agg(F.max("collected_date").alias("end_date"), F.lit(None).cast("array<string>").alias("collocates"), F.count(F.lit(1)).alias("total_mentions"))
    return requests.served(p).withColumn("collocates", F.size("collocates"))


# ---------------------------------------------------------------- top and set


@query(f"WITH {_DRIFT}, r AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY collected_date DESC) AS k FROM drift) SELECT country_code, collected_date, status, psi FROM r WHERE k <= 3", ("news",))
def top04_drift_history(spark: SparkSession, d: str) -> DataFrame:
    """The three latest reports of each country; the number is the feature."""
    w = Window.partitionBy("country_code").orderBy(F.col("collected_date").desc())
    r = news.drift(tables.news(spark, d), least_rows=5).withColumn("k", F.row_number().over(w))
    return r.filter("k <= 3").select("country_code", "collected_date", "status", "psi")


@query("SELECT country_code, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS mentions FROM mentions WHERE country_code = 'ES' GROUP BY ALL ORDER BY mentions DESC, name LIMIT 50", ("mentions",))
def top05_profiles_for_audit(spark: SparkSession, d: str) -> DataFrame:
    m = tables.mentions(spark, d).filter("country_code = 'ES'")
    return m.groupBy("country_code", entities.filled_name().alias("name")).agg(F.count(F.lit(1)).alias("mentions")).orderBy(F.col("mentions").desc(), "name").limit(50)


@query("""WITH s AS (SELECT source_name, count(*) FILTER (parse_status IS NOT NULL) AS fetched, count(*) AS total, count(*) FILTER (parse_status = 'parsed') < 0.6 * count(*) FILTER (parse_status IS NOT NULL) AS needs_attention FROM news GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY needs_attention DESC, fetched DESC, total DESC, source_name) AS place FROM s""", ("news",))
def top10_attention_order(spark: SparkSession, d: str) -> DataFrame:
    """Sources in the order in which they need a look. One row a source, so numbering them in one task is bounded."""
    fetched = F.count_if(F.col("parse_status").isNotNull())
    s = tables.news(spark, d).groupBy("source_name").agg(fetched.alias("fetched"), F.count(F.lit(1)).alias("total"), (F.count_if(F.col("parse_status") == "parsed") < 0.6 * fetched).alias("needs_attention"))
    w = Window.orderBy(F.col("needs_attention").desc(), F.col("fetched").desc(), F.col("total").desc(), "source_name")
    return s.withColumn("place", F.row_number().over(w))


_ARGMAX = "CASE WHEN negative = greatest(negative, neutral, positive) THEN 'negative' WHEN neutral = greatest(negative, neutral, positive) THEN 'neutral' ELSE 'positive' END"


@query(f"SELECT country_code, collected_date, {_ARGMAX} AS label FROM (SELECT country_code, collected_date, {_COUNTS} FROM news GROUP BY ALL)", ("news",))
def top12_dominant_label(spark: SparkSession, d: str) -> DataFrame:
    c = tables.news(spark, d).groupBy("country_code", "collected_date").agg(*news.counts_of("sentiment_label", LABELS))
    ranked = F.array_max(F.array(*[F.struct(F.col(k).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("k")) for i, k in enumerate(LABELS)]))
    return c.select("country_code", "collected_date", ranked["k"].alias("label"))


@query("SELECT country_code, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-15', INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT country_code FROM news) EXCEPT SELECT country_code, collected_date FROM news WHERE parse_status = 'parsed'", ("news",))
def set04_days_to_backfill(spark: SparkSession, d: str) -> DataFrame:
    n = tables.news(spark, d)
    days = F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-02-15").cast("date"))).alias("day")
    return n.select("country_code").distinct().select("country_code", days).exceptAll(n.filter("parse_status = 'parsed'").select("country_code", "collected_date").distinct())


@query("SELECT DISTINCT country_code, source_name FROM news", ("news",))
def set06_distinct_sources(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).select("country_code", "source_name").distinct()


# ---------------------------------------------------------------- interface


@query("SELECT 'broadsheet' AS name, count(DISTINCT country_code) AS countries, count(DISTINCT source_name) AS sources FROM news", ("news",))
def api02_about(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).agg(F.count_distinct("country_code").alias("countries"), F.count_distinct("source_name").alias("sources")).withColumn("name", F.lit("broadsheet"))


@query("SELECT DISTINCT strftime(collected_date, '%Y-%m-%d') AS day FROM news WHERE country_code = 'TR'", ("news",))
def api07_dates(spark: SparkSession, d: str) -> DataFrame:
    return tables.news(spark, d).filter("country_code = 'TR'").select(F.date_format("collected_date", "yyyy-MM-dd").alias("day")).distinct()


@query("WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 4) AS similarity FROM embeddings, q WHERE label % 2 = 0 ORDER BY list_cosine_similarity(embedding::DOUBLE[], q) DESC, vec_id LIMIT 10")
def api09_similar(spark: SparkSession, d: str) -> DataFrame:
    """The ten rows of a country nearest to a question, whose vector the provider gives: here the first vector's."""
    e = tables.table(spark, d, "embeddings")
    q = e.orderBy("vec_id").select(F.col("embedding").cast("array<double>").alias("q")).first()
    return similarity.nearest(e.filter("label % 2 = 0"), q.q if q else [0.0], 10)


@query(f"WITH {_DRIFT} SELECT collected_date, status, psi, severity FROM drift WHERE country_code = 'FR' ORDER BY collected_date DESC LIMIT 1", ("news",))
def api10_latest_drift(spark: SparkSession, d: str) -> DataFrame:
    r = news.drift(tables.news(spark, d).filter("country_code = 'FR'"), least_rows=5)
    return r.orderBy(F.col("collected_date").desc()).limit(1).select("collected_date", "status", "psi", "severity")


@query(f"WITH {_DRIFT} SELECT country_code, collected_date, psi FROM drift WHERE collected_date >= DATE '{AS_OF}' - 20", ("news",))
def api11_drift_values(spark: SparkSession, d: str) -> DataFrame:
    r = news.drift(tables.news(spark, d), least_rows=5)
    return r.filter(F.col("collected_date") >= F.date_sub(F.lit(AS_OF).cast("date"), 20)).select("country_code", "collected_date", "psi")


@query("""WITH g AS (SELECT entity_type, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS mentions, max(wikidata_qid) AS wikidata_qid FROM mentions WHERE country_code = 'DE' GROUP BY ALL)
SELECT * FROM g WHERE entity_type = 'PER' AND name ILIKE '%name 1%' ORDER BY mentions DESC, name LIMIT 20""", ("mentions",))
def api13_entities(spark: SparkSession, d: str) -> DataFrame:
    """The directory for a question, a type and a limit."""
    m = tables.mentions(spark, d).filter("country_code = 'DE'")
    g = m.groupBy("entity_type", entities.filled_name().alias("name")).agg(F.count(F.lit(1)).alias("mentions"), F.max("wikidata_qid").alias("wikidata_qid"))
    return g.filter((F.col("entity_type") == "PER") & F.col("name").ilike("%name 1%")).orderBy(F.col("mentions").desc(), "name").limit(20)


@query("""WITH g AS (SELECT country_code, coalesce(nullif(canonical, ''), entity_text) AS name, count(*) AS mentions, count(DISTINCT collected_date) AS days, max(collected_date) AS last FROM mentions WHERE wikidata_qid = 'Q7' AND country_code = 'IT' GROUP BY ALL)
SELECT name, mentions, days, strftime(last, '%Y-%m-%d') AS last_day FROM g ORDER BY mentions DESC, name LIMIT 1""", ("mentions",))
def api14_profile(spark: SparkSession, d: str) -> DataFrame:
    """The profile that a reference stands for in a country: that of its most frequent name, shaped as it is sent."""
    m = tables.mentions(spark, d).filter(entities.ref_filter("Q7") & (F.col("country_code") == "IT"))
    g = m.groupBy("country_code", entities.filled_name().alias("name")).agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("collected_date").alias("days"), F.max("collected_date").alias("last_day"))
    return requests.served(g.orderBy(F.col("mentions").desc(), "name").limit(1)).drop("country_code")


@query("SELECT unnest(['requests_total', 'errors_total', 'seconds_sum']) AS metric, unnest([count(*)::DOUBLE, count(*) FILTER (event_type = 'error')::DOUBLE, round(sum(value), 3)]) AS value FROM events")
def api18_metrics(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "events").agg(F.count(F.lit(1)).cast("double").alias("requests_total"), F.count_if(F.col("event_type") == "error").cast("double").alias("errors_total"), F.round(F.sum("value"), 3).alias("seconds_sum"))
    return e.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in e.columns])).alias("m")).select("m.*")


# ---------------------------------------------------------------- dashboard and monitors


@query(f"WITH c AS (SELECT country_code, {_COUNTS} FROM news GROUP BY 1) SELECT country_code, " + ", ".join(f"round({k}::DOUBLE / nullif(negative + neutral + positive, 0), 6) AS {k}" for k in LABELS) + " FROM c", ("news",))
def dsh03_gauge_shares(spark: SparkSession, d: str) -> DataFrame:
    c = tables.news(spark, d).groupBy("country_code").agg(*news.counts_of("sentiment_label", LABELS))
    whole = sum(F.col(k) for k in LABELS)
    return c.select("country_code", *[F.round(ratio(F.col(k), whole), 6).alias(k) for k in LABELS])


@query("SELECT article_id % 8 AS topic, entity_type, array_to_string(list_sort(list_distinct(list(entity_text)))[:10], '|') AS names FROM mentions GROUP BY ALL", ("mentions",))
def dsh04_topic_entities(spark: SparkSession, d: str) -> DataFrame:
    """The first ten distinct surfaces of each type in a topic, from articles' arrays of them."""
    arrays = tables.mentions(spark, d).groupBy((F.col("article_id") % 8).alias("topic"), "article_id", "entity_type").agg(F.collect_set("entity_text").alias("names"))
    flat = arrays.select("topic", "entity_type", F.explode("names").alias("name")).distinct()
    w = Window.partitionBy("topic", "entity_type").orderBy("name")
    top = flat.withColumn("k", F.row_number().over(w)).filter("k <= 10")
    return top.groupBy("topic", "entity_type").agg(F.array_join(F.array_sort(F.collect_list("name")), "|").alias("names"))


@query("""WITH k AS (SELECT cluster_id, title, count(*) AS n FROM news WHERE cluster_id >= 0 GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, title) AS rank FROM k)
SELECT cluster_id, string_agg(title, ' ' ORDER BY rank) AS question FROM r WHERE rank <= 2 GROUP BY 1""", ("news",))
def dsh05_similar_question(spark: SparkSession, d: str) -> DataFrame:
    """What a topic asks similar articles for: its first two keywords."""
    k = tables.news(spark, d).filter("cluster_id >= 0").groupBy("cluster_id", "title").agg(F.count(F.lit(1)).alias("n"))
    ranked = k.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.col("n").desc(), "title"))).filter("rank <= 2")
    return ranked.groupBy("cluster_id").agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"])).alias("question"))


_PIVOT = ", ".join(f"coalesce(max(share) FILTER (country_code = '{c}'), 0.0) AS {c.lower()}" for c in tables.COUNTRIES)


@query(f"""WITH c AS (SELECT country_code, category, count(*) AS n FROM news WHERE category IS NOT NULL AND category <> 'other' GROUP BY ALL), s AS (SELECT country_code, category, round(n::DOUBLE / sum(n) OVER (PARTITION BY country_code), 6) AS share FROM c)
SELECT category, {_PIVOT} FROM s GROUP BY 1 HAVING count(DISTINCT country_code) >= 2""", ("news",))
def dsh07_radar(spark: SparkSession, d: str) -> DataFrame:
    """Shares by country side by side, zero where missing, for what at least two countries have."""
    c = tables.news(spark, d).filter("category is not null and category <> 'other'").groupBy("country_code", "category").agg(F.count(F.lit(1)).alias("n"))
    s = c.join(c.groupBy("country_code").agg(F.sum("n").alias("all")), "country_code").withColumn("share", F.round(F.col("n") / F.col("all"), 6))
    signal = s.groupBy("category").agg(F.count_distinct("country_code").alias("k")).filter("k >= 2").select("category")
    wide = s.join(signal, "category").groupBy("category").pivot("country_code", list(tables.COUNTRIES)).agg(F.max("share")).fillna(0.0)
    return wide.select("category", *[F.col(c).alias(c.lower()) for c in tables.COUNTRIES])


@query(f"SELECT country_code, name, kind, round(llr / greatest(max(llr) OVER (PARTITION BY country_code), 1), 4) AS width FROM (SELECT country_code, name, kind, {_LLR} AS llr FROM ({_MARGINALS}))", ("mentions",))
def dsh08_bars(spark: SparkSession, d: str) -> DataFrame:
    """Widths of bars relative to the country's largest, which counts as at least 1."""
    rows = _marginals(spark, d).withColumn("llr", llr(F.col("c11"), F.col("r"), F.col("t"), F.col("n")))
    top = rows.groupBy("country_code").agg(F.greatest(F.max("llr"), F.lit(1.0)).alias("top"))
    return rows.join(top, "country_code").select("country_code", "name", "kind", F.round(F.col("llr") / F.col("top"), 4).alias("width"))


@query(f"WITH {_DRIFT}, r AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY collected_date DESC) AS k FROM drift) SELECT country_code, psi, coalesce(psi >= 0.25, false) AS alarm FROM r WHERE k = 1", ("news",))
def mon02_drift_panels(spark: SparkSession, d: str) -> DataFrame:
    gauges = news.drift_gauges(news.drift(tables.news(spark, d), least_rows=5))
    psi = F.max(F.when(F.col("metric") == "drift_psi", F.col("value")))
    return gauges.groupBy("country_code").agg(psi.alias("psi"), F.coalesce(psi >= 0.25, F.lit(False)).alias("alarm"))


# ---------------------------------------------------------------- streams, run over what has arrived


@query("SELECT CAST(ts AS DATE) AS collected_date, count(*) FILTER (event_type = 'error') AS negative, count(*) FILTER (event_type = 'view') AS neutral, 0 AS positive, count(*) FILTER (event_type IN ('error', 'view')) AS total FROM events GROUP BY 1")
def str02_daily_labels(spark: SparkSession, d: str) -> DataFrame:
    from broadsheet.streaming import news as streams

    label = F.when(F.col("event_type") == "error", "negative").when(F.col("event_type") == "view", "neutral")
    rows = tables.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), label.alias("sentiment_label"))
    return streams.daily_labels(rows)


@query("WITH w AS (SELECT CAST(ts AS DATE) + unnest([1, 2, 3, 4, 5, 6, 7])::INTEGER AS end_date FROM events) SELECT end_date, count(*) AS n FROM w GROUP BY 1")
def str03_rolling_week(spark: SparkSession, d: str) -> DataFrame:
    from broadsheet.streaming import news as streams

    return streams.rolling(tables.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts")))


@query("SELECT doc_id, quality, round(100.0 * count(*) OVER (PARTITION BY quality) / count(*) OVER (), 1) AS pct FROM labels")
def ml13_class_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a training set with the share of their class, from counts that are joined back."""
    rows = tables.table(spark, d, "labels").select("doc_id", "quality")
    by = rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    whole = F.broadcast(by.agg(F.sum("n").alias("all")))  # one row
    return rows.join(by.join(whole).select("quality", percent(F.col("n"), F.col("all")).alias("pct")), "quality")
