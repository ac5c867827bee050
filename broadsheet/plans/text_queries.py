"""Queries over texts, pages, vectors and labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions import association, text, urls
from broadsheet.operators import collocations, evaluation, keywords, lemmas, rolling, similarity
from broadsheet.operators.entities import snippets
from broadsheet.plans.registry import query
from broadsheet.sources import tables
from broadsheet.sources.pages import page_meta
from broadsheet.sources.shared import fresh_path, small_splits, stored

END = "2024-01-30"

#: Sentences, words, mentions and pairs of the articles view.
PAIRS_SQL = r"""
raw AS (SELECT id, country_code, collected_date, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')) AS w, generate_subscripts(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'), 1) AS i FROM articles),
sent AS (SELECT *, sum(CASE WHEN regexp_matches(w, '^[^\p{L}\p{N}_]*[.!?]+\s') THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS s FROM raw),
words AS (SELECT *, lower(w) AS lemma, row_number() OVER (PARTITION BY id ORDER BY i) AS k FROM sent WHERE regexp_matches(w, '^[\p{L}\p{N}_]')),
pairs AS (SELECT m.id, m.country_code, m.collected_date, m.w AS canonical, t.lemma FROM words m JOIN words t ON t.id = m.id AND t.s = m.s AND t.k BETWEEN m.k - 10 AND m.k + 10 AND t.k <> m.k
  WHERE regexp_matches(m.w, '^\p{Lu}\p{Ll}{3,}$') AND length(t.w) >= 3),
counts AS (SELECT country_code, collected_date, canonical, lemma, count(*) AS c11 FROM pairs GROUP BY ALL HAVING count(*) >= 2)"""


def _measures(c11: str, r: str, t: str, n: str, digits: int = 6) -> str:
    x = lambda e: f"(CASE WHEN ({e}) > 0 THEN ({e})::DOUBLE * ln(({e})::DOUBLE) ELSE 0 END)"
    cells = " + ".join(x(e) for e in (c11, f"{r} - {c11}", f"{t} - {c11}", f"{n} - {r} - {t} + {c11}"))
    return (
        f"round(ln({c11}::DOUBLE * {n}::DOUBLE / ({r}::DOUBLE * {t}::DOUBLE)), {digits}) AS pmi, "
        f"round(greatest(0::DOUBLE, 2 * ({cells} - {x(r)} - {x(f'{n} - {r}')} - {x(t)} - {x(f'{n} - {t}')} + {x(n)})), {digits}) AS llr"
    )


WINDOW_SQL = f"""
spans AS (SELECT unnest([7, 30]) AS window_days),
summed AS (SELECT country_code, window_days, canonical, lemma, CAST(sum(c11) AS BIGINT) AS c11 FROM counts, spans WHERE collected_date BETWEEN DATE '{END}' - (window_days - 1) AND DATE '{END}' GROUP BY ALL),
marg AS (SELECT *, CAST(sum(c11) OVER (PARTITION BY country_code, window_days, canonical) AS BIGINT) AS r, CAST(sum(c11) OVER (PARTITION BY country_code, window_days, lemma) AS BIGINT) AS t, CAST(sum(c11) OVER (PARTITION BY country_code, window_days) AS BIGINT) AS n FROM summed),
stats AS (SELECT *, {_measures("c11", "r", "t", "n")} FROM marg),
ranked AS (SELECT *, row_number() OVER (PARTITION BY country_code, window_days, canonical ORDER BY llr DESC, pmi DESC, lemma) AS rank FROM stats)"""



def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"pmi": F.round("pmi", 6), "llr": F.round("llr", 6)})


def _counts(spark: SparkSession, d: str, country: str | None = None) -> DataFrame:
    small_splits(spark)
    articles = tables.articles(spark, d)
    return collocations.daily_counts(collocations.token_windows(articles if country is None else articles.filter(F.col("country_code") == country)))


def _stored_counts(spark: SparkSession, d: str, country: str | None = None) -> DataFrame:
    """Counts, from one scan of the texts; statistics read them for each margin."""
    return stored(_counts(spark, d, country), "collocation-counts")


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(collocations.window_association(_stored_counts(spark, d), END))


@query(f"WITH {PAIRS_SQL} SELECT country_code, canonical, count(*) AS pairs, count(DISTINCT lemma) AS lemmas FROM pairs GROUP BY ALL", ("articles",))
def join07_token_window(spark: SparkSession, d: str) -> DataFrame:
    return collocations.token_windows(tables.articles(spark, d)).groupBy("country_code", "canonical").agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("lemma").alias("lemmas"))


@query(f"WITH {PAIRS_SQL} SELECT * FROM counts", ("articles",))
def agg12_collocation_counts(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d)


_LANGUAGE_SQL = "CASE country_code WHEN 'DE' THEN 'de' WHEN 'UK' THEN 'en' WHEN 'FR' THEN 'fr' WHEN 'ES' THEN 'es' ELSE '' END"
_ENDINGS_SQL = ", ".join(f"('{k}', '{e}', '{r}')" for k, v in lemmas.ENDINGS.items() for e, r in v.items())


@query(rf"""WITH w AS (SELECT {_LANGUAGE_SQL} AS language, lower(unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'))) AS word FROM articles),
c AS (SELECT language, word, count(*) AS n FROM w GROUP BY ALL), e AS (SELECT * FROM (VALUES {_ENDINGS_SQL}) v(language, ending, instead)),
f AS (SELECT c.language, word, left(word, length(word) - length(ending)) || instead AS lemma FROM c JOIN e ON c.language = e.language AND ends_with(word, ending) AND length(word) - length(ending) >= 3
  QUALIFY row_number() OVER (PARTITION BY c.language, word ORDER BY length(ending) DESC) = 1)
SELECT language, word, coalesce(lemma, word) AS lemma, n FROM c LEFT JOIN f USING (language, word)""", ("articles",))
def ml05_lemmas(spark: SparkSession, d: str) -> DataFrame:
    return lemmas.lemma_table(tables.articles(spark, d))


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    tokens = lemmas.tokens_of(tables.articles(spark, d))
    return lemmas.tagged(tokens, lemmas.fit_tags(tokens))


@query()
def ml05_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    tokens = lemmas.tokens_of(tables.articles(spark, d))
    return lemmas.tag_counts(tokens, lemmas.fit_tags(tokens))


@query()
def agg12_lemma_counts(spark: SparkSession, d: str) -> DataFrame:
    return lemmas.lemma_counts(lemmas.lemma_windows(_tagged(spark, d), ["the", "and", "les", "der"]))


@query(f"WITH {PAIRS_SQL}, m AS (SELECT *, CAST(sum(c11) OVER (PARTITION BY country_code, collected_date, canonical) AS BIGINT) AS r, CAST(sum(c11) OVER (PARTITION BY country_code, collected_date, lemma) AS BIGINT) AS t, CAST(sum(c11) OVER (PARTITION BY country_code, collected_date) AS BIGINT) AS n FROM counts) SELECT *, {_measures('c11', 'r', 't', 'n')} FROM m", ("articles",))
def agg13_daily_association(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(collocations.daily_association(_stored_counts(spark, d)))


@query(f"""WITH {PAIRS_SQL}, {WINDOW_SQL.replace(_measures("c11", "r", "t", "n"), _measures("c11", "r", "t", "n", 9))}, days AS (SELECT country_code, window_days, canonical, count(DISTINCT collected_date) AS coverage_days FROM counts, spans WHERE collected_date BETWEEN DATE '{END}' - (window_days - 1) AND DATE '{END}' GROUP BY ALL)
SELECT country_code, window_days, canonical, coverage_days, CAST(sum(c11) AS BIGINT) AS total_cooccurrences, max(n) AS window_total, round(avg(pmi), 4) AS avg_pmi, round(avg(llr), 4) AS avg_llr, string_agg(lemma, ',' ORDER BY rank) FILTER (rank <= 20) AS top_collocates FROM ranked JOIN days USING (country_code, window_days, canonical) GROUP BY ALL""", ("articles",))
def agg14_window_profile(spark: SparkSession, d: str) -> DataFrame:
    p = collocations.profiles(_stored_counts(spark, d), END)
    return p.select("country_code", "window_days", "canonical", "coverage_days", "total_cooccurrences", "window_total", F.round("avg_pmi", 4).alias("avg_pmi"), F.round("avg_llr", 4).alias("avg_llr"), F.array_join("top_collocates.lemma", ",").alias("top_collocates"))


@query(f"""WITH {PAIRS_SQL}, spans AS (SELECT w.window_days, (DATE '2024-01-01' + CAST(e.i AS INTEGER))::DATE AS end_date FROM (SELECT unnest([7, 30]) AS window_days) w, range(60) e(i)),
held AS (SELECT * FROM counts, spans WHERE collected_date BETWEEN end_date - CAST(window_days - 1 AS INTEGER) AND end_date),
summed AS (SELECT country_code, window_days, end_date, canonical, lemma, CAST(sum(c11) AS BIGINT) AS c11 FROM held GROUP BY ALL),
marg AS (SELECT *, CAST(sum(c11) OVER (PARTITION BY country_code, window_days, end_date, canonical) AS BIGINT) AS r, CAST(sum(c11) OVER (PARTITION BY country_code, window_days, end_date, lemma) AS BIGINT) AS t, CAST(sum(c11) OVER (PARTITION BY country_code, window_days, end_date) AS BIGINT) AS n FROM summed),
stats AS (SELECT *, {_measures("c11", "r", "t", "n", 9)} FROM marg), ranked AS (SELECT *, row_number() OVER (PARTITION BY country_code, window_days, end_date, canonical ORDER BY llr DESC, pmi DESC, lemma) AS rank FROM stats),
days AS (SELECT country_code, window_days, end_date, canonical, count(DISTINCT collected_date) AS coverage_days FROM held GROUP BY ALL)
SELECT country_code, window_days, end_date, canonical, coverage_days, CAST(sum(c11) AS BIGINT) AS total_cooccurrences, max(n) AS window_total, round(avg(pmi), 4) AS avg_pmi, round(avg(llr), 4) AS avg_llr, string_agg(lemma, ',' ORDER BY rank) FILTER (rank <= 20) AS top_collocates FROM ranked JOIN days USING (country_code, window_days, end_date, canonical) GROUP BY ALL""", ("articles",))
def agg14_profiles_of_all_dates(spark: SparkSession, d: str) -> DataFrame:
    """Profiles over 7 and 30 days for each of 60 end dates."""
    p = rolling.profiles(_stored_counts(spark, d), date(2024, 1, 1), date(2024, 2, 29))
    return p.select("country_code", "window_days", "end_date", "canonical", "coverage_days", "total_cooccurrences", "window_total", F.round("avg_pmi", 4).alias("avg_pmi"), F.round("avg_llr", 4).alias("avg_llr"), F.array_join("top_collocates.lemma", ",").alias("top_collocates"))


@query(f"WITH {PAIRS_SQL}, {WINDOW_SQL} SELECT country_code, window_days, canonical, rank, lemma, c11, pmi, llr FROM ranked WHERE rank <= 20", ("articles",))
def win07_top_collocates(spark: SparkSession, d: str) -> DataFrame:
    return collocations.ranked_collocates(_stats(spark, d)).select("country_code", "window_days", "canonical", "rank", "lemma", "c11", "pmi", "llr")


_LEXICON = [("the", "economic"), ("and", "security"), ("les", "identity"), ("der", "governance"), ("que", "humanitarian"), ("for", "conflict"), ("with", "economic"), ("the", "conflict")]
_LEXICON_SQL = "lex AS (SELECT * FROM (VALUES ('the', 'economic'), ('and', 'security'), ('les', 'identity'), ('der', 'governance'), ('que', 'humanitarian'), ('for', 'conflict'), ('with', 'economic')) v(lemma, frame))"
_FRAME_SUMS = ", ".join(f"coalesce(sum(llr) FILTER (frame = '{f}'), 0) / sum(llr) AS {f}" for f in collocations.FRAMES)
_FRAMES_SQL = f"{PAIRS_SQL}, {WINDOW_SQL}, {_LEXICON_SQL}, f AS (SELECT country_code, window_days, canonical, {_FRAME_SUMS} FROM ranked JOIN lex USING (lemma) WHERE rank <= 20 GROUP BY ALL HAVING sum(llr) > 0)"


def _frames(spark: SparkSession, d: str, top: DataFrame | None = None) -> DataFrame:
    lexicon = spark.createDataFrame(_LEXICON, "lemma string, frame string")
    return collocations.frame_intensities(collocations.ranked_collocates(_stats(spark, d)) if top is None else top, lexicon, ["country_code", "window_days", "canonical"])


@query(f"WITH {_FRAMES_SQL} SELECT country_code, window_days, canonical, {', '.join(f'round({f}, 5) AS {f}' for f in collocations.FRAMES)} FROM f", ("articles",))
def agg15_frame_intensity(spark: SparkSession, d: str) -> DataFrame:
    return _frames(spark, d).withColumns({f: F.round(f, 5) for f in collocations.FRAMES})


_DOMINANT_SQL = "CASE " + " ".join(f"WHEN {f} = greatest({', '.join(collocations.FRAMES)}) THEN '{f}'" for f in collocations.FRAMES) + " END"


@query(f"""WITH {_FRAMES_SQL}, p AS (SELECT count(DISTINCT (country_code, window_days, canonical)) AS profiles, count(*) AS collocates, count(*) FILTER (lemma NOT IN (SELECT lemma FROM lex)) AS unassigned FROM ranked WHERE rank <= 20),
g AS (SELECT {_DOMINANT_SQL} AS frame, count(*) AS n FROM f GROUP BY 1), h AS (SELECT CAST(sum(n) AS BIGINT) AS with_frames, -sum(n / z * log2(n / z)) AS bits FROM g, (SELECT sum(n)::DOUBLE AS z FROM g))
SELECT profiles, with_frames, round(100 * with_frames::DOUBLE / profiles, 1) AS frame_coverage_pct, collocates, unassigned, round(100 * unassigned::DOUBLE / collocates, 1) AS unassigned_pct, round(bits, 3) AS entropy_bits, round(log2(6), 3) AS max_entropy_bits FROM p, h""", ("articles",))
def agg23_frame_audit(spark: SparkSession, d: str) -> DataFrame:
    top = stored(collocations.ranked_collocates(_stats(spark, d)), "collocates")
    lexicon = spark.createDataFrame(_LEXICON, "lemma string, frame string")
    return evaluation.frame_audit(top, _frames(spark, d, top), lexicon, ["country_code", "window_days", "canonical"])


@query(f"WITH {PAIRS_SQL}, {WINDOW_SQL}, p AS (SELECT country_code, window_days, canonical, CAST(sum(c11) AS BIGINT) AS total_cooccurrences, round(avg(llr), 4) AS avg_llr FROM stats GROUP BY ALL) SELECT * FROM p WHERE window_days = 30 AND country_code = 'UK' AND canonical ILIKE '%th%' ORDER BY total_cooccurrences DESC, avg_llr DESC NULLS LAST, canonical LIMIT 25", ("articles",))
def top02_directory(spark: SparkSession, d: str) -> DataFrame:
    p = _rounded(collocations.window_association(_stored_counts(spark, d, "UK"), END, (30,)))
    out = p.groupBy("country_code", "window_days", "canonical").agg(F.sum("c11").alias("total_cooccurrences"), F.round(F.avg("llr"), 4).alias("avg_llr"))
    return out.filter(F.col("canonical").ilike("%th%")).orderBy(F.col("total_cooccurrences").desc(), F.col("avg_llr").desc_nulls_last(), "canonical").limit(25)


@query("""WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 7) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 4) AS similarity FROM embeddings, q WHERE label <> 3 ORDER BY list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]) DESC, vec_id LIMIT 20""")
def top01_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "embeddings")
    query_vector = e.filter("vec_id = 7").first()["embedding"]
    return similarity.nearest(e.filter("label <> 3"), query_vector, 20)


@query(keywords.SQL)
def ml10_tfidf_keywords(spark: SparkSession, d: str) -> DataFrame:
    docs = tables.table(spark, d, "documents").select("doc_id", F.col("lang").alias("cluster"), "text")
    return keywords.top_keywords(docs, ["the", "and", "les", "der", "de", "la"], k=8).withColumn("weight", F.round("weight", 6))


@query(keywords.SQL)
def ml10_kept_frequencies(spark: SparkSession, d: str) -> DataFrame:
    """The same keywords from document frequencies that five days have brought, each counted when it came."""
    docs = tables.table(spark, d, "documents").select("doc_id", F.col("lang").alias("cluster"), "text", F.pmod("doc_id", F.lit(5)).alias("slice"))
    held = keywords.TermCounts(spark, fresh_path(spark, "term-counts"))
    for day in range(5):
        held.put(docs, [str(day)])
    return keywords.top_keywords(docs, ["the", "and", "les", "der", "de", "la"], k=8, counts=held.rows()).withColumn("weight", F.round("weight", 6))


@query("""WITH p AS (SELECT l.quality AS actual, CASE WHEN d.n_chars > 900 THEN 1 ELSE 0 END AS predicted FROM labels l JOIN documents d USING (doc_id)), c AS (SELECT unnest([0, 1]) AS label),
m AS (SELECT label, count(*) FILTER (actual = label AND predicted = label) AS tp, count(*) FILTER (actual <> label AND predicted = label) AS fp, count(*) FILTER (actual = label AND predicted <> label) AS fn, count(*) AS n, count(*) FILTER (actual = predicted) AS hits FROM c, p GROUP BY 1),
f AS (SELECT *, coalesce(round(tp::DOUBLE / nullif(tp + fp, 0), 4), 0) AS prec, coalesce(round(tp::DOUBLE / nullif(tp + fn, 0), 4), 0) AS recall, coalesce(round(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 4), 0) AS f1 FROM m)
SELECT label, tp, fp, fn, prec AS "precision", recall, f1, round(avg(f1) OVER (), 4) AS macro_f1, round(hits::DOUBLE / n, 4) AS accuracy FROM f""")
def agg24_confusion(spark: SparkSession, d: str) -> DataFrame:
    pairs = tables.table(spark, d, "labels").join(tables.table(spark, d, "documents"), "doc_id")
    pairs = pairs.select(F.col("quality").alias("actual"), F.when(F.col("n_chars") > 900, 1).otherwise(0).alias("predicted"))
    return evaluation.class_metrics(pairs, [0, 1])


@query(r"""WITH u AS (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '/?b=2&utm_source=x&a=1#top' WHEN 1 THEN '?FBCLID=9&z=' ELSE '' END AS url FROM pages),
p AS (SELECT *, lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1)) AS head, regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), '/+$', '') AS path,
  list_sort(list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_|(fbclid|gclid|yclid|mc_cid|mc_eid)(=|$))')), lambda x: url_encode(url_decode(split_part(x, '=', 1))) || '=' || CASE WHEN contains(x, '=') THEN url_encode(url_decode(substr(x, instr(x, '=') + 1))) ELSE '' END)) AS q FROM u)
SELECT page_id, head || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url FROM p""")
def sca07_url_normalize(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id") % 4
    tail = F.when(k == 0, "/?b=2&utm_source=x&a=1#top").when(k == 1, "?FBCLID=9&z=").otherwise("")
    return tables.table(spark, d, "pages").select("page_id", urls.normal_url(F.concat("url", tail)).alias("url"))


_WORDS = list(urls.CATEGORY_WORDS)


def _url_sql() -> str:
    exact = "CASE t " + " ".join(f"WHEN '{w}' THEN '{c}'" for w, c in urls.CATEGORY_WORDS.items()) + " END"
    inside = "CASE " + " ".join(f"WHEN contains(t, '{w}') THEN '{c}'" for w, c in urls.CATEGORY_WORDS.items()) + " END"
    return f"""WITH u AS (SELECT event_id, (['/rss/ekonomi.xml', '/rss', '/a/spor-haber_1', '/xparax/y', '/', '/son-dakika', '/news/item', '/dunya.rss'])[(event_id % 8) + 1] AS path FROM events),
t AS (SELECT event_id, list_filter(string_split_regex(regexp_replace(path, '[_.]', '-', 'g'), '[/-]'), lambda x: x <> '') || list_filter(string_split(path, '/'), lambda x: x <> '') AS ts FROM u),
x AS (SELECT event_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM t), c AS (SELECT event_id, i, coalesce({exact}, {inside}) AS c FROM x)
SELECT u.event_id, coalesce(arg_min(c, i) FILTER (c IS NOT NULL), 'other') AS category FROM u LEFT JOIN c USING (event_id) GROUP BY 1"""


@query(_url_sql())
def sca08_url_category(spark: SparkSession, d: str) -> DataFrame:
    paths = ["/rss/ekonomi.xml", "/rss", "/a/spor-haber_1", "/xparax/y", "/", "/son-dakika", "/news/item", "/dunya.rss"]
    url = F.concat(F.lit("https://x.example"), F.element_at(F.array(*map(F.lit, paths)), (F.col("event_id") % 8 + 1).cast("int")))
    return tables.table(spark, d, "events").select("event_id", urls.category(url).alias("category"))


@query(r"WITH t AS (SELECT page_id, trim(regexp_replace(string_split(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '|')[1], '[ \t\r\n]+', ' ', 'g')) AS t FROM pages) SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&quot;', chr(34)), '&#x27;', ''''), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title FROM t")
def sca11_page_titles(spark: SparkSession, d: str) -> DataFrame:
    return page_meta(tables.table(spark, d, "pages")).select("page_id", "title")


@query(r"SELECT conv_id, turn, regexp_replace(regexp_replace(coalesce(text, ''), '[ \t\r\n]+', ' ', 'g'), '^ | $', '', 'g') AS cleaned, length(regexp_replace(regexp_replace(coalesce(text, ''), '[ \t\r\n]+', ' ', 'g'), '^ | $', '', 'g')) >= 10 AS long_enough FROM conversations")
def sca02_clean_text(spark: SparkSession, d: str) -> DataFrame:
    c = text.clean(F.col("text"))
    return tables.table(spark, d, "conversations").select("conv_id", "turn", c.alias("cleaned"), (F.length(c) >= text.MIN_CHARS).alias("long_enough"))


@query("SELECT conv_id, turn, concat_ws('. ', nullif(trim(role), ''), nullif(trim(left(trim(text), 800)), '')) AS analysis FROM conversations")
def sca06_analysis_text(spark: SparkSession, d: str) -> DataFrame:
    return tables.table(spark, d, "conversations").select("conv_id", "turn", text.analysis_text(F.col("role"), F.lit(None), F.col("text"), 800).alias("analysis"))


_LEMMAS = ["the", "and", "xyz", "tion"]


@query(f"""WITH c AS (SELECT item_id AS id, row_number() OVER (ORDER BY item_id DESC) - 1 AS rank, text FROM benchmark), m AS (SELECT id, rank, list_filter({_LEMMAS}, lambda x: contains(lower(text), x)) AS matched FROM c)
SELECT id, len(matched) AS coverage, array_to_string(matched, ',') AS matched FROM m ORDER BY coverage DESC, rank DESC, id LIMIT 8""")
def top09_snippets(spark: SparkSession, d: str) -> DataFrame:
    b = tables.table(spark, d, "benchmark")
    # only the order of ranks counts, so the id stands for its place
    out = snippets(b.select(F.col("item_id").alias("id"), (-F.col("item_id")).alias("rank"), "text"), _LEMMAS)
    return out.select("id", F.col("coverage").cast("bigint").alias("coverage"), F.array_join("matched", ",").alias("matched"))


@query("""SELECT event_type, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99, count(*) AS n, round(1000 / avg(value), 6) AS per_second FROM events WHERE value > 0 GROUP BY 1""")
def agg29_latency(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.latency(tables.table(spark, d, "events").filter("value > 0"), "event_type", "value").withColumn("per_second", F.round("per_second", 6))


@query("""WITH g AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY quality) AS n FROM labels), z AS (SELECT max(n) AS top FROM g)
SELECT doc_id, quality, CAST((top - k) // n + 1 AS INTEGER) AS copies FROM g, z""")
def ml13_balance(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.balanced(tables.table(spark, d, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("SELECT label AS a, count(*) AS n, round(avg(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))), 6) AS norm FROM embeddings GROUP BY 1")
def sca22_norms(spark: SparkSession, d: str) -> DataFrame:
    from broadsheet.functions.vectors import dot

    return tables.table(spark, d, "embeddings").groupBy(F.col("label").alias("a")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.sqrt(dot(F.col("embedding"), F.col("embedding")))), 6).alias("norm"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def rel01_pricing(spark: SparkSession, d: str) -> DataFrame:
    li = tables.table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def rel02_orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = (tables.table(spark, d, x) for x in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_type, percent FROM (SELECT event_type, round(100 * count(*)::DOUBLE / (SELECT count(*) FROM events), 1) AS percent FROM events GROUP BY 1)")
def sca28_percent(spark: SparkSession, d: str) -> DataFrame:
    e = tables.table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return e.select("event_type", association.percent(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("percent"))
