"""Analytics over scored articles: trends, day summaries, source comparison, quality of parsing and of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.association import percent, psi_term, ratio, severity
from broadsheet.functions.scores import LABELS, bucket

STATUSES = ("parsed", "empty", "fetch_error", "parse_error", "skipped", "unfetched")
RETRIED = ("fetch_error", "parse_error", "empty")


def counts_of(column: str, values) -> list[Column]:
    return [F.count_if(F.col(column) == v).alias(v) for v in values]


def in_slice(df: DataFrame, day, country: str) -> DataFrame:
    """The slice of one day and country: the filters reach the partitions."""
    return df.filter((F.col("collected_date") == F.lit(day).cast("date")) & (F.col("country_code") == country))


def trend(news: DataFrame, as_of, days: int) -> DataFrame:
    """Per country and day: labelled articles by label and in total, for the `days` days before as_of and as_of itself."""
    recent = news.filter((F.col("collected_date") >= F.date_sub(F.lit(as_of).cast("date"), days)) & F.col("sentiment_label").isNotNull())
    return recent.groupBy("country_code", "collected_date").agg(*counts_of("sentiment_label", LABELS), F.count(F.lit(1)).alias("total"))


def trend_percent(news: DataFrame, as_of, days: int) -> DataFrame:
    return trend(news, as_of, days).withColumn("positive_pct", percent(F.col("positive"), F.col("total")))


def day_summary(news: DataFrame) -> DataFrame:
    """Per country and day: label counts with percentages of all articles, labelled or not."""
    out = news.groupBy("country_code", "collected_date").agg(F.count(F.lit(1)).alias("total"), *counts_of("sentiment_label", LABELS))
    return out.select("*", *[percent(F.col(k), F.col("total")).alias(f"{k}_pct") for k in LABELS])


def source_counts(news: DataFrame) -> DataFrame:
    """Per country, day and source: articles, and their share of the day."""
    out = news.groupBy("country_code", "collected_date", "source_name").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy("country_code", "collected_date"))))


def source_comparison(news: DataFrame) -> DataFrame:
    """Per source: label counts and percentages, and the mean of the calibrated score or else the raw one."""
    out = news.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("total"), *counts_of("sentiment_label", LABELS), F.round(F.avg(F.coalesce("calibrated_sentiment_score", "sentiment_score")), 4).alias("avg_score")
    )
    return out.select("*", *[percent(F.col(k), F.col("total")).alias(f"{k}_pct") for k in LABELS])


def fetch_candidates(news: DataFrame, retry: bool, per_source: int, limit: int) -> DataFrame:
    """Articles with a link whose body is yet to fetch: at most per_source a source by id, then the first `limit`."""
    open_ = F.col("parse_status").isNull()
    if retry:
        open_ = open_ | F.col("parse_status").isin(*RETRIED)
    w = Window.partitionBy("source_name").orderBy("id")
    first = news.filter(open_ & F.col("link").isNotNull()).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_source)
    return first.orderBy("source_name", "id").limit(limit)


def to_rescore(news: DataFrame, only_missing: bool = False, only_stale: bool = False, only_with_body: bool = False) -> DataFrame:
    """Articles to score: without a label, or scored before the body came; the modes exclude one another."""
    if only_missing and only_stale:
        raise ValueError("only_missing and only_stale exclude one another")
    keep = F.lit(True)
    if only_missing:
        keep = keep & F.col("sentiment_label").isNull()
    if only_stale:
        keep = keep & F.col("sentiment_label").isNotNull() & (F.col("analyzed_hour") < F.col("fetched_hour"))
    if only_with_body:
        keep = keep & (F.col("article_chars") > 0)
    return news.filter(keep)


def high_confidence(news: DataFrame, least: float = 0.85, most: int = 50_000) -> DataFrame:
    rows = news.filter(F.col("sentiment_label").isNotNull() & (F.col("sentiment_score") >= least))
    return rows.orderBy(F.col("collected_date").desc(), F.col("id").desc()).limit(most)


def parse_quality(news: DataFrame, least_fetched: int = 10, least_parsed: float = 85.0) -> DataFrame:
    """Totals, and the same for each source and each category, in one pass over grouping sets."""
    status = F.coalesce("parse_status", F.lit("unfetched"))
    rows = news.select(
        F.coalesce(F.nullif(F.col("source_name"), F.lit("")), F.lit("unknown")).alias("source"),
        F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("unknown")).alias("category"),
        status.alias("status"),
        "article_chars",
    )
    sets = rows.groupingSets([["source"], ["category"], []], "source", "category")
    out = sets.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.coalesce(F.round(F.avg(F.when(F.col("status") == "parsed", F.col("article_chars"))), 1), F.lit(0.0)).alias("avg_chars"),
        F.coalesce(F.max(F.when(F.col("status") == "parsed", F.col("article_chars"))), F.lit(0)).alias("max_chars"),
    )
    out = out.withColumn("fetched", F.col("total") - F.col("unfetched"))
    out = out.withColumns({"coverage_pct": percent(F.col("fetched"), F.col("total")), "parsed_pct_fetched": percent(F.col("parsed"), F.col("fetched"))})
    return out.withColumn("needs_attention", F.col("source").isNotNull() & (F.col("fetched") >= least_fetched) & (F.col("parsed_pct_fetched") < least_parsed))


def sentiment_audit(news: DataFrame, high: float = 0.9) -> DataFrame:
    """Per source: label mix, mean scores by label, confident rows, and rows scored before or after their body came."""
    label = F.col("sentiment_label")
    both = label.isNotNull() & F.col("analyzed_hour").isNotNull() & F.col("fetched_hour").isNotNull()
    return news.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("total"),
        *counts_of("sentiment_label", LABELS),
        *[F.round(F.avg(F.when(label == k, F.col("sentiment_score"))), 4).alias(f"avg_{k}") for k in LABELS],
        F.round(F.avg("sentiment_score"), 4).alias("avg_raw"),
        F.round(F.avg("calibrated_sentiment_score"), 4).alias("avg_calibrated"),
        F.count_if(F.col("sentiment_score") >= high).alias("raw_high"),
        F.count_if(F.col("calibrated_sentiment_score") >= high).alias("calibrated_high"),
        F.count_if(both & (F.col("analyzed_hour") < F.col("fetched_hour"))).alias("stale"),
        F.count_if(both & (F.col("analyzed_hour") >= F.col("fetched_hour"))).alias("after_body"),
    )


def drift(news: DataFrame, window: int = 30, least_rows: int = 50, least_days: int = 7, only_past: bool = True) -> DataFrame:
    """Per country and day: PSI of the day's label shares against the mean of daily shares over the window before it.

    Baseline days have at least least_rows labelled articles; with fewer than least_days of them the status is
    insufficient_data. With only_past off, days after the target count too. Days join by equal country and the days they
    reach, not by comparing all pairs.
    """
    daily = news.filter(F.col("sentiment_label").isNotNull()).groupBy("country_code", "collected_date").agg(*counts_of("sentiment_label", LABELS), F.count(F.lit(1)).alias("total"))
    shares = daily.select("country_code", "collected_date", "total", *[(F.col(k) / F.col("total")).alias(k) for k in LABELS])
    base = shares.filter(F.col("total") >= least_rows)
    reach = F.sequence(F.lit(1), F.lit(window))
    if not only_past:
        reach = F.sequence(F.lit(-window), F.lit(window))
    days = F.transform(F.filter(reach, lambda d: d != 0), lambda d: F.date_add("collected_date", d))
    spread = base.select("country_code", F.explode(days).alias("collected_date"), *[F.col(k).alias(f"b_{k}") for k in LABELS])
    means = spread.groupBy("country_code", "collected_date").agg(F.count(F.lit(1)).alias("baseline_days"), *[F.avg(f"b_{k}").alias(f"b_{k}") for k in LABELS])
    out = shares.join(means, ["country_code", "collected_date"], "left").withColumn("baseline_days", F.coalesce("baseline_days", F.lit(0)))
    enough = F.col("baseline_days") >= least_days
    psi = sum((psi_term(F.col(k), F.col(f"b_{k}")) for k in LABELS), F.lit(0.0))
    return out.select(
        "country_code",
        "collected_date",
        F.when(enough, "ok").otherwise("insufficient_data").alias("status"),
        F.when(enough, F.round(psi, 4)).alias("psi"),
        F.when(enough, severity(psi)).alias("severity"),
        "baseline_days",
        F.col("total").alias("today_total"),
        *[F.when(enough, F.round(F.col(k) - F.col(f"b_{k}"), 4)).alias(f"delta_{k}") for k in LABELS],
    )


def drift_gauges(reports: DataFrame) -> DataFrame:
    """Metric rows of the latest report of each country; severity as a number, -1 where data is short."""
    latest = reports.withColumn("rank", F.row_number().over(Window.partitionBy("country_code").orderBy(F.col("collected_date").desc()))).filter("rank = 1")
    code = F.when(F.col("status") != "ok", -1.0).when(F.col("severity") == "stable", 0.0).when(F.col("severity") == "moderate", 1.0).otherwise(2.0)
    pairs = [("drift_psi", F.col("psi")), ("drift_severity", code), ("drift_baseline_days", F.col("baseline_days").cast("double")), *[(f"drift_delta_{k}", F.col(f"delta_{k}")) for k in LABELS]]
    return latest.select("country_code", F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in pairs])).alias("m")).select("country_code", "m.metric", "m.value")


def review_sample(news: DataFrame, per_stratum: int, seed: int = 42) -> DataFrame:
    """At most per_stratum rows of each stratum of source, label, confidence, body and category, in seeded order."""
    strata = {
        "source": F.coalesce("source_name", F.lit("unknown")),
        "label": F.coalesce("sentiment_label", F.lit("missing")),
        "confidence": bucket(F.col("sentiment_score")),
        "has_body": F.col("article_chars") > 0,
        "stratum_category": F.coalesce("category", F.lit("unknown")),
    }
    w = Window.partitionBy(*strata).orderBy(F.xxhash64(F.lit(seed), "id"), "id")
    return news.withColumns(strata).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_stratum)


def cluster_summaries(news: DataFrame) -> DataFrame:
    """Per country and cluster, noise left out: size, labels, and the most frequent source."""
    found = news.filter(F.col("cluster_id") >= 0)
    sources = found.groupBy("country_code", "cluster_id", "source_name").agg(F.count(F.lit(1)).alias("n"))
    top = sources.groupBy("country_code", "cluster_id").agg(F.count(F.lit(1)).alias("n_sources"), F.min(F.struct(-F.col("n"), F.col("source_name").alias("name"))).alias("t"))
    sizes = found.groupBy("country_code", "cluster_id").agg(F.count(F.lit(1)).alias("size"), *counts_of("sentiment_label", LABELS))
    return sizes.join(top.select("country_code", "cluster_id", "n_sources", F.col("t.name").alias("top_source")), ["country_code", "cluster_id"])


def cluster_quality(news: DataFrame, largest_max: float = 25.0, noise_max: float = 40.0) -> DataFrame:
    """Per country: shares of the largest cluster, of small clusters, of noise and of unknown categories, and warnings."""
    sizes = news.groupBy("country_code", "cluster_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("category", F.lit("unknown")) == "unknown").alias("u"))
    real = F.col("cluster_id") >= 0
    out = sizes.groupBy("country_code").agg(
        F.sum("n").alias("items"),
        F.max(F.when(real, F.col("n"))).alias("largest"),
        F.count_if(real & (F.col("n") < 5)).alias("small"),
        F.count_if(real).alias("clusters"),
        F.coalesce(F.sum(F.when(F.col("cluster_id") == -1, F.col("n"))), F.lit(0)).alias("noise"),
        F.sum("u").alias("unknown"),
    )
    out = out.select(
        "country_code", "clusters",
        percent(F.col("largest"), F.col("items"), 2).alias("largest_cluster_pct"), percent(F.col("small"), F.col("clusters"), 2).alias("small_cluster_pct"),
        percent(F.col("noise"), F.col("items"), 2).alias("noise_pct"), percent(F.col("unknown"), F.col("items"), 2).alias("unknown_category_pct"),
    )
    warn = F.concat_ws(",", F.when(F.col("largest_cluster_pct") > largest_max, "dominant_cluster"), F.when(F.col("noise_pct") > noise_max, "high_noise"))
    return out.withColumn("warnings", warn)


def source_health(news: DataFrame, expected: int = 20) -> DataFrame:
    """Per source: checks, items, distinct links, failures, and categories below the expected number."""
    checks = news.groupBy("source_name", "category").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("parse_status") == "fetch_error").alias("failures"))
    links = news.groupBy("source_name").agg(F.count_distinct("link").alias("unique_urls"))
    out = checks.groupBy("source_name").agg(F.count(F.lit(1)).alias("checks"), F.sum("items").alias("raw_items"), F.sum("failures").alias("failures"), F.count_if(F.col("items") < expected).alias("low_categories"))
    return out.join(links, "source_name").withColumn("dedupe_loss_pct", percent(F.col("raw_items") - F.col("unique_urls"), F.col("raw_items")))
