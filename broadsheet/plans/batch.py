"""The daily job of a country: each step reads stage tables and replaces its slice."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.text import analysis_text
from broadsheet.operators import collocations, entities, news, preprocess
from broadsheet.sources.pages import fetched_articles
from broadsheet.sources.shared import stored
from broadsheet.sources.store import SliceStore, insert_ignore

log = logging.getLogger(__name__)

SCHEMAS = {
    "news_raw": "id long, title string, summary string, source_name string, published_date string, link string, category string, country_code string, collected_date date",
    "news_scored": "id long, source_name string, link string, category string, title string, summary string, cleaned_title string, cleaned_summary string, char_count int, is_target_language boolean, sentiment_label string, raw_sentiment_score double, calibrated_sentiment_score double, country_code string, collected_date date",
    "news_articles": "id long, article_text string, parse_status string, page_chars long, country_code string, collected_date date",
    "mentions": "article_id long, entity_text string, entity_type string, position int, canonical string, wikidata_qid string, confidence double, resolver_method string, country_code string, collected_date date",
    "collocations": "canonical string, lemma string, c11 long, r long, t long, n long, pmi double, llr double, country_code string, collected_date date",
    "drift": "status string, psi double, severity string, baseline_days long, today_total long, delta_negative double, delta_neutral double, delta_positive double, country_code string, collected_date date",
    "steps": "step string, outcome string, country_code string, collected_date date",
}
#: A day is done when all of these have ended ok.
STEPS = ("news_raw", "news_articles", "news_scored", "mentions", "collocations", "drift")


@dataclass
class DailyJob:
    """Tables under `root`; steps named in `soft` may fail without stopping the rest. done: step -> 'ok' or the error.

    pages (page_id, url, html) are what a crawler has landed; articles are joined with them by normal URL, and their bodies
    are read beside titles and summaries.
    """

    spark: SparkSession
    root: str
    country: str
    language: str
    aliases: DataFrame | None = None
    scorer: preprocess.Scorer = preprocess.lexicon_scores
    pages: DataFrame | None = None
    soft: tuple[str, ...] = ("news_articles", "mentions", "collocations", "drift")
    done: dict[str, str] = field(default_factory=dict)

    def store(self, name: str) -> SliceStore:
        return SliceStore(self.spark, f"{self.root}/{name}")

    def rows(self, name: str, day: str | None = None) -> DataFrame:
        out = self.store(name).rows(SCHEMAS[name])
        return out if day is None else news.in_slice(out, day, self.country)

    def _write(self, name: str, df: DataFrame, day: str) -> None:
        cols = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        rows = df.withColumns({"country_code": F.lit(self.country), "collected_date": F.lit(day).cast("date")}).select(*cols)
        self.store(name).replace(rows, [{"country_code": self.country, "collected_date": day}])

    def _step(self, name: str, run: Callable[[], None]) -> None:
        try:
            run()
            self.done[name] = "ok"
        except Exception as e:
            self.done[name] = f"{type(e).__name__}: {e}"
            if name not in self.soft:
                raise
            log.warning("step %s failed: %s", name, e)

    def run(self, items: DataFrame, day: str, run_at: str) -> dict[str, str]:
        """items: title, summary, source_name, published_date, link, category, id. A repeat with the same items changes nothing."""
        self.done = {}
        try:
            self._step("news_raw", lambda: self._collect(items, day))
            self._step("news_articles", lambda: self._fetch(day))
            self._step("news_scored", lambda: self._score(day, run_at))
            self._step("mentions", lambda: self._mentions(day))
            self._step("collocations", lambda: self._collocations(day))
            self._step("drift", lambda: self._drift(day))
        finally:
            self._write("steps", self.spark.createDataFrame(list(self.done.items()), "step string, outcome string"), day)
        return self.done

    def _collect(self, items: DataFrame, day: str) -> None:
        """Links that other slices hold are left out; the day's own slice is written anew with what it held and what is new."""
        held = self.rows("news_raw")
        own = news.in_slice(held, day, self.country)
        others = held.filter(~((F.col("collected_date") == F.lit(day).cast("date")) & (F.col("country_code") == self.country)))
        cols = ["id", "title", "summary", "source_name", "published_date", "link", "category"]
        blank = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
        new = items.select("id", blank("title"), blank("summary"), F.coalesce("source_name", F.lit("")).alias("source_name"), blank("published_date"), blank("link"), blank("category"))
        fresh = insert_ignore(others.select(*cols), new, "link", "id")
        kept = fresh.join(own.select("id"), "id", "left_anti").select(*cols)
        link_free = kept.join(own.filter("link is not null").select("link"), "link", "left_anti").select(*cols).unionByName(kept.filter("link is null")).dropDuplicates(["id"])
        self._write("news_raw", own.select(*cols).unionByName(link_free), day)

    def _fetch(self, day: str) -> None:
        links = self.rows("news_raw", day).filter("link is not null").select("id", "link")
        none = "page_id long, url string, html string"
        landed = self.pages if self.pages is not None else self.spark.createDataFrame([], none)
        self._write("news_articles", fetched_articles(links, landed), day)

    def _with_body(self, df: DataFrame, day: str) -> DataFrame:
        return df.join(self.rows("news_articles", day).select("id", F.col("article_text").alias("body")), "id", "left")

    def _texts(self, day: str) -> DataFrame:
        rows = self._with_body(self.rows("news_scored", day), day)
        return rows.select("id", "country_code", "collected_date", analysis_text(F.col("title"), F.col("summary"), F.col("body"), 3000).alias("text"))

    def _score(self, day: str, run_at: str) -> None:
        clean = self._with_body(preprocess.preprocess(self.rows("news_raw", day), self.language, run_at), day)
        text = analysis_text(F.col("cleaned_title"), F.col("cleaned_summary"), F.col("body"), 800)
        self._write("news_scored", preprocess.scored(clean, text, self.scorer, F.col("is_target_language")), day)

    def _mentions(self, day: str) -> None:
        texts = self._texts(day)
        none = "country_code string, entity_type string, alias string, canonical string, wikidata_qid string, ordinal long"
        aliases = self.aliases if self.aliases is not None else self.spark.createDataFrame([], none)
        found = entities.typed(entities.default_mentions(texts).join(texts.select("id", "country_code"), "id"), aliases)
        self._write("mentions", entities.canonicalize(found, aliases).withColumnRenamed("id", "article_id"), day)

    def _collocations(self, day: str) -> None:
        self._write("collocations", collocations.daily_association(stored(collocations.daily_counts(collocations.token_windows(self._texts(day))), "collocation-counts")), day)

    def _drift(self, day: str) -> None:
        past = self.rows("news_scored").filter(F.col("country_code") == self.country).filter(F.col("collected_date").between(F.date_sub(F.lit(day).cast("date"), 30), F.lit(day).cast("date")))
        self._write("drift", news.in_slice(news.drift(past), day, self.country), day)

    def backfill(self, items_of: Callable[[str], DataFrame], days: list[str], run_at: str) -> dict[str, str]:
        """Days that have not ended with every step ok, the soft ones too, are done again; a failed day is noted with the steps
        that failed, and the rest go on. A day whose driver was lost has no steps written, so it is done again as well."""
        rows = self.rows("steps").filter(F.col("country_code") == self.country)
        ended = rows.groupBy("collected_date").agg(F.bool_and(F.col("outcome") == "ok").alias("ok"), F.count_distinct("step").alias("n"))
        held = {str(r[0]) for r in ended.filter(F.col("ok") & (F.col("n") == len(STEPS))).select("collected_date").collect()}  # a row a day
        out = {}
        for day in days:
            if day in held:
                continue
            try:
                failed = {k: v for k, v in self.run(items_of(day), day, run_at).items() if v != "ok"}
                out[day] = "; ".join(f"{k}: {v}" for k, v in failed.items()) or "ok"
            except Exception as e:
                out[day] = f"{type(e).__name__}: {e}"
        return out
