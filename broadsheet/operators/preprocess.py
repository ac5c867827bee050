"""Cleaning of raw items, and scoring of texts by providers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.scores import LABELS, calibrated, calibrated_scores
from broadsheet.functions.text import MIN_CHARS, strip_markup

#: Formats of dates that are tried in turn; dates without a zone are UTC.
DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm:ss", "EEE, d MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss z", "dd.MM.yyyy HH:mm", "yyyy-MM-dd")
#: Frequent words that tell a language, for the default detector.
LANGUAGE_WORDS = {
    "tr": ("ve", "bir", "bu", "için", "ile"),
    "de": ("der", "die", "und", "das", "nicht"),
    "fr": ("le", "les", "des", "est", "dans"),
    "it": ("il", "che", "di", "per", "una"),
    "es": ("el", "los", "que", "por", "una"),
    "en": ("the", "and", "of", "to", "is"),
}


def iso_date(raw: Column, run_at: Column) -> Column:
    """A timestamp from any of the formats; what can't be read is the time of the run."""
    return F.coalesce(*[F.try_to_timestamp(raw, F.lit(f)) for f in DATE_FORMATS[:2]], *[F.try_to_timestamp(F.regexp_replace(raw, "^[A-Za-z]{3}, ", ""), F.lit(f.replace("EEE, ", ""))) for f in DATE_FORMATS[2:4]], *[F.try_to_timestamp(raw, F.lit(f)) for f in DATE_FORMATS[4:]], run_at)


def detected_language(text: Column) -> Column:
    """The language with most hits among its frequent words in the first 300 characters; null without a hit."""
    words = F.split(F.lower(F.left(text, F.lit(300))), r"[^\p{L}]+")
    found = lambda listed: F.size(F.filter(words, lambda w: w.isin(*listed)))
    hits = [F.struct(found(ws).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("k")) for i, (k, ws) in enumerate(LANGUAGE_WORDS.items())]
    best = F.array_max(F.array(*hits))
    return F.when(best["n"] > 0, best["k"])


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in an order that the seed and the key fix, whatever the partitions."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key)


def preprocess(items: DataFrame, language: str, run_at: str, keep_short: bool = False) -> DataFrame:
    """Items with cleaned, lower-case title and summary, their length before lowering, date and language flag.

    Items shorter than MIN_CHARS go. An item whose language can't be told counts as in the language.
    """
    title, summary = strip_markup("title"), strip_markup("summary")
    out = items.withColumns({"_t": F.coalesce(title, F.lit("")), "_s": F.coalesce(summary, F.lit(""))})
    both = F.trim(F.concat_ws(" ", "_t", "_s"))
    out = out.withColumns(
        {
            "char_count": F.length(both),
            "is_target_language": F.coalesce(detected_language(both) == language, F.lit(True)),
            "cleaned_title": F.lower("_t"),
            "cleaned_summary": F.lower("_s"),
            "published_at": iso_date(F.col("published_date"), F.lit(run_at).cast("timestamp")),
        }
    ).drop("_t", "_s")
    return out if keep_short else out.filter(F.col("char_count") >= MIN_CHARS)


Scorer = Callable[[list[str]], list[dict[str, float]]]

#: Words of the default scorer.
POSITIVE_WORDS = ("good", "great", "win", "success", "growth", "peace", "record", "award")
NEGATIVE_WORDS = ("bad", "crisis", "war", "death", "attack", "loss", "fraud", "crash")


def lexicon_scores(texts: list[str]) -> list[dict[str, float]]:
    """Default scorer: shares of positive and negative words, the rest neutral."""
    out = []
    for t in texts:
        w = (t or "").lower().split()
        p, n = sum(x in POSITIVE_WORDS for x in w), sum(x in NEGATIVE_WORDS for x in w)
        z = 1.0 + p + n
        out.append({"negative": n / z, "neutral": 1.0 / z, "positive": p / z})
    return out


def scored(articles: DataFrame, text: Column, scorer: Scorer = lexicon_scores, target: Column | None = None) -> DataFrame:
    """articles with sentiment_scores, label, raw and calibrated score; rows outside the target language get nulls.

    The scorer is called with batches of texts on the executors; a model loads itself once in each worker.
    """

    @F.pandas_udf(T.MapType(T.StringType(), T.DoubleType()))
    def run(column: pd.Series) -> pd.Series:
        return pd.Series(scorer(column.fillna("").tolist()))

    scores = F.col("_scores")
    ranked = [F.struct(F.element_at(scores, F.lit(k)).alias("v"), F.lit(-i).alias("o"), F.lit(k).alias("k")) for i, k in enumerate(LABELS)]
    rows = articles.withColumn("_scores", run(text))
    if target is not None:
        rows = rows.withColumn("_scores", F.when(target, scores))
    rows = rows.withColumn("sentiment_label", F.when(scores.isNotNull(), F.array_max(F.array(*ranked))["k"]))
    label = F.col("sentiment_label")
    return rows.withColumns(
        {
            "raw_sentiment_score": F.round(F.try_element_at(scores, label), 6),
            "calibrated_sentiment_score": F.when(label.isNotNull(), calibrated(label, scores)),
            "calibrated_sentiment_scores": F.when(label.isNotNull(), calibrated_scores(label, scores)),
        }
    ).withColumnRenamed("_scores", "sentiment_scores")
