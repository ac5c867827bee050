"""Collocations of entity mentions, their statistics, rolling profiles and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.association import llr, pmi

WINDOW, LEAST_LETTERS, LEAST_COUNT, TOP = 10, 3, 2, 20
#: A letter of a word; what \p has in ASCII stands first, as it is looked up at once.
LETTER = r"[a-zA-Z0-9_\p{L}\p{N}]"
WORD = LETTER + "+"
#: Where a sentence ends.
SENTENCE_END = r"[.!?]\s"
#: Default rule for a mention: a capitalized word of at least four letters.
MENTION = r"^\p{Lu}\p{Ll}{3,}$"
#: Frames in their order.
FRAMES = ("economic", "security", "identity", "governance", "humanitarian", "conflict")
DAY = ["country_code", "collected_date"]


def sentences(articles: DataFrame) -> DataFrame:
    """One row a sentence that has words, with them in order as an array. Sentences of a text are numbered in order, with gaps."""
    split = articles.select("id", *DAY, F.posexplode(F.split("text", SENTENCE_END)).alias("sentence", "s"))
    # a filter on the words' number would go below them, and extract them twice
    return split.filter(F.col("s").rlike(LETTER)).select("id", *DAY, "sentence", F.regexp_extract_all("s", F.lit(WORD), F.lit(0)).alias("words"))


def token_windows(articles: DataFrame, window: int = WINDOW, least: int = LEAST_LETTERS, mention: str = MENTION) -> DataFrame:
    """One row for each word within `window` words of a mention in its sentence: country, day, canonical, lemma.

    Mentions are found, and their neighbours sliced, inside the sentence's array, so what is exploded grows with mentions
    and not with the square of the sentence; no self-join, and nothing is shuffled. Short words use up places.
    """

    def near(word, at):
        left = F.slice("words", F.greatest(at + 1 - window, F.lit(1)), F.least(at, F.lit(window)))
        right = F.slice("words", at + 2, F.lit(window))
        lemmas = F.transform(F.filter(F.concat(left, right), lambda w: F.length(w) >= least), F.lower)
        return F.when(word.rlike(mention), F.struct(word.alias("canonical"), lemmas.alias("lemmas")))

    found = F.filter(F.transform("words", near), lambda x: x.isNotNull())
    rows = sentences(articles).select("id", *DAY, F.explode(found).alias("m"))
    return rows.select("id", *DAY, "m.canonical", F.explode("m.lemmas").alias("lemma"))


def daily_counts(pairs: DataFrame, least: int = LEAST_COUNT, stopwords: DataFrame | None = None) -> DataFrame:
    """Pairs of each day that occur at least `least` times."""
    if stopwords is not None:
        pairs = pairs.join(stopwords, "lemma", "left_anti")
    return pairs.groupBy(*DAY, "canonical", "lemma").agg(F.count(F.lit(1)).alias("c11")).filter(F.col("c11") >= least)


def with_marginals(counts: DataFrame, within: list[str], entity: str = "canonical", count: str = "c11") -> DataFrame:
    """r, t, n: sums over the entity, over the lemma and over all in `within`; sums are made before they are joined on.

    counts is read for each sum, so give a stored table (sources.shared.stored) where it is dear to make.
    """
    by = lambda *k: counts.groupBy(*within, *k)
    r, t = by(entity).agg(F.sum(count).alias("r")), by("lemma").agg(F.sum(count).alias("t"))
    n = r.groupBy(*within).agg(F.sum("r").alias("n"))
    return counts.join(r, [*within, entity]).join(t, [*within, "lemma"]).join(n, within)


def daily_association(counts: DataFrame) -> DataFrame:
    m = with_marginals(counts, DAY)
    args = [F.col(c) for c in ("c11", "r", "t", "n")]
    return m.withColumn("pmi", pmi(*args)).withColumn("llr", llr(*args))


def window_association(counts: DataFrame, end, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Counts re-summed over each window that ends on `end`, with their statistics; one scan for all windows."""
    days = F.explode(F.array(*[F.lit(w) for w in windows]))
    rows = counts.withColumn("window_days", days).filter(F.col("collected_date").between(F.date_sub(F.lit(end).cast("date"), F.col("window_days") - 1), F.lit(end).cast("date")))
    summed = rows.groupBy("country_code", "window_days", "canonical", "lemma").agg(F.sum("c11").alias("c11"))
    m = with_marginals(summed, ["country_code", "window_days"])
    args = [F.col(c) for c in ("c11", "r", "t", "n")]
    return m.withColumn("pmi", pmi(*args)).withColumn("llr", llr(*args))


def ranked_collocates(stats: DataFrame, k: int = TOP) -> DataFrame:
    """The k collocates of each entity and window: llr, then pmi (9 digits, so that equal values tie), then lemma."""
    w = Window.partitionBy("country_code", "window_days", "canonical").orderBy(F.round("llr", 9).desc(), F.round("pmi", 9).desc(), "lemma")
    return stats.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def profiles(counts: DataFrame, end, windows: tuple[int, ...] = (7, 30), k: int = TOP, totals: DataFrame | None = None) -> DataFrame:
    """One row an entity and window: coverage, totals, mean statistics over all collocates, and the top k as an array.

    totals: country_code, collected_date, canonical, mentions; then total_mentions is their sum over the window.
    """
    stats = window_association(counts, end, windows)
    keys = ["country_code", "window_days", "canonical"]
    span = lambda df: df.withColumn("window_days", F.explode(F.array(*[F.lit(w) for w in windows]))).filter(F.col("collected_date").between(F.date_sub(F.lit(end).cast("date"), F.col("window_days") - 1), F.lit(end).cast("date")))
    days = span(counts.select(*DAY, "canonical").distinct()).groupBy(*keys).agg(F.count(F.lit(1)).alias("coverage_days"))
    means = stats.groupBy(*keys).agg(F.sum("c11").alias("total_cooccurrences"), F.max("n").alias("window_total"), F.avg("pmi").alias("avg_pmi"), F.avg("llr").alias("avg_llr"))
    top = ranked_collocates(stats, k).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "lemma", "c11", "pmi", "llr"))).alias("top_collocates"))
    out = means.join(days, keys).join(top, keys)
    if totals is not None:
        out = out.join(span(totals).groupBy(*keys).agg(F.sum("mentions").alias("total_mentions")), keys, "left").withColumn("total_mentions", F.coalesce("total_mentions", F.lit(0)))
    return out


def frame_intensities(top: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """Shares of positive llr by frame over the top collocates, zero for frames without any; entities without a match go.

    lexicon: lemma, frame (the first of a lemma's frames in FRAMES counts).
    """
    order = F.array_position(F.array(*map(F.lit, FRAMES)), F.col("frame"))
    first = lexicon.groupBy("lemma").agg(F.min_by("frame", order).alias("frame"))
    rows = top.join(F.broadcast(first) if _small(first) else first, "lemma")
    weight = F.greatest(F.col("llr"), F.lit(0.0))
    sums = rows.groupBy(*keys).agg(F.sum(weight).alias("all"), *[F.coalesce(F.sum(F.when(F.col("frame") == f, weight)), F.lit(0.0)).alias(f) for f in FRAMES])
    return sums.filter(F.col("all") > 0).select(*keys, *[(F.col(f) / F.col("all")).alias(f) for f in FRAMES])


def _small(df: DataFrame, rows: int = 100_000) -> bool:
    return df.limit(rows + 1).count() <= rows


def dominant_frame() -> Column:
    """The frame with the largest share above 0; ties go to the first of FRAMES."""
    best = F.greatest(*[F.col(f) for f in FRAMES])
    out = F.lit(None).cast("string")
    for f in reversed(FRAMES):
        out = F.when((F.col(f) == best) & (best > 0), f).otherwise(out)
    return out
