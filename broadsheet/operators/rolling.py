"""Rolling windows for many end dates at once: a day enters a window and leaves it, nothing is summed again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.association import llr, pmi
from broadsheet.operators.collocations import TOP

SPAN = ["country_code", "window_days"]


def steps(daily: DataFrame, keys: list[str], value: str, first: date, days: int, windows: tuple[int, ...]) -> DataFrame:
    """(keys, window_days, steps): for each window what is added to its sum, and from which end date on, counted from `first`.

    daily: keys, collected_date, value, one row a key and day. A day gives two steps a window, its entry and its exit, or
    none if no window of these end dates has it. A list holds at most two steps a day of the dates and the window.
    """
    at = F.datediff("collected_date", F.lit(first))
    both = F.array(*[F.struct(F.lit(w).alias("window_days"), F.greatest(at, F.lit(0)).alias("lo"), F.least(at + w, F.lit(days)).alias("hi")) for w in windows])
    spans = daily.withColumn("_s", F.explode(F.filter(both, lambda s: s["lo"] < s["hi"])))
    pair = F.array(F.struct(F.col("_s.lo").alias("at"), F.col(value).cast("bigint").alias("v")), F.struct(F.col("_s.hi").alias("at"), (-F.col(value)).cast("bigint").alias("v")))
    return spans.groupBy(*keys, F.col("_s.window_days").alias("window_days")).agg(F.sort_array(F.flatten(F.collect_list(pair))).alias("steps"))


def series(steps: Column, days: int) -> Column:
    """The window's sum for each end date, from sorted steps; each step is read once."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("at"))
    laid = lambda acc, end: F.concat(acc["out"], F.array_repeat(acc["sum"], end - acc["at"]))
    step = lambda acc, s: F.struct(laid(acc, s["at"]).alias("out"), (acc["sum"] + s["v"]).alias("sum"), s["at"].alias("at"))
    return F.aggregate(steps, start, step, lambda acc: laid(acc, F.lit(days)))


def association(counts: DataFrame, first: date, last: date, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """window_association for every end date from first to last: country_code, window_days, end_date, canonical, lemma, c11, r,
    t, n, days (those of the entity with counts), pmi, llr.

    Sums of all windows come from steps, so what is shuffled are two steps a daily count and window, then one row a pair and
    window; end dates are laid out last, within the partitions of an entity. Sums of lemmas, entities and countries are made
    once for each of them, before they meet the pairs. An end date whose window has nothing has no
    rows; neither has an empty table. counts (country_code, collected_date, canonical, lemma, c11; one row each of the first
    four, rows with a null among these go) is read five times, so give a stored table; its other columns are not read.
    """
    days = (last - first).days + 1
    if days < 1 or min(windows) < 1:
        raise ValueError("last must not be before first, and windows have at least a day")
    country, day = ["country_code"], "collected_date"
    of = lambda keys, value, name: steps(counts.groupBy(*keys, day).agg(value.alias("_v")), keys, "_v", first, days, windows).select(*SPAN, *keys[1:], series(F.col("steps"), days).alias(name))
    counts = counts.dropna(subset=["country_code", day, "canonical", "lemma"])
    pairs = steps(counts, [*country, "canonical", "lemma"], "c11", first, days, windows).withColumnRenamed("steps", "_c")
    entity = of([*country, "canonical"], F.sum("c11"), "_r").join(of([*country, "canonical"], F.max(F.lit(1)), "_d"), [*SPAN, "canonical"])
    lemma, total = of([*country, "lemma"], F.sum("c11"), "_t"), of(country, F.sum("c11"), "_n")
    rows = pairs.join(lemma, [*SPAN, "lemma"]).join(entity.join(total, SPAN), [*SPAN, "canonical"])
    rows = rows.withColumn("_c", series(F.col("_c"), days))
    value = lambda name, i: F.element_at(name, i)
    laid = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda i: F.struct(F.date_add(F.lit(first), i - 1).alias("end_date"), value("_c", i).alias("c11"), value("_r", i).alias("r"), value("_t", i).alias("t"), value("_n", i).alias("n"), value("_d", i).alias("days")))
    out = rows.select(*SPAN, "canonical", "lemma", F.explode(F.filter(laid, lambda x: x["c11"] > 0)).alias("_x")).select(*SPAN, "canonical", "lemma", "_x.*")
    args = [F.col(c) for c in ("c11", "r", "t", "n")]
    return out.withColumn("pmi", pmi(*args)).withColumn("llr", llr(*args))


def profiles(counts: DataFrame, first: date, last: date, windows: tuple[int, ...] = (7, 30), k: int = TOP) -> DataFrame:
    """One row an entity, window and end date: coverage, totals, mean statistics over all collocates and the top k as an array."""
    keys = [*SPAN, "end_date", "canonical"]
    stats = association(counts, first, last, windows)
    # the number comes first, as a sort compares long integers at once and texts only where they are equal
    stats = stats.withColumn("_group", F.xxhash64(*keys))
    w = Window.partitionBy("_group", *keys).orderBy(F.round("llr", 9).desc(), F.round("pmi", 9).desc(), "lemma")
    ranked = stats.withColumn("rank", F.row_number().over(w))
    top = F.when(F.col("rank") <= k, F.struct("rank", "lemma", "c11", "pmi", "llr"))
    return ranked.groupBy(*keys).agg(
        F.max("days").alias("coverage_days"),
        F.sum("c11").alias("total_cooccurrences"),
        F.max("n").alias("window_total"),
        F.avg("pmi").alias("avg_pmi"),
        F.avg("llr").alias("avg_llr"),
        F.sort_array(F.collect_list(top)).alias("top_collocates"),
    )
