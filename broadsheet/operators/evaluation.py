"""Evaluation of predictions and audits of profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.association import percent, ratio
from broadsheet.operators.collocations import FRAMES, dominant_frame


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def class_metrics(pairs: DataFrame, labels: list) -> DataFrame:
    """Per label: counts, precision, recall and F1 (4 digits, 0 where undefined); macro F1 is the mean of rounded F1s.

    pairs: actual, predicted. They are counted before labels are spread over the counts.
    """
    c = confusion(pairs).withColumn("label", F.explode(F.array(*map(F.lit, labels))))
    a, p, k, n = F.col("actual") == F.col("label"), F.col("predicted") == F.col("label"), F.col("label"), F.col("n")
    m = c.groupBy("label").agg(
        F.coalesce(F.sum(F.when(a & p, n)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(~a & p, n)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(a & ~p, n)), F.lit(0)).alias("fn"),
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("actual") == F.col("predicted"), n)), F.lit(0)).alias("hits"),
    )
    share = lambda x, y: F.coalesce(F.round(ratio(x, y), 4), F.lit(0.0))
    tp, fp, fn = (F.col(x) for x in ("tp", "fp", "fn"))
    m = m.select(k, tp, fp, fn, share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"), share(F.col("hits"), F.col("n")).alias("accuracy"))
    return m.withColumn("macro_f1", F.round(F.avg("f1").over(Window.partitionBy()), 4))


def gates(metrics: DataFrame, macro: float = 0.80, each: float = 0.70, human: float | None = None, baseline: float = 0.0, gain: float = 0.02) -> DataFrame:
    """One row: whether a model with these class metrics may be promoted."""
    out = metrics.agg(F.max("macro_f1").alias("macro_f1"), F.min("f1").alias("least_f1"))
    human_ok = F.lit(True) if human is None else F.lit(human >= baseline + gain)
    return out.withColumn("passed", (F.col("macro_f1") >= macro) & (F.col("least_f1") >= each) & human_ok)


def frame_audit(top: DataFrame, frames: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """One row: coverage of profiles by frames, collocates outside the lexicon, and the entropy of dominant frames."""
    seeds = lexicon.select("lemma").distinct()
    marked = top.join(seeds.withColumn("_seed", F.lit(True)), "lemma", "left")
    per = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("_seed").isNull()).alias("u"))
    p = per.agg(F.count(F.lit(1)).alias("profiles"), F.sum("c").alias("collocates"), F.sum("u").alias("unassigned"))
    dominant = frames.select(dominant_frame().alias("frame")).groupBy("frame").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.col("z")
    h = dominant.crossJoin(F.broadcast(dominant.agg(F.sum("n").cast("double").alias("z")))).agg(F.sum("n").alias("with_frames"), (-F.sum(share * F.log2(share))).alias("bits"))
    return p.crossJoin(h).select(
        "profiles", "with_frames", percent(F.col("with_frames"), F.col("profiles")).alias("frame_coverage_pct"), "collocates", "unassigned",
        percent(F.col("unassigned"), F.col("collocates")).alias("unassigned_pct"), F.round("bits", 3).alias("entropy_bits"), F.round(F.log2(F.lit(float(len(FRAMES)))), 3).alias("max_entropy_bits"),
    )


def latency(runs: DataFrame, by: str, ms: str) -> DataFrame:
    """Exact percentiles and throughput of timings in milliseconds."""
    q = [F.percentile(ms, p / 100).alias(f"p{p}") for p in (50, 95, 99)]
    return runs.groupBy(by).agg(*q, F.count(F.lit(1)).alias("n"), (1000 / F.avg(ms)).alias("per_second"))


def agreement(pairs: DataFrame) -> DataFrame:
    """Share of equal pairs, 0 where there are none."""
    return pairs.agg(F.coalesce(F.avg((F.col("actual") == F.col("predicted")).cast("double")), F.lit(0.0)).alias("agreement"))


def balanced(rows: DataFrame, label: str, order: str) -> DataFrame:
    """Rows with how often each is to be repeated, in turns, so that every label has as many rows as the largest.

    For sets of reviewed rows: one task sorts the ids and labels of a label.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.agg(F.max("_n").alias("_top"))
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(label).orderBy(order)))
    out = ranked.join(F.broadcast(counts), label).crossJoin(F.broadcast(top))
    return out.select(*rows.columns, (F.floor((F.col("_top") - F.col("_k")) / F.col("_n")) + 1).cast("int").alias("copies"))


def recall(pairs: DataFrame, by: str) -> DataFrame:
    """Expected names and those found, either inside the other whatever the case. pairs: expected, found."""
    e, f = F.lower("expected"), F.lower("found")
    return pairs.groupBy(by).agg(F.count(F.lit(1)).alias("expected"), F.count_if(f.contains(e) | e.contains(f)).alias("hits"))
