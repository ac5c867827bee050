"""Readers and writers of reviewed samples, gold sets, evaluations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.scores import LABELS

GOLD = "text string, label int, country string, source_name string, row_id string, collected_date string, label_source string, review_status string, source_file string"


def reviewed_rows(spark: SparkSession, path: str, predicted: str, reviewed: str, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """CSV rows where both labels are valid."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.filter(F.col(predicted).isin(*labels) & F.col(reviewed).isin(*labels))


def gold_rows(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with a valid label and a text."""
    rows = spark.read.schema(GOLD).json(path)
    return rows.filter(F.col("label").isin(*range(len(LABELS))) & (F.trim(F.coalesce("text", F.lit(""))) != ""))


def human_evaluation(spark: SparkSession, path: str, seeds: DataFrame) -> DataFrame:
    """Items of an evaluation file with a valid human label, with the seed rows of their ids."""
    items = spark.read.schema("items array<struct<id:string,human_label:string>>").json(path, multiLine=True).select(F.explode("items").alias("i"))
    return items.select("i.id", "i.human_label").filter(F.col("human_label").isin(*LABELS)).join(seeds, "id")


def latest(spark: SparkSession, folder: str, prefix: str = "source_health_") -> DataFrame:
    """The report whose file name is last in order, with its name."""
    rows = spark.read.json(f"{folder}/{prefix}*.json", multiLine=True).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    top = rows.agg(F.max("file").alias("file"))
    return rows.join(F.broadcast(top), "file")


def write_reviews(sample: DataFrame, path: str, columns: list[str]) -> None:
    """One CSV with the columns in this order. For samples, which are small."""
    sample.select(*columns).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def write_report(report: DataFrame, path: str) -> None:
    """One JSON file; reports are a few rows."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_gold(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def drift_markdown(row) -> str:
    """A drift report in words. row: one row of news.drift()."""
    head = f"### Drift {row['country_code']} {row['collected_date']}: {row['status']}"
    if row["status"] != "ok":
        return f"{head}\n\n{row['baseline_days']} baseline days are too few."
    deltas = "\n".join(f"| {k} | {row[f'delta_{k}']:+.4f} |" for k in LABELS)
    return f"{head}\n\nPSI {row['psi']:.4f} ({row['severity']}) over {row['baseline_days']} days, {row['today_total']} articles.\n\n| label | change |\n|-|-|\n{deltas}"


def drift_text() -> Column:
    """The same words as drift_markdown, as a column over rows of news.drift()."""
    head = F.format_string("### Drift %s %s: %s", "country_code", F.col("collected_date").cast("string"), "status")
    few = F.format_string("%s\n\n%d baseline days are too few.", head, "baseline_days")
    deltas = F.array_join(F.array(*[F.format_string(f"| {k} | %+.4f |", f"delta_{k}") for k in LABELS]), "\n")
    full = F.format_string("%s\n\nPSI %.4f (%s) over %d days, %d articles.\n\n| label | change |\n|-|-|\n%s", head, "psi", "severity", "baseline_days", "today_total", deltas)
    return F.when(F.col("status") == "ok", full).otherwise(few)


def metrics(step: str, df: DataFrame, **values) -> DataFrame:
    """Metric rows (step, metric, value) from aggregate expressions over df."""
    found = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    pairs = [F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in values]
    return found.select(F.lit(step).alias("step"), F.explode(F.array(*pairs)).alias("m")).select("step", "m.metric", "m.value")
