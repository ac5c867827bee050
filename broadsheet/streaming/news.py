"""News as a stream: articles that arrive in files, deduplicated, with counts by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.functions.scores import LABELS

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def stream(spark: SparkSession, folder: str, schema: str = EVENTS, time: str = "ts", files: int = 100) -> DataFrame:
    """Files of a folder as they arrive; the time column gets a zone, which watermarks need."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder).withColumn(time, F.col(time).cast("timestamp"))


def distinct(rows: DataFrame, key: str, time: str = "ts", late: str = "2 days") -> DataFrame:
    """The first row of each key within the watermark; state older than that goes."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def daily_labels(rows: DataFrame, time: str = "ts", label: str = "sentiment_label") -> DataFrame:
    """Counts of labels by tumbling day."""
    return rows.groupBy(F.window(time, "1 day").alias("w")).agg(*[F.count_if(F.col(label) == k).alias(k) for k in LABELS], F.count(label).alias("total")).select(F.to_date("w.start").alias("collected_date"), *LABELS, "total")


def rolling(rows: DataFrame, time: str = "ts", days: int = 7) -> DataFrame:
    """Counts by sliding windows of `days`, one for each day."""
    return rows.groupBy(F.window(time, f"{days} days", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.end").alias("end_date"), "n")


def sessions(rows: DataFrame, key: str, time: str = "ts", gap: str = "30 minutes") -> DataFrame:
    """Sessions of a key, cut by gaps."""
    return rows.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def to_slices(rows: DataFrame, write, checkpoint: str) -> StreamingQuery:
    """Run over what has arrived; write(batch, days) replaces the days that a batch touches, so that a repeat is harmless."""

    def each(batch: DataFrame, _: int) -> None:
        kept = batch.persist()
        days = [r[0] for r in kept.select("collected_date").distinct().collect()]
        if days:
            write(kept, days)
        kept.unpersist()

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
