"""Clusters of vectors, their quality and titles."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.vectors import dot


def kmeans(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 42) -> DataFrame:
    """(id, cluster_id) by k-means over all rows, at most as many clusters as rows."""
    rows = vectors.filter(F.col(vector_col).isNotNull()).select(id_col, array_to_vector(F.col(vector_col).cast("array<double>")).alias("features"))
    n = rows.limit(k).count()
    if n < 2:
        return rows.select(id_col, F.lit(0).alias("cluster_id"))
    model = KMeans(k=min(k, n), seed=seed, maxIter=30, featuresCol="features", predictionCol="cluster_id").fit(rows)
    return model.transform(rows).select(id_col, "cluster_id")


def silhouette(vectors: DataFrame, clusters: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Mean cosine silhouette of what is not noise; 0 with fewer than two clusters."""
    rows = vectors.join(clusters.filter("cluster_id >= 0"), id_col).select(array_to_vector(F.col(vector_col).cast("array<double>")).alias("features"), "cluster_id")
    if rows.select("cluster_id").distinct().limit(2).count() < 2:
        return 0.0
    return ClusteringEvaluator(predictionCol="cluster_id", distanceMeasure="cosine").evaluate(rows)


def hashed_embedding(texts: DataFrame, id_col: str, text_col: str, dim: int = 384) -> DataFrame:
    """Default embedder: signed hashed words, of norm 1; built-in functions only."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    rows = texts.select(id_col, F.explode_outer(words).alias("w"))
    slot, sign = F.pmod(F.xxhash64("w"), F.lit(dim)).cast("int"), F.when(F.pmod(F.xxhash64("w", F.lit(1)), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    sums = rows.groupBy(id_col, F.when(F.col("w").isNotNull(), slot).alias("slot")).agg(F.sum(sign).alias("v"))
    packed = sums.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "v")))).alias("m"), F.sqrt(F.sum(F.when(F.col("slot").isNotNull(), F.col("v") * F.col("v")).otherwise(0.0))).alias("norm"))
    value = lambda i: F.coalesce(F.try_divide(F.try_element_at("m", i.cast("int")), F.col("norm")), F.lit(0.0)).cast("float")
    return packed.select(id_col, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), value).alias("embedding"))


def titles(keywords: DataFrame, entities: DataFrame) -> DataFrame:
    """cluster_id, title: the first keyword, and the most frequent entity unless they are equal; 'Genel' without keywords.

    keywords: cluster_id, term, rank. entities: cluster_id, name, one row an occurrence; pieces with ## don't count.
    """
    first = keywords.groupBy("cluster_id").agg(F.min_by("term", "rank").alias("term"))
    counts = entities.filter(~F.col("name").contains("##") & (F.col("name") != "")).groupBy("cluster_id", "name").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cluster_id").orderBy(F.col("n").desc(), "name")
    top = counts.withColumn("k", F.row_number().over(w)).filter("k = 1").select("cluster_id", "name")
    both = first.join(top, "cluster_id", "full")
    lead = F.coalesce(F.initcap("term"), F.lit("Genel"))
    return both.select("cluster_id", F.when(F.col("name").isNotNull() & (F.lower("name") != F.lower(lead)), F.concat(lead, F.lit(" · "), F.col("name"))).otherwise(lead).alias("title"))


def silhouette_rows(vectors: DataFrame, cluster_col: str = "cluster_id", vector_col: str = "embedding") -> DataFrame:
    """vectors with their cosine silhouette, from the sum of unit vectors of each cluster: the mean over a cluster's pairs.

    Null and zero vectors go, noise (a negative cluster) too; one of its kind has 0. The sums are one row a cluster.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.filter(F.col(cluster_col) >= 0).withColumn("_n", F.sqrt(dot(v, v))).filter("_n > 0").withColumn("_u", F.transform(v, lambda x: x / F.col("_n"))).drop("_n")
    total = rows.groupBy(cluster_col).agg(Summarizer.sum(array_to_vector("_u")).alias("s"), F.count(F.lit(1)).alias("n"))
    known = total.agg(F.collect_list(F.struct(F.col(cluster_col).alias("c"), vector_to_array("s").alias("s"), "n")).alias("_all"))
    own, u = F.col(cluster_col), F.col("_u")
    out = rows.join(F.broadcast(known))  # one row
    near = F.filter("_all", lambda x: x["c"] == own)[0]
    within = F.try_divide(near["n"] - dot(u, near["s"]), near["n"] - 1)
    others = F.transform(F.filter("_all", lambda x: x["c"] != own), lambda x: 1 - dot(u, x["s"]) / x["n"])
    between = F.array_min(others)
    value = F.when((near["n"] == 1) | between.isNull(), 0.0).otherwise(F.coalesce(F.try_divide(between - within, F.greatest(within, between)), F.lit(0.0)))
    return out.withColumn("silhouette", value).drop("_u", "_all")


def largest(rows: DataFrame, within: list[str], k: int, **also) -> DataFrame:
    """The k largest clusters of each slice with their sizes and the aggregates named; ties by number."""
    sums = rows.groupBy(*within, "cluster_id").agg(F.count(F.lit(1)).alias("size"), *[c.alias(n) for n, c in also.items()])
    w = Window.partitionBy(*within).orderBy(F.col("size").desc(), "cluster_id")
    return sums.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def run_metrics(rows: DataFrame, within: list[str], most: float = 0.25, noise: float = 0.4) -> DataFrame:
    """Per slice: clusters, size of the largest, share of noise, and whether one exceeds its bound."""
    sizes = rows.groupBy(*within, "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    real = F.when(F.col("cluster_id") >= 0, F.col("n"))
    out = sizes.groupBy(*within).agg(F.count(real).alias("clusters"), F.max(real).alias("largest"), F.sum("n").alias("_all"), F.coalesce(F.sum(F.when(F.col("cluster_id") < 0, F.col("n"))), F.lit(0)).alias("_noise"))
    share = F.round(F.col("_noise") / F.col("_all"), 6)
    warn = F.coalesce(F.col("largest") / F.col("_all") > most, F.lit(False)) | (share > noise)
    return out.select(*within, "clusters", "largest", share.alias("noise"), warn.alias("warn"))
