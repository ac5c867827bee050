"""Nearest vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.vectors import cosine


def nearest(vectors: DataFrame, query: list[float], k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows nearest to one query vector: each task keeps its best k, so nothing but those is moved."""
    q = F.array(*[F.lit(float(x)) for x in query])
    out = vectors.select(id_col, cosine(F.col(vector_col), q).alias("similarity")).orderBy(F.col("similarity").desc_nulls_last(), id_col).limit(k)
    return out.withColumn("similarity", F.round("similarity", 4))
