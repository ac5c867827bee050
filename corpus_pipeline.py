"""From documents to packed windows: language, exact copies, near copies, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import exact_dedup, langid, mixing, packing, simhash
from broadsheet.llm.common import stage, table
from broadsheet.llm.queries import MIX_WEIGHTS, TOKENIZER, domain_of_labels


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; `und` and narrow margins go."""
    return langid.accepted_rows(docs, langid.train(docs, F.lit(True)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more), the document with the smallest doc_id."""
    return simhash.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned towards the target weights of the domains: none is repeated after the copies have gone, and clean
    documents stay, where rates without a bound would meet the targets by dropping some and repeating others."""
    model = mixing.fit_domains(docs, table(spark, sf_dir, "labels"), domain_of_labels())
    return mixing.mixed_rows(docs, model, MIX_WEIGHTS, thin=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of at most 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mixture", mixture), ("packing", packed)]
#: SQL expresses exact dedup only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
