"""A corpus pipeline: each stage works on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and rereads as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import jaccard, linededup, mixing, packing, quality
from casebook.llm.common import saved, scope, scratch
from casebook.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines stay where they come first; emptied documents go."""
    return linededup.deduped(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents stays."""
    return jaccard.one_of_each(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of smaller sources up to twice."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens at most."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing_weights),
    ("packing", packed),
]

#: The stages hash, pack and compare byte by byte in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``.

    What a stage stored on its way goes when its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        with scope(spark):
            docs = saved(stage(spark, docs, sf_dir), name, path)
    return docs
