"""Registered queries of the corpus operators, over whole tables.

Each query applies its operator with production parameters and derives the
contract's columns from the operator's own result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.llm import (ann, bpe, extraction, jaccard, linededup, middle, mixing, packing, quality,
                          secrets, sharding, spelling, warc)
from casebook.llm.common import scratch
from casebook.llm.oracle import SQL  # noqa: F401  (read by the driver's entry)


def tokenizer() -> str:
    """The vocabulary file that the packing queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def ranks() -> str:
    """The file of token ranks that the encoding query uses."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mixing_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mixture(_table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "source", "tokens", F.round("weight", 9).alias("weight"),
                        "epoch", "block", "place")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.nearest(rows.where("vec_id % 100 = 0"), rows)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer())


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = quality.rate(docs, _table(spark, sf_dir, "labels"))
    return rated.select("doc_id", *quality.MEASURES, "base_failed", "kept",
                        F.round("score", 6).alias("score"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = secrets.scan_paths(docs, "text")
    spans = F.col("spans")
    return found.select(
        "doc_id", *(F.size(secrets.of_kinds(spans, k)).cast("bigint").alias(f"n_{k}")
                    for k in secrets.BASE),
        F.sha2(secrets.spelled(secrets.of_kinds(spans, *secrets.BASE)), 256).alias("base_sha256"),
        secrets.spelled(spans).alias("spans"))


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archive")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.restore(warc.read(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "n_text_links", "n_copies")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs, join_runs=True).select(
        "doc_id", "text", F.size("removed").alias("n_removed_chunks"),
        F.expr("aggregate(removed, 0L, (n, x) -> n + x.lines)").alias("n_removed_lines"),
        F.expr("array_join(transform(removed, x -> concat(x.begin, ':', x.end)), ',')")
        .alias("removed_spans"))


def spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words(_table(spark, sf_dir, "documents")))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.transform(_table(spark, sf_dir, "documents"))
    back = middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ranks()
    ids = bpe.encode(_table(spark, sf_dir, "documents"), path)
    return bpe.decode(ids, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing_draws,
    "op2_nearest": nearest_vectors,
    "op3_sharding": shards,
    "op4_packing": packed_pieces,
    "op5_quality": quality_rules,
    "op6_extraction": page_texts,
    "op7_secrets": secret_spans,
    "op8_warc": warc_records,
    "op9_jaccard_join": jaccard_classes,
    "op10_line_dedup": line_dedup,
    "op11_spelling": spelling_forms,
    "op12_fill_in_middle": fill_in_middle,
    "op13_byte_bpe": byte_bpe,
}
