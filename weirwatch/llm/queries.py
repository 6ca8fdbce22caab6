"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.llm import (
    bpe_transducer, decontaminate, html_tree, language_model, line_quality, merkle, mixing, near_dup, periodic_runs, repeated_spans, secret_scan, stages,
    token_ids, toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_ids(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.describe(periodic_runs.collapsed_documents(docs, texts=False))


def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return bpe_transducer.round_trips(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), tampered=stages.crc_mod("doc_id", 7) == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_ids, op2_near_duplicates, op3_line_quality, op4_main_text, op5_toxicity, op6_repeated_spans, op7_secrets, op8_benchmark_leaks, op9_source_mix, op10_language_model,
        op11_periodic_runs, op12_bpe_transducer, op13_merkle_manifest,
    )
}
