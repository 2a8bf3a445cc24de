"""Named queries of the training-data operators over their whole tables, and SQL for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, centroids, decontaminate, minhash, oracles, pii, quality_rules, ranking, secrets, sharding, suffix_dedup, tool_calls,
    url_filters, variants,
)
from .common import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, sf_dir)).drop("text")


def op2_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"), whole=True)


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


def op4_multi_index_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir))


def op6_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ranking.classify(docs, ranking.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op8_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_grammar_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op11_bit_plane_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(documents(spark, sf_dir))


def op13_token_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), url_filters.default_rules(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_tool_call_linking": op2_tool_call_linking,
    "op3_contextual_pii": op3_contextual_pii,
    "op4_multi_index_minhash": op4_multi_index_minhash,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_bradley_terry": op6_bradley_terry,
    "op7_suffix_sort_dedup": op7_suffix_sort_dedup,
    "op8_transducer_bpe": op8_transducer_bpe,
    "op9_spaced_seeds": op9_spaced_seeds,
    "op10_grammar_secrets": op10_grammar_secrets,
    "op11_bit_plane_centroids": op11_bit_plane_centroids,
    "op12_permuterm_variants": op12_permuterm_variants,
    "op13_token_url_filters": op13_token_url_filters,
}
ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.quality_rules(),
    "op9_spaced_seeds": oracles.spaced_seeds(),
    "op11_bit_plane_centroids": oracles.bit_plane_centroids(),
    "op12_permuterm_variants": oracles.spelling_variants(),
    "op13_token_url_filters": oracles.url_filters(),
}
