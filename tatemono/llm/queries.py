"""One registered query per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tatemono.llm import (
    chat,
    hard_negatives,
    jaccard_join,
    mixing,
    near_dup,
    outliers,
    packing,
    prefix_trie,
    quality_mil,
    secrets,
    topk,
    url_filter,
    warc,
)
from tatemono.llm.sql import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

# The conversation that the formatting query adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_checksum(packing.pack(_table(spark, sf_dir, "documents")))


def op7_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge_documents(_table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op9_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    turns = turns.unionByName(spark.createDataFrame(added, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.expand(turns))


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_attention_mil": op1_attention_mil,
    "op2_mix_sources": op2_mix_sources,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_warc_round_trip": op4_warc_round_trip,
    "op5_secret_scan": op5_secret_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_robust_outliers": op7_robust_outliers,
    "op8_url_rules": op8_url_rules,
    "op9_chat_examples": op9_chat_examples,
    "op10_minhash_near_dup": op10_minhash_near_dup,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}
