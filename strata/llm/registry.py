"""Queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    best_position,
    byte_bpe,
    conversation_repair,
    decontaminate,
    mixing,
    quality_classifier,
    quality_rules,
    secrets,
    sharding,
    simhash,
    substring_chains,
    suffix_dedup,
    warc,
)
from strata.llm.common import shared_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, folder, "documents"))


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    has_repeat = (F.col("n_removed") > 0).alias("has_repeat")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", has_repeat)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    assigned = sharding.assign(table(spark, folder, "documents"))
    return assigned.select("doc_id", "n_bytes", "shard", "depth")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op7_substring_chains(spark: SparkSession, folder: str) -> DataFrame:
    return substring_chains.repeated_passages(table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_counts(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, folder, "labels")))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return conversation_repair.repair_report(conversation_repair.damage(conversations), conversations)


def op12_best_position(spark: SparkSession, folder: str) -> DataFrame:
    return best_position.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(encoded, ranks))


def queries() -> dict[str, Query]:
    found = [
        op1_decontamination,
        op2_suffix_dedup,
        op3_mixing,
        op4_sharding,
        op5_simhash,
        op6_warc,
        op7_substring_chains,
        op8_secrets,
        op9_quality_classifier,
        op10_quality_rules,
        op11_conversation_repair,
        op12_best_position,
        op13_byte_bpe,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing.SQL,
        "op4_sharding": sharding.SQL,
        "op6_warc": warc.SQL,
        "op10_quality_rules": quality_rules.SQL,
        "op11_conversation_repair": conversation_repair.SQL,
        "op12_best_position": best_position.SQL,
    }
