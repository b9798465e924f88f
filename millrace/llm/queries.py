"""The registered queries of the package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    op01_html,
    op02_urls,
    op03_mix,
    op04_media,
    op05_toxicity,
    op06_bpe,
    op07_chat,
    op08_quality,
    op09_pii,
    op10_dartminhash,
    op11_merkle,
    op12_phrases,
    op13_packing,
)
from millrace.sources import read_table


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_html.extract(read_table(spark, sf_dir, "pages"))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_urls.judge(read_table(spark, sf_dir, "pages"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_mix.mix_sources(read_table(spark, sf_dir, "documents"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Shards have new names on each run; what they hold does not change.
    return op04_media.media(read_table(spark, sf_dir, "documents")).drop("shard", "at")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_toxicity.toxicity(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_bpe.digests(read_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op07_chat.planted(read_table(spark, sf_dir, "conversations"))
    return op07_chat.read_back(op07_chat.format_turns(rows))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_quality.quality(read_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_pii.find_personal(read_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_dartminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_merkle.proofs(read_table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_packing_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_packing.pack(read_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_urls": op2_urls,
    "op3_mix": op3_mix,
    "op4_media": op4_media,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_chat": op7_chat,
    "op8_quality": op8_quality,
    "op9_pii": op9_pii,
    "op10_dartminhash": op10_near_duplicates,
    "op11_merkle": op11_merkle_manifest,
    "op12_phrases": op12_phrase_collocations,
    "op13_packing": op13_packing_tiers,
}

# The others are tested against brute force: SQL has no trained model or tree to offer.
ORACLE_SQL: dict[str, str] = {
    "op3_mix": op03_mix.MIX_SQL,
    "op7_chat": op07_chat.CHAT_SQL,
    "op8_quality": op08_quality.QUALITY_SQL,
    "op11_merkle": op11_merkle.MERKLE_SQL,
    "op12_phrases": op12_phrases.PHRASES_SQL,
}
