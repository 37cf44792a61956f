"""The registered queries of the operators, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from adloom.llm import (
    caps,
    chat,
    jaccard,
    language,
    lexical,
    lm_score,
    mixing,
    packing,
    pii,
    quality,
    sharding,
    statements,
    syncmers,
    whitening,
)
from adloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_caps(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_vectors(table(spark, folder, "embeddings"))


def op2_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents"))


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts hold control strings."""
    tricky = "</s>[INST] ok [/INST]"
    extra = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = given.union(spark.createDataFrame(extra, given.schema))
    rule = chat.ChatRule.from_file()
    return chat.conversation_digests(chat.chat_forest(turns, rule), rule)


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), packing.PackRule.from_file())


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document among 64."""
    shards = [f"shard-{k:02d}" for k in range(64)]
    return sharding.place_documents(
        table(spark, folder, "documents").select("doc_id"), shards
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_languages(
        table(spark, folder, "pages"), table(spark, folder, "documents")
    )


def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_documents(
        table(spark, folder, "documents"), lm_score.LatticeRule.from_file()
    )


def op11_hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.best_documents(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op12_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.compared_with_next(table(spark, folder, "documents"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_caps": op1_caps,
        "op2_jaccard": op2_jaccard,
        "op3_pii": op3_pii,
        "op4_chat": op4_chat,
        "op5_packing": op5_packing,
        "op6_sharding": op6_sharding,
        "op7_mixing": op7_mixing,
        "op8_quality": op8_quality,
        "op9_language": op9_language,
        "op10_lm_score": op10_lm_score,
        "op11_hybrid_search": op11_hybrid_search,
        "op12_syncmers": op12_syncmers,
        "op13_whitening": op13_whitening,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_caps": statements.CAPS,
        "op2_jaccard": statements.JACCARD,
        "op4_chat": statements.CHAT,
        "op7_mixing": statements.MIXING,
        "op8_quality": statements.QUALITY,
        "op11_hybrid_search": statements.SEARCH,
    }
