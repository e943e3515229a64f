"""The dealt operators as queries over their whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliograph.llm import (
    ball_tree,
    byte_bpe,
    chat_tree,
    decontamination,
    lexical_search,
    license_scan,
    lm_score,
    near_dup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    substring_dedup,
)
from foliograph.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.line_rules(table(spark, sf, "documents"))


def op2_chat_tree(spark: SparkSession, sf: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = table(spark, sf, "conversations").select(*extra.columns).unionByName(extra)
    return chat_tree.read_back(*chat_tree.prefix_trees(rows))


def op3_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf, "documents"), shingle=4)


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf, "documents"), 35)


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents"))


def op9_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.scored(table(spark, sf, "documents"))


def op10_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality_classifier.classified(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_top_k(spark: SparkSession, sf: str) -> DataFrame:
    vectors = ball_tree.scaled(table(spark, sf, "embeddings"), 256)
    return ball_tree.top_inner_products(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_decode(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document by its id's checksum ends in repetitions of a stretch of its own."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(checksum % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = docs.select("doc_id", "text", words.alias("words"), F.floor(checksum / 10).alias("g"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    planted = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))),
    )
    return rows.select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs.run_digests(with_planted_periods(table(spark, sf, "documents")))


def op12_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_chat_tree": op2_chat_tree,
    "op3_near_dup": op3_near_dup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_top_k": op6_top_k,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_license_scan": op8_license_scan,
    "op9_lm_score": op9_lm_score,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontamination": op12_decontamination,
    "op13_lexical_search": op13_lexical_search,
}
