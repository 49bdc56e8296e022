"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import (bpe, cotraining, decontaminate, jaccard_join, merkle, packing, pii, pq_dedup, sharding, spelling, token_index,
                            unigram, windows)
from promolens.llm.common import scratch
from promolens.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.op4_digest(spark, _table(spark, sf_dir, "documents"), scratch(spark, "ids"), tokenizer_path("byte_bpe_50k.json"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.remove_repeats(_table(spark, sf_dir, "documents"), 35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = cotraining.fit(docs, _table(spark, sf_dir, "labels"))
    return cotraining.classify(docs, model).select("doc_id", "text_score", "page_score", "score", "kept")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), 16)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(_table(spark, sf_dir, "documents"), 4, 85, 100).select("doc_id", "n_shingles", "component_id")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.op11_digest(_table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op12_variants(_table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op13_digest(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    "op1_contextual_pii": op1,
    "op2_harmonic_packing": op2,
    "op3_pq_near_duplicates": op3,
    "op4_token_index": op4,
    "op5_unigram_counts": op5,
    "op6_repeated_windows": op6,
    "op7_benchmark_matches": op7,
    "op8_cotraining_quality": op8,
    "op9_balanced_sharding": op9,
    "op10_jaccard_join": op10,
    "op11_merkle_manifest": op11,
    "op12_spelling_variants": op12,
    "op13_bpe_round_trip": op13,
}
