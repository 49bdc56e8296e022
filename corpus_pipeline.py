"""Corpus pipeline over ``documents``: each stage works on all that the one
before kept, written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import cotraining, decontaminate, jaccard_join, packing, pii
from promolens.llm.common import staged
from promolens.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier rejects go."""
    model = cotraining.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.classify(docs.select(COLUMNS), model).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group linked by five-word shingles at a Jaccard
    index of 0.8 or more the document with the smallest id stays."""
    return jaccard_join.one_per_class(docs.select(COLUMNS), 5, 80, 100)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that share a passage with a benchmark item go."""
    return decontaminate.without_matches(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: personal data in the texts is replaced by its kind; n_chars
    follows the text."""
    return pii.redact(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of at most 2048 ids with their places."""
    return packing.pack_digest(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_pii),
    ("packing", packed),
]

# classifier, alignment and tokenizer are beyond SQL: the stages are tested against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage{k}")
    return docs
