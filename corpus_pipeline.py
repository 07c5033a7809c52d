"""Documents to packed training sequences, in five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourgrid.llm import decontaminate, exact_dedup, packing, quality, simhash
from hourgrid.llm.common import table
from hourgrid.llm.queries import quality_model, tokenizer
from hourgrid.session import scratch_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, quality_model(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest identifier."""
    return exact_dedup.deduplicate(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest identifier, and no other."""
    return simhash.deduplicate(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens.

    Workers remember few words, as they live on through the other stages of later runs.
    """
    return packing.pack_documents(docs, tokenizer(), words_kept=1 << 18)


STAGES = [
    ("quality", good),
    ("exact_dedup", distinct),
    ("simhash", unlike),
    ("decontaminate", clean),
    ("packing", packed),
]

#: Trained trees, SimHash and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
