"""From raw documents to a mix for training, in stages that are written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what the next stage reads as its documents. All but the last return the
columns of ``documents``; a text may be shorter after the third.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import decontaminate, mixing, near_dedup, quality_rules, suffix_dedup
from txrisk.session import scratch_path

NEAR_WORDS, NEAR_PERCENT = 5, 80  # words of a shingle; similarity of near duplicates


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble what labels trust."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id."""
    return near_dedup.keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier in the corpus."""
    return suffix_dedup.remove(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no question of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken, and the shard of each."""
    return mixing.shards(docs, scratch_path(spark, "pipeline-shards"))


STAGES = [
    ("quality_rules", good_documents),
    ("near_dedup", one_of_near_copies),
    ("suffix_dedup", without_repeats),
    ("decontaminate", without_benchmark),
    ("mixing", mixed),
]

#: Hashes of texts, likelihoods and suffix order are beyond SQL; tests compare
#: each stage with a plain version over small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
