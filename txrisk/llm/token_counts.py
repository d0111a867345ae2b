"""Token counts of whole texts, through a cache keyed by digests.

A cache row says how many tokens the content of one digest has under one
tokenizer version. Documents meet the cache by digest; content not in it is
encoded once, however many documents hold it, and added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
ENCODE_BYTES = 1 << 20  # bytes of texts encoded at once (one longer text at least)
CACHE_DDL = "version string, digest binary, n_tokens long"


@cache
def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    return Tokenizer.from_file(path)


def installed(name: str = TOKENIZER) -> str:
    """Where an installed vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def version(path: str) -> str:
    """Digest of what decides a count: the vocabulary file and the library."""
    import tokenizers

    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{tokenizers.__version__} {content}".encode()).hexdigest()


def _content():
    return F.coalesce(F.col("text"), F.lit(""))


def _digest():
    return F.unhex(F.sha2(_content().cast("binary"), 256))


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(path)
        for batch in batches:
            counts, waiting, size = [], [], 0
            for text in batch.column("text"):
                waiting.append(text.as_py())
                size += len(waiting[-1])
                if size >= ENCODE_BYTES:
                    found = encoder.encode_batch_fast(waiting, add_special_tokens=False)
                    counts += [len(x) for x in found]
                    waiting, size = [], 0
            found = encoder.encode_batch_fast(waiting, add_special_tokens=False)
            counts += [len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())],
                names=["digest", "n_tokens"],
            )

    return encode


def read_cache(spark: SparkSession, cache_dir: str) -> DataFrame:
    """The cache, empty if nothing has been added yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_dir)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return (
        spark.read.schema(CACHE_DDL).parquet(cache_dir)
        if there
        else spark.createDataFrame([], CACHE_DDL)
    )


def add_missing(documents: DataFrame, cache_dir: str, path: str) -> None:
    """Encode the documents' contents that the cache lacks, and append their counts.

    Contents are grouped by digest inside each task first, so that a text held by
    a third of all documents moves once per task.
    """
    spark = documents.sparkSession
    known = read_cache(spark, cache_dir).filter(F.col("version") == version(path))
    contents = documents.groupBy(_digest().alias("digest")).agg(F.first(_content()).alias("text"))
    missing = contents.join(known.select("digest"), "digest", "left_anti")
    counted = missing.mapInArrow(_encode(path), "digest binary, n_tokens long")
    rows = counted.select(F.lit(version(path)).alias("version"), "digest", "n_tokens")
    rows.write.mode("append").parquet(cache_dir)


def count_tokens(
    documents: DataFrame, cache_dir: str, work_dir: str, path: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, a row per row.

    ``cache_dir`` is kept between runs; ``work_dir`` is a folder of this run alone,
    both on shared storage. No special token is added; special strings inside a
    text are tokens, as is the library's default. A null text counts as empty, with
    0 tokens. Repeated rows and null ids are counted like any. Runs that append at
    the same time may both add a digest: each run first takes one count per digest
    it needs. Other columns are left behind.
    """
    spark = documents.sparkSession
    path = path or installed()
    add_missing(documents, cache_dir, path)
    counts = read_cache(spark, cache_dir).filter(F.col("version") == version(path))
    needed = documents.select(_digest().alias("digest")).distinct()
    needed.join(counts, "digest").groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens")
    ).write.parquet(work_dir)
    mine = spark.read.schema("digest binary, n_tokens long").parquet(work_dir)
    keyed = documents.select(
        "doc_id",
        F.octet_length(_content()).cast("long").alias("n_bytes"),
        _digest().alias("digest"),
    )
    return keyed.join(mine, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
