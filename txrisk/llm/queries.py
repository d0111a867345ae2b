"""The registered queries of this subpackage, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import (
    conversation_repair,
    conversation_trie,
    decontaminate,
    language_id,
    mixing,
    near_dedup,
    quality_gam,
    quality_rules,
    sentencepiece_bpe,
    suffix_dedup,
    token_counts,
    toxicity,
    url_rules,
)
from txrisk.llm.ordered import sha256_in_order
from txrisk.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    weights = quality_rules.fit(documents, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(documents, weights)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.label(_table(spark, sf_dir, "documents"))


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return quality_gam.score(documents, quality_gam.fit(documents, _table(spark, sf_dir, "labels")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.judge(_table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_rules.judge(pages, url_rules.minimal_rules(pages, _table(spark, sf_dir, "labels")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = language_id.held_out()
    found = language_id.identify(documents, language_id.fit(documents, ~held_out))
    return found.withColumn("held_out", held_out)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.judge(_table(spark, sf_dir, "documents"), benchmark)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_path(spark, "token-run")
    # Kept between runs: the next one encodes what it has not seen.
    cache = f"{work.rpartition('/')[0]}/token-counts-{token_counts.version(token_counts.installed())[:16]}"
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), cache, work)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.grade(documents, toxicity.fit(documents, _table(spark, sf_dir, "labels")))

def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and what they decode to, as digests."""
    model = token_counts.installed("piece_bpe_32k.model")
    encoded = sentencepiece_bpe.encode(_table(spark, sf_dir, "documents"), model)
    return sentencepiece_bpe.decode(encoded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


_FORKED = 5  # turns that a conversation may take from another, at most


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations as paths, each begun with the first turns of the first of its hundred."""
    own = conversation_trie.paths(conversations)
    heads = own.filter("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, _FORKED).alias("head")
    )
    forked = own.withColumns(
        {
            "base": F.col("conv_id") - F.col("conv_id") % 100,
            "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int"),
        }
    ).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    tail = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return forked.select("conv_id", F.concat(head, tail).alias("turns"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = conversation_trie.build(rebuilt(_table(spark, sf_dir, "conversations")))
    listed = ends.withColumn("listed", F.array_join("ids", ","))
    digests = sha256_in_order(listed, "node", "shard", "listed", ",")
    return nodes.join(digests, "node", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in, by a hash of id and turn."""
    space = F.lit(" ")
    number = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    hurt = F.crc32(F.concat(number[0], F.lit(":"), number[1]).cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = conversations.withColumn("_hurt", hurt).filter("_hurt <> 0")
    times = F.when(F.col("_hurt") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_hurt") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("_hurt") == 1, "")
        .when(F.col("_hurt") == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
    ).drop("_copy")


_FAULTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    pieces = conversation_repair.repair(rows).withColumn("lines", F.array_join(lines, "\n"))
    whole = pieces.filter("whole").select(
        "conv_id", *_FAULTS, "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("sha256")
    )
    parts = pieces.filter("NOT whole")
    audit = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    sums = parts.groupBy(F.col("conv_id").alias("id")).agg(
        *[F.sum(c).alias(c) for c in _FAULTS], F.array_join(F.transform(audit, lambda x: x["audit"]), "").alias("audit")
    )
    said = sha256_in_order(parts.filter(F.size("roles") > 0), "conv_id", "piece", "lines", "\n")
    joined = sums.join(said, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = whole.unionByName(joined.withColumnRenamed("id", "conv_id")).withColumnRenamed("conv_id", "id")
    missing = conversation_repair.gaps(rows).withColumnRenamed("conv_id", "of")
    ids = conversations.select("conv_id").distinct()
    told = ids.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    told = told.join(missing, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return told.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_FAULTS)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_gam": op3_quality_gam,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_rules": op5_url_rules,
    "op6_language_id": op6_language_id,
    "op7_decontaminate": op7_decontaminate,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE: dict[str, str] = {"op8_mixing": mixing.ORACLE}
