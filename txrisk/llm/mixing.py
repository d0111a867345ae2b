"""Mixing sources to target weights: a splitting tree over blocks of documents.

Each source's documents fall into ``BLOCKS`` blocks by hash. A source's target
gives the exact quota of words to take: whole passes, then blocks in permuted
order, then documents of the one block in which the quota ends. The blocks taken
are dealt to output shards down a tree: half of a node's blocks, those of lowest
seeded hash, go left, so that the counts by source in either half are a
multivariate hypergeometric draw from the node's counts.

DataFrame functions only. What is ranked at a tree's node are blocks, at most
``BLOCKS`` times three for each source, never documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from txrisk.llm.tables import spare_name, written

# --- Fixed values of the mix ---
WEIGHTS = (3, 1, 2)  # of sources in order, repeating
SHARE = 1.5  # of all words
MOST = 2  # times its source's size, a target's limit
# -------------------------------
DEPTH = 4  # of the tree: 2**DEPTH shards
BLOCK_DIGITS = 2  # hexadecimal: 16**BLOCK_DIGITS blocks of each source

_BETWEEN = "[\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of a text, split at space and \\t \\n \\v \\f \\r; 0 for null."""
    inner = F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(inner) > 0, F.size(F.split(inner, _BETWEEN))).otherwise(0).cast("long")


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def _rank() -> Column:
    """Digest of a document's id and text: its place in its source's order."""
    content = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit("\n"),
        F.coalesce(F.col("text"), F.lit("")),
    )
    return F.md5(content.cast("binary"))


def _measured(documents: DataFrame) -> DataFrame:
    """Each document's size and place in its source's order; texts go no further."""
    return documents.select(
        "doc_id", "source", word_count().alias("size"), _rank().alias("rank")
    ).withColumns(
        {"source_key": _source_key(), "block": F.substring("rank", 1, BLOCK_DIGITS)}
    )


def targets(blocks: DataFrame) -> DataFrame:
    """``source_key, source_size, target`` by filling up: sources reach their limit
    in order of limit / weight, and the rest share the remainder by weight."""
    sources = blocks.groupBy("source_key", "source").agg(F.sum("words").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    nth = F.row_number().over(in_order) - 1
    rated = sources.withColumn("weight", weights[nth % len(WEIGHTS)]).withColumn(
        "most", F.lit(float(MOST)) * F.col("source_size")
    )
    rated = rated.withColumn("ratio", F.col("most") / F.col("weight"))
    filling = everything.orderBy("ratio", F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(SHARE) * F.sum("source_size").over(everything)
    filled = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = (total - filled) / F.sum("weight").over(after)
    levels = rated.withColumn("level", level).withColumn("at", F.row_number().over(filling))
    holds = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    # Of the levels that hold, the one of the first source counts.
    first = F.min_by(holds, F.when(holds.isNotNull(), F.col("at"))).over(everything)
    return levels.withColumn("level", first).select(
        "source_key",
        "source_size",
        F.least("most", F.col("level") * F.col("weight")).alias("target"),
    )


def _halved(nodes: DataFrame) -> DataFrame:
    """Each node's blocks ranked by ``draw``, the lower half to the left child.

    A node may hold all blocks of very many sources. So they are counted by the
    draw's first digits (256 rows a node), and ranked within those. ``nodes`` is
    used twice: give a written table.
    """
    digits = F.substring("draw", 1, 2)
    placed = nodes.withColumn("digits", digits)
    counts = placed.groupBy("shard", "digits").agg(F.count(F.lit(1)).alias("n"))
    node = Window.partitionBy("shard")
    before = node.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("n").over(before), F.lit(0))
    counts = counts.select("shard", "digits", lower.alias("lower"), F.sum("n").over(node).alias("all"))
    order = Window.partitionBy("shard", "digits").orderBy("draw", "source_key", "block", "copy")
    placed = placed.withColumn("at", F.row_number().over(order)).join(counts, ["shard", "digits"])
    right = F.col("lower") + F.col("at") > F.expr("`all` DIV 2")
    child = 2 * F.col("shard") + F.when(right, 1).otherwise(0)
    return placed.withColumn("shard", child).select(*nodes.columns)


def _dealt(plan: DataFrame) -> DataFrame:
    """The shard of every copy of a block that is taken: ``shards`` in order of copies."""
    copies = F.sequence(F.lit(0), F.col("passes") + F.when(F.col("need") > 0, 1).otherwise(0) - 1)
    taken = plan.filter((F.col("passes") > 0) | (F.col("need") > 0))
    nodes = taken.select("source_key", "block", F.explode(copies).alias("copy")).withColumn(
        "shard", F.lit(0)
    )
    name = F.concat_ws(":", F.col("copy").cast("string"), "block", "source_key")
    for level in range(DEPTH):
        draw = F.md5(F.concat(F.lit(f"tree{level}:"), name).cast("binary"))
        nodes = _halved(written(nodes.withColumn("draw", draw), "nodes")).drop("draw")
    pair = F.array_sort(F.collect_list(F.struct("copy", "shard")))
    return nodes.groupBy("source_key", "block").agg(
        F.transform(pair, lambda x: x["shard"]).alias("shards")
    )


def plan_blocks(measured: DataFrame) -> DataFrame:
    """For each block of each source: whole passes over it, how many words it gives
    besides (``need``, at most its own), and the shards of its copies."""
    blocks = measured.groupBy("source_key", "block", F.col("source")).agg(
        F.sum("size").alias("words")
    )
    share = targets(blocks)
    passes = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    planned = blocks.join(share, "source_key").withColumn("passes", passes.cast("int"))
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    draw = F.md5(F.concat_ws(":", F.lit("block"), "block", "source_key").cast("binary"))
    order = Window.partitionBy("source_key").orderBy(draw, "block")
    earlier = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    need = F.least(F.col("words").cast("double"), rest - F.coalesce(earlier, F.lit(0)))
    planned = planned.withColumn("need", F.greatest(need, F.lit(0.0))).drop("source")
    planned = written(planned, "quotas")
    return planned.join(_dealt(planned), ["source_key", "block"], "left")


def _drawn(documents: DataFrame) -> DataFrame:
    """Each document's ``source_key`` and ``rank``, and the columns of :func:`mix`,
    ``shards`` as a list."""
    measured = written(_measured(documents), "sizes")
    rows = measured.join(plan_blocks(measured), ["source_key", "block"])
    order = Window.partitionBy("source_key", "block").orderBy("rank", "doc_id")
    earlier = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("earlier", F.coalesce(earlier, F.lit(0)))
    # The document in which the quota ends is taken if that brings the sum nearer.
    nearer = 2 * (F.col("need") - F.col("earlier")) > F.col("size")
    more = (F.col("earlier") < F.col("need")) & nearer
    copies = F.col("passes") + F.when(more, 1).otherwise(0)
    return rows.withColumn("copies", copies).select(
        "source_key",
        "rank",
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        F.slice("shards", F.lit(1), F.col("copies")).alias("shards"),
    )


def mix(documents: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, shards``, a row per row.

    ``taken`` is ``copies`` times ``size``, with at most two copies; ``shards``
    names the shard of each copy, comma-separated. Sources go by code point, null
    last, and a null source is a source. Null ids and texts count like any others;
    equal rows are interchangeable. Reruns agree, whatever the partitions. Other
    columns are left behind.
    """
    shards = F.concat_ws(",", F.col("shards").cast("array<string>")).alias("shards")
    given = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    return _drawn(documents).select(*given, shards)


def write_shards(documents: DataFrame, path: str) -> None:
    """Write the mix, a folder per shard, every document as often as it is taken and
    in a seeded order within each file.

    All columns are kept; of rows alike in id, text and source, any stands for all.
    Rows without id are written, too. The folders' column is ``shard``, with ``_``
    added while documents have a column of that name.
    """
    key = ["source_key", "rank"]
    drawn = _drawn(documents).filter("copies > 0").select(*key, F.explode("shards").alias("shard"))
    drawn = drawn.groupBy(*key, "shard").agg(F.count(F.lit(1)).alias("n"))
    row = F.struct(*[documents[c] for c in documents.columns])
    rows = documents.select(_source_key().alias("source_key"), _rank().alias("rank"), row.alias("row"))
    one = rows.groupBy(*key).agg(F.first("row").alias("row"))
    copies = F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")
    taken = one.join(drawn.hint("merge"), key).select("row", *key, "shard", copies)
    draw = F.md5(F.concat_ws(":", "shard", "copy", *key).cast("binary"))
    parts = taken.withColumn("draw", draw).repartition("shard", F.substring("draw", 1, 2))
    parts = parts.sortWithinPartitions("shard", "draw")
    name = spare_name("shard", documents.columns)
    named = parts.select("row.*", F.col("shard").alias(name))
    named.write.partitionBy(name).parquet(path)


def shards(documents: DataFrame, path: str) -> DataFrame:
    """The mix itself, written by :func:`write_shards` and read again: the columns of
    ``documents`` and the shard, a row for each time that a document is taken. Of an
    empty table, or one without words, no rows."""
    write_shards(documents, path)
    name = spare_name("shard", documents.columns)
    schema = StructType([*documents.schema.fields, StructField(name, IntegerType())])
    return documents.sparkSession.read.schema(schema).parquet(path)


def _tree_sql() -> str:
    """The tree as DuckDB SQL, a CTE per level."""
    out = []
    for level in range(DEPTH):
        draw = f"md5('tree{level}:' || copy || ':' || block || ':' || source_key)"
        out.append(f"""
level{level + 1} AS (
  SELECT source_key, block, copy,
    2 * shard + CASE WHEN row_number() OVER (
        PARTITION BY shard ORDER BY {draw}, source_key, block, copy
      ) > count(*) OVER (PARTITION BY shard) // 2 THEN 1 ELSE 0 END AS shard
  FROM level{level})""")
    return ",".join(out)


ORACLE = f"""
WITH measured AS (
  SELECT *, substr(rank, 1, {BLOCK_DIGITS}) AS block FROM (
    SELECT doc_id, source, coalesce('s' || source, 'n') AS source_key,
      CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
      md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')) AS rank
    FROM documents)),
blocks AS (
  SELECT source_key, source, block, CAST(sum(size) AS BIGINT) AS words
  FROM measured GROUP BY ALL),
sources AS (
  SELECT source_key, source, CAST(sum(words) AS BIGINT) AS source_size
  FROM blocks GROUP BY ALL),
rated AS (
  SELECT *, {MOST}.0::DOUBLE * source_size AS most,
    [{", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)}][
      (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM sources),
levels AS (
  SELECT *, most / weight AS ratio,
    row_number() OVER filling AS place,
    ({SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(most) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM rated WINDOW filling AS (ORDER BY most / weight, source NULLS LAST)),
share AS (
  SELECT source_key, source_size,
    least(most, weight * (SELECT arg_min(level, place) FROM levels WHERE level <= ratio)) AS target
  FROM levels),
planned AS (
  SELECT *, greatest(0.0, least(words::DOUBLE, target - passes * source_size - coalesce(
    sum(words) OVER (PARTITION BY source_key
      ORDER BY md5('block:' || block || ':' || source_key), block
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)) AS need
  FROM (
    SELECT b.source_key, b.block, b.words, s.source_size, s.target,
      CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS INTEGER) ELSE 0 END
        AS passes
    FROM blocks b JOIN share s USING (source_key))),
level0 AS (
  SELECT source_key, block, unnest(range(passes + CASE WHEN need > 0 THEN 1 ELSE 0 END)) AS copy,
    0 AS shard
  FROM planned),{_tree_sql()},
dealt AS (
  SELECT source_key, block, list(shard ORDER BY copy) AS shards
  FROM level{DEPTH} GROUP BY ALL),
counted AS (
  SELECT m.doc_id, m.size, p.source_size, p.target, d.shards, p.passes
    + CASE WHEN earlier < need AND 2 * (need - earlier) > size THEN 1 ELSE 0 END AS copies
  FROM (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source_key, block ORDER BY rank, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS earlier
    FROM measured) m
  JOIN planned p USING (source_key, block)
  LEFT JOIN dealt d USING (source_key, block))
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken,
  CAST(copies AS INTEGER) AS copies,
  array_to_string(coalesce(shards[1:copies], []), ',') AS shards
FROM counted
"""
