"""URL filters: given rules of host and path, and association rules mined from labels.

The tokens of a labelled page's URL and its label make a basket. Spark's FP-growth
finds the combinations of tokens that are frequent enough and mean the label
"block" often enough; a URL is blocked if it holds all tokens of such a rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.tables import written

# --- Fixed values: verdict, host, path ---
GIVEN = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# -----------------------------------------

MIN_SUPPORT = 0.002  # share of labelled pages that hold a rule's tokens and its label
MIN_CONFIDENCE = 0.6
MAX_RULES = 5_000  # rules that tasks are sent; more are joined
BLOCK = "label=block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``; both empty for a null url or one without ``://``."""
    after = F.expr("substring(url, locate('://', url) + 3)")
    rest = F.when(F.col("url").contains("://"), after).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def given_rule(rules: list[tuple[str, str, str]] = GIVEN) -> tuple[Column, Column]:
    """Name and verdict of the longest given rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = fits & F.col("path").startswith(path)
        name = F.when(fits, host + path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """Different tokens of a URL: labels of the host, words of the path, by place."""
    host = F.transform(F.split("host", r"[.:@]"), lambda x: F.concat(F.lit("host="), x))
    path = F.transform(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda x: F.concat(F.lit("path="), x))
    found = F.array_distinct(F.concat(host, path))
    return F.filter(found, lambda x: ~x.endswith("="))


def minimal_rules(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``tokens`` of all rules that hold no other rule's: what holds one decides no page
    that the other does not. A page's labels are those of its id, and it counts as
    blocked if any gives quality 0. Without labelled pages: none.

    By size: what is left of one size is minimal, and every longer rule that holds one
    of it goes. Rules stay in tables; the driver learns their sizes only.
    """
    rated = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    rated = rated.groupBy(F.col("doc_id").alias("page_id")).agg(F.min("quality").alias("quality"))
    label = F.when(F.col("quality") == 0, F.lit(BLOCK)).otherwise("label=allow")
    basket = F.concat(tokens(), F.array(label)).alias("items")
    urls = with_parts(pages.select("page_id", "url"))
    baskets = urls.join(rated, "page_id").select(basket)
    found = FPGrowth(minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = found.associationRules.filter(F.array_contains("consequent", BLOCK))
    left = written(rules.select(F.array_sort("antecedent").alias("tokens")), "rules")
    spark, kept = pages.sparkSession, []
    while (size := left.agg(F.min(F.size("tokens"))).first()[0]) is not None:
        kept.append(written(left.filter(F.size("tokens") == size), "minimal-rules"))
        longer = left.filter(F.size("tokens") > size)
        holding = holders(longer, filed(kept[-1])).select("tokens").distinct()
        left = written(longer.join(holding, "tokens", "left_anti"), "rules")
    none = spark.createDataFrame([], "tokens array<string>")
    return reduce(DataFrame.unionByName, kept, none)


def mine(pages: DataFrame, labels: DataFrame, **limits: float) -> list[tuple[str, ...]]:
    """The rules of :func:`minimal_rules` as a list, for callers who know it to be short."""
    found = minimal_rules(pages, labels, **limits).collect()
    return sorted((tuple(r["tokens"]) for r in found), key=lambda t: (len(t), t))


def filed(rules: DataFrame) -> DataFrame:
    """Inverted index ``token, needs``: each rule under its token that fewest rules hold."""
    each = rules.select(F.col("tokens").alias("needs"), F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    rarest = F.min(F.struct("held", "token"))["token"].alias("token")
    return each.join(held, "token").groupBy("needs").agg(rarest).select("token", "needs")


def holders(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``tokens, needs`` for each list of tokens and each rule that it holds."""
    own = rows.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    near = own.join(index, "token").filter(F.size(F.array_except("needs", "tokens")) == 0)
    return near.select("tokens", "needs")


def _joined(rows: DataFrame, index: DataFrame) -> DataFrame:
    """The verdicts of :func:`judge` by a join of the URLs' tokens with the rules' rarest."""
    best = holders(rows, index).groupBy("tokens").agg(F.min(F.array_join("needs", " ")).alias("mined_rule"))
    verdict = F.coalesce("given", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow"))
    return rows.join(best, "tokens", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "mined_rule"
    )


def judge(
    pages: DataFrame,
    mined: DataFrame | list[tuple[str, ...]],
    given: list[tuple[str, str, str]] = GIVEN,
    max_sent: int = MAX_RULES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule``, a row per row.

    ``mined`` are the rules of :func:`minimal_rules` or :func:`mine`. A given rule decides
    where one fits. Otherwise a mined rule blocks, and what
    none fits is allowed, such as a null url. Repeated rows are judged alike; null
    ids are carried through; other columns are left behind. Tasks are sent up to
    ``max_sent`` rules; more are joined.
    """
    name, verdict = given_rule(given)
    rows = with_parts(pages.select("page_id", "url")).select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("given"), tokens().alias("tokens")
    )

    spark = pages.sparkSession
    if isinstance(mined, list):
        mined = spark.createDataFrame([(list(rule),) for rule in mined], "tokens array<string>")
    rules = written(filed(mined), "filed-rules")
    if rules.count() > max_sent:
        return _joined(rows, rules)
    by_token: dict[str, list[frozenset[str]]] = {}
    for token, needs in rules.collect():
        by_token.setdefault(token, []).append(frozenset(needs))
    sent = spark.sparkContext.broadcast(by_token)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            hit, out = [], []
            for own, given in zip(
                batch.column("tokens").to_pylist(), batch.column("given").to_pylist(), strict=True
            ):
                have = set(own or ())
                fitting = [r for t in have for r in index.get(t, ()) if r <= have]
                best = min((" ".join(sorted(r)) for r in fitting), default=None)
                hit.append(best)
                out.append(given or ("block" if best else "allow"))
            columns = [batch.column(c) for c in ("page_id", "host", "path", "rule")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(out, pa.string()), pa.array(hit, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict", "mined_rule"],
            )

    return rows.mapInArrow(
        match,
        "page_id long, host string, path string, rule string, verdict string, mined_rule string",
    )
