"""Quality rules: base counts of every text, and a log-likelihood ratio.

Hashed runs of bytes are counted once over all documents (the raw corpus) and
once over the documents that labels trust (the target). A document's verdict is
the mean of log(target share / raw share) over all its runs: the likelihood ratio
of two multinomials, per run, against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import text as tx

GRAM, BITS = 4, 16  # bytes in a run, bits of its bucket: the model is 2**BITS numbers
STEPS = 1 << 27  # of a weight's unit: 2**18 weights of a block add up without rounding
SMOOTHING = 1.0  # added to every bucket's count
MIN_RATIO = -0.30  # a document scoring below is rejected
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS_DDL = "bucket int, n long"
RULES_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_runs long, score double"
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BITS, np.int64)
    for _, raw, offsets in tx.pieces(batches):
        for bucket, _ in tx.byte_grams(raw, offsets, GRAM, BITS):
            total += np.bincount(bucket, minlength=1 << BITS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"]
    )


def run_counts(documents: DataFrame) -> np.ndarray:
    """How often each bucket occurs: counted inside tasks, summed by bucket.
    Comes to the driver as at most 2**BITS rows, whatever the corpus."""
    counted = documents.select("text").mapInArrow(_count, COUNTS_DDL)
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << BITS)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    return out


def fit(documents: DataFrame, labels: DataFrame) -> np.ndarray:
    """log(target share / raw share) of each bucket, in steps of 1 / ``STEPS``, so that
    sums are exact and a text scores the same wherever it stands in a batch.

    Without trusted documents the ratio is 0 everywhere and nothing is rejected
    by it. A document with several labels is trusted if any of them trusts it.
    """
    trusted = labels.filter(F.col("quality") == 1).select("doc_id").distinct()
    raw = run_counts(documents)
    # One plan at every size: a broadcast of the ids would be swapped for this as they grow.
    texts = documents.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left_semi")
    target = run_counts(texts)
    if not target.sum():
        return np.zeros(1 << BITS)
    share = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * len(c))
    return np.rint(np.log(share(target) / share(raw)) * STEPS) / STEPS


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: words inside windows of three that occur twice or more in it."""
    counts = np.diff(first)
    if len(hashes) < 3:
        return np.zeros(len(counts), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(owner[:-2] == owner[2:])
    with np.errstate(over="ignore"):
        window = hashes[at] + tx.mix(hashes[at + 1] + tx.mix(hashes[at + 2]))
        keys = tx.mix(window ^ tx.mix(owner[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return tx.per_text(covered, first)


def _repeated_lines(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, np.int64)
    data = raw.tobytes()
    for k in range(len(out)):
        seen: set[bytes] = set()
        for line in data[offsets[k] : offsets[k + 1]].split(b"\n"):
            if line in seen:
                out[k] += bool(line.strip())
            seen.add(line)
    return out


def _judge(weights):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.rint(weights.value * STEPS)  # whole numbers: sums of a block are exact
        for batch, raw, offsets in tx.pieces(batches):
            starts, ends = tx.words(raw, offsets)
            first = np.searchsorted(starts, offsets)
            repeated = _repeated_words(tx.hashes(raw, starts, ends), first)
            n = batch.num_rows
            total, runs = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for bucket, whose in tx.byte_grams(raw, offsets, GRAM, BITS):
                total += np.bincount(whose, weights=table[bucket], minlength=n).astype(np.int64)
                runs += np.bincount(whose, minlength=n)
            chars = ((raw & 0xC0) != 0x80) & ~tx.SPACE[raw]
            columns = [
                *batch.drop_columns(["text"]).columns,
                np.diff(first),
                tx.per_text(chars, offsets),
                tx.per_text(_SYMBOL[raw], offsets),
                _repeated_lines(raw, offsets),
                repeated,
                runs,
                total / (np.maximum(runs, 1) * STEPS),
            ]
            names = [x for x in batch.schema.names if x != "text"]
            names += [x.split()[0] for x in RULES_DDL.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names
            )

    return judge


def judge(documents: DataFrame, weights: np.ndarray, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``doc_id``, the base counts, ``score`` and the verdicts, a row per row.

    ``weights`` is what :func:`fit` returns, 2**BITS numbers. A null or empty text
    has no words and fails the base rules. Repeated rows are judged alike; a null
    ``doc_id`` is carried through; other columns are left behind.
    """
    sent = documents.sparkSession.sparkContext.broadcast(weights)
    rows = documents.select("doc_id", "text").mapInArrow(_judge(sent), "doc_id long, " + RULES_DDL)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(min_ratio))
    )


def keep_good(documents: DataFrame, labels: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """The documents whose verdict is to keep, with all their columns.

    The verdict travels beside the row: nothing is joined back.
    """
    sent = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in tx.pieces(batches):
            (row,) = list(_judge(sent)(iter([batch.select(["text"])])))
            value = lambda name: row.column(name).to_numpy()
            good = value("n_words") >= MIN_WORDS
            good &= 100 * value("n_repeat_words") <= MAX_REPEATED_PERCENT * value("n_words")
            good &= value("score") >= min_ratio
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(kept, documents.schema)
