"""Language of a text by the nearest of several centroids per language.

A text is the normalised TF-IDF vector of its hashed byte runs. Document
frequencies come from all training rows; each language's centroids from spherical
k-means over a bounded sample of them. A text takes the language of the centroid
of highest cosine, and is marked as rejected where it lies farther from it than
nearly all texts that made the centroid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm import text as tx
from txrisk.llm.samples import remainder
from txrisk.llm.tables import written

GRAM, BITS = 3, 11
MAX_PER_LANGUAGE, MAX_SAMPLE = 250, 4000  # documents that centroids are made from
CENTROIDS, ROUNDS = 4, 12
REJECT_QUANTILE = 0.01
UNKNOWN = "und"

_SIZE = 1 << BITS
_FITTED = "doc_id long, lang_pred string, score double, rejected boolean"


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    reach: np.ndarray  # lowest cosine that is not rejected


def _counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts by buckets; a piece has a bounded number of texts. Letters are in lower
    case; whatever else there is of ASCII counts as one space between them."""
    n = len(offsets) - 1
    out = np.zeros(n * _SIZE, np.float32)
    between = tx.APART[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(between[1:] & between[:-1])
    places = np.append(0, np.cumsum(keep))[offsets]
    letters = np.where(between, np.uint8(32), tx.LOWER[raw])[keep]
    for bucket, whose in tx.byte_grams(letters, places, GRAM, BITS):
        one, last = (int(whose[0]), int(whose[-1])) if len(whose) else (0, -1)
        part = np.bincount((whose - one) * _SIZE + bucket, minlength=(last - one + 1) * _SIZE)
        out[one * _SIZE : (last + 1) * _SIZE] += part
    return out.reshape(n, _SIZE)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(_SIZE, np.int64), 0
    for batch, raw, offsets in tx.pieces(batches):
        total += (_counts(raw, offsets) > 0).sum(0)
        n += batch.num_rows
    bucket, count = np.append(np.arange(_SIZE), -1), np.append(total, n)
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket.astype(np.int32)), pa.array(count)], names=["bucket", "n"]
    )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw, offsets in tx.pieces(batches):
        rows = [x.tobytes() for x in _counts(raw, offsets)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"), pa.array(rows, pa.binary())],
            names=["doc_id", "lang", "counts"],
        )


def _clusters(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from rows spread over the sample; centroids and each row's.
    Rows are in order of their distance to the mean, so that starts differ."""
    order = np.argsort(x @ x.mean(0), kind="stable")
    centres = x[order[np.linspace(0, len(x) - 1, min(CENTROIDS, len(x))).astype(int)]]
    for _ in range(ROUNDS):
        nearest = np.argmax(x @ centres.T, axis=1)
        used = np.unique(nearest)
        centres = _unit(np.stack([x[nearest == k].sum(0) for k in used]))
    return centres, np.argmax(x @ centres.T, axis=1)


def fit(documents: DataFrame, usable: Column) -> Model:
    """A model from the rows where ``usable`` holds and ``lang`` is given.

    The sample takes the documents with letters of lowest hash: ``MAX_PER_LANGUAGE`` of
    each language, ``MAX_SAMPLE`` in all, every language's first before any's second;
    of more languages than that, one of each. Of an id with several texts in a language
    the one of least counts is taken. Without any row, the model has no language.
    """
    rows = documents.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & usable)
    counted = rows.select("text").mapInArrow(_frequencies, "bucket int, n long")
    by = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(by["bucket"].astype(int), by["n"].astype(int), strict=True))
    total = found.get(-1, 0)
    df = np.array([found.get(k, 0) for k in range(_SIZE)])
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    # Rows of low hash, four times as many as are needed, are ranked; ranking all of
    # a language would bring its lowest from every task to one.
    rank = F.xxhash64("doc_id")
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(rank, "doc_id"))
    # Different ids, not rows: of a few ids that come again and again none may be lost.
    sizes = rows.groupBy("lang").agg(F.count_distinct("doc_id").alias("n"))
    sizes = written(sizes, "language-sizes")
    in_all = max(MAX_SAMPLE, sizes.count())
    low = F.pmod(rank, F.lit(1 << 30)) < F.lit(float(1 << 32) * MAX_PER_LANGUAGE) / F.col("n")
    ids = rows.select("doc_id", "lang").join(sizes, "lang").filter(low).select("doc_id", "lang")
    ids = ids.distinct().withColumn("nth", nth)
    ids = ids.filter(F.col("nth") <= MAX_PER_LANGUAGE).orderBy("nth", rank, "lang").limit(in_all).drop("nth")
    texts = rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    vectors = texts.mapInArrow(_sampled, "doc_id long, lang string, counts binary")
    sample = vectors.groupBy("doc_id", "lang").agg(F.min("counts").alias("counts")).toPandas()
    sample = sample.sort_values(["lang", "doc_id"], kind="stable")

    languages, centroids, reach = [], [np.zeros((0, _SIZE), np.float32)], []
    for language, group in sample.groupby("lang"):
        x = _vectors(np.stack([np.frombuffer(b, np.float32) for b in group["counts"]]), idf)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            continue
        centres, nearest = _clusters(x)
        for k, centre in enumerate(centres):
            own = (x[nearest == k] @ centre) if (nearest == k).any() else np.zeros(1)
            languages.append(language)
            reach.append(float(np.quantile(own, REJECT_QUANTILE)))
        centroids.append(centres)
    return Model(languages, np.concatenate(centroids).astype(np.float32), idf, np.array(reach))


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected``, a row per row.

    A text that is null or has no letter is ``und`` with score 0 and rejected, as
    is every text if the model has no language. Other columns are left behind.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch, raw, offsets in tx.pieces(batches):
            spoken = batch.column("spoken").to_numpy(zero_copy_only=False).astype(bool)
            if len(m.languages):
                near = _vectors(_counts(raw, offsets), m.idf) @ m.centroids.T
                best = np.argmax(near, axis=1)
                score = np.clip(near[np.arange(len(best)), best].astype(float), 0, 1)
                far = score < m.reach[best]
            else:
                best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
                far = np.ones(batch.num_rows, bool)
            best, score = np.where(spoken, best, -1), np.where(spoken, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names[best], pa.string()),
                    pa.array(score),
                    pa.array(far | ~spoken),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("spoken")
    return documents.select("doc_id", "text", spoken).mapInArrow(nearest, _FITTED)


def held_out(modulus: int = 4, rest: int = 2) -> Column:
    """Whether a row is kept from learning; a null id is."""
    return F.coalesce(remainder("doc_id", modulus) == rest, F.lit(True))
