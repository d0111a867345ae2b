"""Severity of toxic language by cumulative-link ordinal regression.

Grades: 0 for documents labelled as not toxic; toxic ones are 1, or 2 where the
share of marked words (those much more frequent among toxic documents) is at or
above the toxic documents' median. One weight per word is shared by all
thresholds: P(grade >= k) = sigmoid(weights . words - threshold k).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import text as tx
from txrisk.llm.samples import documents_of, labelled

MAX_SAMPLE = 10_000  # labelled documents that the model is fitted on
MAX_WORDS = 4096  # words with a weight
MIN_TOXIC = 4  # toxic documents a word must be in, at least
SURE, EVIDENT = 2.0, 1.0  # log odds less SURE standard errors must be EVIDENT at least
MARK = 3.0  # log odds from which a word is marked
STEPS, RATE = 400, 0.3
SPARSE = 3.0  # documents' worth of evidence below which a weight stays 0
GRADES = 3
FALSE_COST = 10.0  # how much worse marking a clean document is than missing a toxic one

_OUT = "doc_id long, expected_severity double, severity int, toxic_probability double, toxic boolean"


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray
    limit: float  # probability of grade 1 or more from which a document is toxic


def _limit(chance: np.ndarray, toxic: np.ndarray) -> float:
    """Midway between the two neighbouring probabilities of the sample where recall
    less ``FALSE_COST`` times the share of marked clean documents is highest."""
    order = np.argsort(-chance, kind="stable")
    chance, toxic = chance[order], toxic[order]
    gain = np.cumsum(toxic) / toxic.sum() - FALSE_COST * np.cumsum(~toxic) / (~toxic).sum()
    last = np.append(chance[1:] != chance[:-1], True)  # of equal ones all or none
    best = int(np.argmax(np.where(last, gain, -np.inf)))
    return float((chance[best] + (chance[best + 1] if best + 1 < len(chance) else 0)) / 2)


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different words of each text, and whose they are. Words are
    runs of ASCII letters, in lower case, and of other characters beyond ASCII."""
    low = tx.LOWER[raw]
    starts, ends = tx.words(low, offsets, tx.APART)
    found = tx.hashes(low, starts, ends)
    whose = np.searchsorted(offsets, starts, "right") - 1
    order = np.lexsort((found, whose))
    found, whose = found[order], whose[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (whose[1:] != whose[:-1])
    return found[first], whose[first]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw, offsets in tx.pieces(batches):
        found, whose = _words(raw, offsets)
        edges = np.searchsorted(whose, np.arange(batch.num_rows + 1))
        rows = [found[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
            names=["doc_id", "label", "words"],
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _regress(row: np.ndarray, word: np.ndarray, grade: np.ndarray, size: int):
    """Weights and thresholds by proximal gradient steps on the mean log-likelihood
    less an absolute-value penalty, which leaves words without evidence at 0."""
    n, upper = len(grade), GRADES - 1
    weights, gaps = np.zeros(size), np.append(1.0, np.ones(upper - 1))
    balance = np.ones(n)
    squares, gap_squares = np.full(size, 1e-8), np.full(upper, 1e-8)
    for _ in range(STEPS):
        theta = np.cumsum(np.append(gaps[0], np.exp(gaps[1:])))
        s = np.bincount(row, weights[word], minlength=n)
        above = _sigmoid(s[:, None] - theta[None, :])  # P(grade >= k)
        bound = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        here = np.maximum(bound[np.arange(n), grade] - bound[np.arange(n), grade + 1], 1e-9)
        slope = np.concatenate([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))], axis=1)
        upper_slope, lower_slope = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        by_score = balance * (upper_slope - lower_slope) / here / n
        gradient = np.bincount(word, by_score[row], minlength=size)
        by_theta = np.zeros(upper)
        np.add.at(by_theta, np.maximum(grade - 1, 0), np.where(grade > 0, -balance * upper_slope / here, 0) / n)
        np.add.at(by_theta, np.minimum(grade, upper - 1), np.where(grade < upper, balance * lower_slope / here, 0) / n)
        by_gap = np.cumsum(by_theta[::-1])[::-1] * np.append(1.0, np.exp(gaps[1:]))
        squares += gradient**2
        gap_squares += by_gap**2
        step = RATE / np.sqrt(squares)
        weights = weights + step * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * SPARSE / n, 0)
        gaps += RATE * by_gap / np.sqrt(gap_squares)
    return weights, np.cumsum(np.append(gaps[0], np.exp(gaps[1:])))


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_SAMPLE) -> Model:
    """A model from at most ``limit`` labelled documents. Without toxic and other
    documents among them, nothing is toxic. Of an id with several texts the one of least
    word hashes is learned from."""
    sample = documents_of(documents, labelled(labels, "toxic", limit))
    rows = sample.mapInArrow(_sampled, "doc_id long, label double, words binary")
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("words").alias("words")).toPandas().sort_values("doc_id", kind="stable")
    toxic = rows["label"].to_numpy() > 0
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), np.array([20.0, 21.0]), 0.5)
    if not toxic.any() or toxic.all():
        return nothing
    lists = [np.frombuffer(b, np.uint64) for b in rows["words"]]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    vocabulary, word = np.unique(np.concatenate(lists), return_inverse=True)
    within = np.bincount(word, toxic[row], minlength=len(vocabulary))
    without = np.bincount(word, minlength=len(vocabulary)) - within
    a, b = toxic.sum(), (~toxic).sum()
    odds = np.log((within + 0.5) / (a + 1)) - np.log((without + 0.5) / (b + 1))
    surely = odds - SURE * np.sqrt(1 / (within + 0.5) + 1 / (without + 0.5))
    weight = np.where((within >= MIN_TOXIC) & (surely >= EVIDENT), surely, 0)
    chosen = np.sort(np.argsort(-weight, kind="stable")[:MAX_WORDS])
    chosen = chosen[weight[chosen] > 0]
    if not len(chosen):
        return nothing
    marked = np.bincount(row, (odds > MARK)[word] & (within >= MIN_TOXIC)[word], minlength=len(lists))
    share = marked / np.maximum(np.bincount(row, minlength=len(lists)), 1)
    grade = np.where(toxic, np.where(share >= np.median(share[toxic]), 2, 1), 0)
    place = np.full(len(vocabulary), -1)
    place[chosen] = np.arange(len(chosen))
    have = place[word] >= 0
    weights, thresholds = _regress(row[have], place[word][have], grade, len(chosen))
    score = np.bincount(row[have], weights[place[word][have]], minlength=len(lists))
    used = weights != 0
    limit = _limit(_sigmoid(score - thresholds[0]), toxic)
    return Model(vocabulary[chosen][used], weights[used], thresholds, limit)


def grade(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_severity, severity, toxic_probability, toxic``, a row per
    row. A null or empty text has no word and scores as such. Repeated rows score
    alike; other columns are left behind."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch, raw, offsets in tx.pieces(batches):
            s = np.zeros(batch.num_rows)
            if len(m.words):
                found, whose = _words(raw, offsets)
                at = np.minimum(np.searchsorted(m.words, found), len(m.words) - 1)
                s = np.bincount(whose, np.where(m.words[at] == found, m.weights[at], 0), batch.num_rows)
            above = _sigmoid(s[:, None] - m.thresholds[None, :])
            toxic = above[:, 0] >= m.limit
            level = np.where(toxic, np.maximum((above >= 0.5).sum(1), 1), 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(above.sum(1)),
                    pa.array(level.astype(np.int32)),
                    pa.array(above[:, 0]),
                    pa.array(toxic),
                ],
                names=[x.split()[0] for x in _OUT.split(", ")],
            )

    return documents.select("doc_id", "text").mapInArrow(score, _OUT)
