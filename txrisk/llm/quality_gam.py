"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins, and a lookup table over its bins is built
by boosting: cycle after cycle, each table in turn takes a small step along a
shallow tree fitted to what the others leave over. Tables over pairs of features
follow for the pairs that leave most over. A score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm import text as tx
from txrisk.llm.samples import documents_of, labelled, remainder

MAX_SAMPLE = 20_000  # labelled documents that the tables are fitted on
BINS, PAIR_BINS = 32, 8
CYCLES, PAIR_CYCLES, RATE = 120, 40, 0.1
PAIRS = 6
MIN_LEAF, SHRINK = 20, 5.0
CUT = 0.3  # score from which label 1 is predicted

FEATURES = [
    "log_words",
    "word_length",
    "symbol_share",
    "upper_share",
    "digit_share",
    "stop_share",
    "exclamation_share",
    "line_share",
    "space_share",
    "beyond_ascii_share",
    "different_words",
    "different_triples",
    "most_frequent_word",
    "bare_symbol_words",
    "byte_entropy",
    "capital_words",
]
_OUT = "doc_id long, held_out boolean, score double, predicted int"

_CLASS = np.zeros((7, 256), bool)
_CLASS[0, list(b"#*$%&|<>=_~^@\\{}[]")] = True
_CLASS[1, 65:91] = True
_CLASS[2, 48:58] = True
_CLASS[3, list(b".,;:")] = True
_CLASS[4, list(b"!?")] = True
_CLASS[5, 10] = True
_CLASS[6, 128:] = True
_LETTER = ~tx.APART


@dataclass(frozen=True)
class Model:
    base: float
    edges: list[np.ndarray]
    tables: np.ndarray  # features by bins
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: np.ndarray  # pairs by bins by bins


def _different(keys: np.ndarray, whose: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many different keys, and how often the most frequent occurs."""
    count, most = np.zeros(n), np.zeros(n)
    if len(keys):
        order = np.lexsort((keys, whose))
        keys, whose = keys[order], whose[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (whose[1:] != whose[:-1])
        at = np.flatnonzero(first)
        count = np.bincount(whose[at], minlength=n).astype(float)
        np.maximum.at(most, whose[at], np.diff(np.append(at, len(keys))).astype(float))
    return count, most


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts by ``FEATURES``; an empty text has zeros."""
    n = len(offsets) - 1
    starts, ends = tx.words(raw, offsets)
    first = np.searchsorted(starts, offsets)
    n_words = np.diff(first).astype(float)
    n_bytes = np.maximum(np.diff(offsets), 1).astype(float)
    per = [tx.per_text(x[raw], offsets) / n_bytes for x in _CLASS]
    spaces = tx.per_text(tx.SPACE[raw], offsets) / n_bytes
    found = tx.hashes(tx.LOWER[raw], starts, ends)
    whose = np.repeat(np.arange(n), np.diff(first))
    different, most = _different(found, whose, n)
    triples, triple_of = tx.shingles(found, first, 3)
    triple_kinds, _ = _different(triples, triple_of, n)
    letters = np.append(0, np.cumsum(_LETTER[raw]))
    bare = letters[ends] == letters[starts]
    capital = _CLASS[1][raw[starts]] if len(starts) else np.zeros(0, bool)
    byte_counts = np.zeros((n, 256))
    for k in range(n):
        byte_counts[k] = np.bincount(raw[offsets[k] : offsets[k + 1]], minlength=256)
    share = byte_counts / n_bytes[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    w = np.maximum(n_words, 1)
    n_triples = np.maximum(np.bincount(triple_of, minlength=n), 1)
    return np.column_stack(
        [
            np.log1p(n_words),
            tx.per_text(~tx.SPACE[raw], offsets) / w,
            per[0],
            per[1],
            per[2],
            per[3],
            per[4],
            per[5],
            spaces,
            per[6],
            different / w,
            triple_kinds / n_triples,
            most / w,
            tx.per_text(bare, first) / w,
            entropy,
            tx.per_text(capital, first) / w,
        ]
    )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw, offsets in tx.pieces(batches):
        rows = [x.tobytes() for x in features(raw, offsets)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
            names=["doc_id", "label", "features"],
        )


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, low: int, high: int):
    """Gain and place of the best cut of bins low..high; gain 0 if none."""
    if high - low < 2:
        return 0.0, low
    gs, hs, ns = np.cumsum(g[low:high]), np.cumsum(h[low:high]), np.cumsum(n[low:high])
    left, right = gs[:-1], gs[-1] - gs[:-1]
    gain = left**2 / (hs[:-1] + SHRINK) + right**2 / (hs[-1] - hs[:-1] + SHRINK)
    gain -= gs[-1] ** 2 / (hs[-1] + SHRINK)
    gain[(ns[:-1] < MIN_LEAF) | (ns[-1] - ns[:-1] < MIN_LEAF)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), low + at + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree of at most four leaves over the bins, as each bin's value."""
    gain, at = _best_cut(g, h, n, 0, len(g))
    cuts = [0, len(g)]
    if gain > 0:
        cuts.append(at)
        for low, high in ((0, at), (at, len(g))):
            gain, inner = _best_cut(g, h, n, low, high)
            if gain > 0:
                cuts.append(inner)
    cuts.sort()
    out = np.zeros(len(g))
    for low, high in zip(cuts, cuts[1:], strict=False):
        out[low:high] = g[low:high].sum() / (h[low:high].sum() + SHRINK)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """A cut of the first feature's bins and one of the second's on either side:
    its gain and each cell's value."""
    best, value = 0.0, np.zeros(g.shape)
    whole = g.sum() ** 2 / (h.sum() + SHRINK)
    for cut in range(1, len(g)):
        out, total = np.zeros(g.shape), 0.0
        for side in (slice(0, cut), slice(cut, len(g))):
            gs, hs, ns = g[side].sum(0), h[side].sum(0), n[side].sum(0)
            gain, at = _best_cut(gs, hs, ns, 0, g.shape[1])
            parts = [slice(0, at), slice(at, None)] if gain > 0 else [slice(0, None)]
            for part in parts:
                total += gs[part].sum() ** 2 / (hs[part].sum() + SHRINK)
                out[side, part] = gs[part].sum() / (hs[part].sum() + SHRINK)
        if total - whole > best:
            best, value = total - whole, out
    return best, value


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)])


def _quantiles(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def boost(x: np.ndarray, y: np.ndarray) -> Model:
    """Tables from a bounded sample of feature rows and their labels."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    edges, pair_edges = _quantiles(x, BINS), _quantiles(x, PAIR_BINS)
    b, pb = _bins(x, edges), _bins(x, pair_edges)
    tables, score = np.zeros((x.shape[1], BINS)), np.full(len(y), base)
    for _ in range(CYCLES):
        for k in range(x.shape[1]):
            p = _sigmoid(score)
            sums = [np.bincount(b[:, k], v, minlength=BINS) for v in (y - p, p * (1 - p))]
            step = RATE * _tree(*sums, np.bincount(b[:, k], minlength=BINS))
            tables[k] += step
            score += step[b[:, k]]
    cells = PAIR_BINS**2

    def over(pair: tuple[int, int]):
        p, at = _sigmoid(score), pb[:, pair[0]] * PAIR_BINS + pb[:, pair[1]]
        sums = [np.bincount(at, v, minlength=cells) for v in (y - p, p * (1 - p), np.ones(len(y)))]
        return at, _pair_tree(*[s.reshape(PAIR_BINS, PAIR_BINS) for s in sums])

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda pair: -over(pair)[1][0])
    pairs = ranked[:PAIRS]
    pair_tables = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_CYCLES):
        for k, pair in enumerate(pairs):
            at, (_, value) = over(pair)
            pair_tables[k] += RATE * value
            score += RATE * value.ravel()[at]
    return Model(base, edges, tables, pairs, pair_edges, pair_tables)


def predict(model: Model, x: np.ndarray) -> np.ndarray:
    b, pb = _bins(x, model.edges), _bins(x, model.pair_edges)
    score = np.full(len(x), model.base)
    for k, table in enumerate(model.tables):
        score += table[b[:, k]]
    for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
        score += table[pb[:, i], pb[:, j]]
    return _sigmoid(score)


def held_out(modulus: int = 5, rest: int = 0) -> Column:
    """Whether a row is kept from learning; a null id is."""
    return F.coalesce(remainder("doc_id", modulus) == rest, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_SAMPLE) -> Model | None:
    """A model from at most ``limit`` labelled documents that are not held out; None
    without any. Of an id with several texts the one of least features is learned from."""
    sample = documents_of(documents, labelled(labels, "quality", limit, ~held_out()))
    rows = sample.mapInArrow(_sampled, "doc_id long, label double, features binary")
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("features").alias("features")).toPandas().sort_values("doc_id", kind="stable")
    if not len(rows):
        return None
    x = np.stack([np.frombuffer(v, np.float64) for v in rows["features"]])
    return boost(x, rows["label"].to_numpy())


def score(documents: DataFrame, model: Model | None, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per row.

    A null or empty text is scored by its features, which are zeros. Without a
    model every score is 0.5. Other columns are left behind.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch, raw, offsets in tx.pieces(batches):
            p = np.full(batch.num_rows, 0.5) if m is None else predict(m, features(raw, offsets))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(p),
                    pa.array((p >= cut).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(scored, _OUT)
