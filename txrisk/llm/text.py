"""Vectorised reading of whole texts inside tasks.

A batch of texts is one run of UTF-8 bytes and the places where texts begin.
Words are maximal runs of bytes other than space and \\t \\n \\v \\f \\r, which
are never part of a longer UTF-8 character. Everything here works on byte blocks
of bounded size, so that a very long text costs no more at once than many short
ones, apart from the arrays that are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18  # bytes hashed at once
BATCH_BYTES = 1 << 22  # bytes of texts handed on at once
BATCH_TEXTS = 1 << 9  # texts handed on at once

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Between letters: every ASCII character but A-Z and a-z.
APART = np.zeros(256, bool)
APART[:128] = [not chr(k).isalpha() for k in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

with np.errstate(over="ignore"):
    _BASE = _U(0x9E3779B97F4A7C15 | 1)
    _BACK = _U(pow(int(_BASE), -1, 1 << 64))
    _POWERS = np.cumprod(np.full(BLOCK + 1, _BASE, _U))
    _INVERSE = np.cumprod(np.full(BLOCK + 1, _BACK, _U))
    _M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
    _STEP = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def texts(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch's texts, and where each begins (one place more than
    there are texts). A null reads as an empty text."""
    column = pc.fill_null(batch.column(name).cast(pa.large_string()), "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return raw[first : int(offsets[-1]) if len(offsets) else 0], offsets - first


def pieces(
    batches: Iterator[pa.RecordBatch], name: str = "text"
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut to about ``BATCH_BYTES`` of text (one longer text at least) and
    ``BATCH_TEXTS`` texts each, with their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offsets = texts(batch, name)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + BATCH_BYTES, "right")) - 1
            to = min(max(to, at + 1), at + BATCH_TEXTS, batch.num_rows)
            low, high = int(offsets[at]), int(offsets[to])
            yield batch.slice(at, to - at), raw[low:high], offsets[at : to + 1] - low
            at = to


def words(
    raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends; no word runs over the end of its text.
    ``apart``: which bytes are between words."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~apart[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    ends = solid
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _hash_block(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: int) -> np.ndarray:
    high = int(ends[-1])
    with np.errstate(over="ignore"):
        sums = np.zeros(high - low + 1, _U)
        np.cumsum((raw[low:high].astype(_U) + _U(1)) * _POWERS[: high - low], out=sums[1:])
        return (sums[ends - low] - sums[starts - low]) * _INVERSE[starts - low]


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes; stretches are in order and disjoint."""
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(int(np.searchsorted(ends, low + BLOCK, "right")), at)
        if to == at:  # one stretch longer than a block: hash its blocks, then those
            edges = np.arange(low, int(ends[at]), BLOCK // 2)
            inner = hashes(raw, edges, np.append(edges[1:], ends[at]))
            with np.errstate(over="ignore"):
                value = _U(0)
                for x in inner:
                    value = value * _BASE + x
            out[at] = value
            at += 1
            continue
        out[at:to] = _hash_block(raw, starts[at:to], ends[at:to], low)
        at = to
    with np.errstate(over="ignore"):
        return mix(out + (ends - starts).astype(_U) * _STEP)


def shingles(word_hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words, and the number of the run's text.

    ``first``: where each text's words begin, one place more than there are
    texts. A text of fewer words than ``size`` (but some) gives one run: all of
    them.
    """
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        runs = max(len(word_hashes) - size + 1, 0)
        out = np.zeros(runs, _U)
        for k in range(size):
            out = out * _BASE + word_hashes[k : k + runs]
        out = mix(out + _U(size))
        owner = np.repeat(np.arange(len(counts)), counts)
        inside = owner[:runs] == owner[size - 1 :] if runs else np.zeros(0, bool)
        out, whose = out[inside], owner[:runs][inside]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            whole = np.zeros(len(short), _U)
            for k in range(size - 1):
                have = counts[short] > k
                nth = word_hashes[np.minimum(first[short] + k, len(word_hashes) - 1)]
                whole = np.where(have, whole * _BASE + nth, whole)
            out = np.concatenate([out, mix(whole + counts[short].astype(_U))])
            whose = np.concatenate([whose, short])
            order = np.argsort(whose, kind="stable")
            out, whose = out[order], whose[order]
    return out, whose


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-byte (or per-word) array over each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def byte_grams(raw: np.ndarray, offsets: np.ndarray, size: int, bits: int):
    """Hashed buckets of every run of ``size`` bytes within a text, and whose it is,
    block by block."""
    for low in range(0, max(len(raw) - size + 1, 0), BLOCK):
        high = min(low + BLOCK, len(raw) - size + 1)
        part = raw[low : high + size - 1].astype(np.uint32)
        value = np.zeros(high - low, np.uint32)
        for k in range(size):
            value = value * np.uint32(0x01000193) ^ part[k : k + high - low]
        value = value * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        value = (value * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
        one = int(np.searchsorted(offsets, low, "right")) - 1
        last = int(np.searchsorted(offsets, high + size - 2, "right")) - 1
        edges = np.clip(offsets[one : last + 2], low, high + size - 1)
        text = np.repeat(np.arange(one, last + 1), np.diff(edges))
        inside = text[: high - low] == text[size - 1 :]
        yield value[inside].astype(np.int64), text[: high - low][inside]
