"""Removal of byte strings that occur earlier in the corpus.

A byte goes if a ``LENGTH``-byte string that covers it also starts earlier. The
search takes from a difference-cover suffix sort that positions are sampled, named, and
compared in order of names; it is a sampled one, and puts no suffixes in order:

* Sampled positions: every ``LENGTH``-byte string has one sampled position inside
  it, and equal strings have it at the same place. (A difference cover modulo 73
  gives this with 12 % of all positions; taking the smallest hash of ``GRAM``-byte
  strings in reach gives it with 3 %.) The ``GRAM`` bytes there are its first name.
* Names are drawn wider: the stretch of all strings that share a sampled position
  gets a second name. Sorted by both names, equal stretches are adjacent, and all
  but the earliest are repeats as a whole.
* Remaining suffixes: where stretches with one first name differ, their strings are
  taken in blocks of ``BLOCK`` neighbours, cut at the same places in equal strings. A
  block is named by the bytes that all its strings share, its core, and carries the few
  bytes around it: strings of two blocks are equal if the cores are and the bytes that
  each string has of either side. Blocks sorted by core are compared string by string.
* A core with many different surroundings (the end of a passage that a third of all
  documents hold) would bring all of them to one reducer. A task that holds more than
  ``HOT`` sends each of their strings by its own name instead, and a mark that makes
  the core's reducer do the same with those that other tasks sent it.

Names are hashes of the bytes named. Before a sort each task keeps the earliest of
equal names only, so that a passage in a third of all documents reaches its reducer
once per task, and a core's reducer gets at most ``HOT`` rows of a task's batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import text as tx
from txrisk.llm.tables import free_shuffles, packed, spare_name, unpacked, written

LENGTH = 100  # bytes of a string that counts
GRAM = 32  # bytes hashed at a position
STEP = 1 << 17  # string starts looked at together
HELD = 1 << 20  # names that a task compares before it passes them on
BLOCK = 8  # neighbouring strings named together
CORE = LENGTH - BLOCK + 1  # bytes that these share
HOT = 64  # surroundings of one core that a task passes on as blocks

_U = np.uint64
_REACH = LENGTH - GRAM + 1
_WITHIN = _U((1 << 18) - 1)  # low bits for a place within a step
with np.errstate(over="ignore"):
    _BASES = [_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)]
    _POWERS = [np.cumprod(np.full(STEP + LENGTH + 1, b, _U)) for b in _BASES]
    _BACK = [
        np.cumprod(np.full(STEP + LENGTH + 1, _U(pow(int(b), -1, 1 << 64)), _U)) for b in _BASES
    ]
_SPAN = np.int64((1 << 7) - 1)
_PLACE = 7  # bits of the span, above which a wide name holds where the sampled position is
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(BLOCK)], np.int64)  # the lowest k bytes
_FIRST, _LAST = 56, 59  # bits above the bytes to the left: the block's first and last string

SINGLE, REPEAT, OPEN, SEVERAL, STRING, MANY = 0, 1, 2, 3, 4, 5
NAMES_DDL = "name long, wide long, doc_id long, low long, kind int"
FOUND_DDL = "doc_id long, low long, high long, open boolean, place long"
BLOCKS_DDL = "name long, wide long, doc_id long, low long, left long, right long, kind int"


def _sums(part: np.ndarray, which: int) -> np.ndarray:
    sums = np.zeros(len(part) + 1, _U)
    np.cumsum((part.astype(_U) + _U(1)) * _POWERS[which][: len(part)], out=sums[1:])
    return sums


def _stretches(raw: np.ndarray, offsets: np.ndarray):
    """Text number, first and last string start, first and second name of each
    stretch of strings that share a sampled position; starts count within the text.
    And how far behind its first start the sampled position is."""
    for base in range(0, max(len(raw) - LENGTH + 1, 0), STEP):
        part = raw[base : base + STEP + LENGTH - 1]
        one = int(np.searchsorted(offsets, base, "right")) - 1
        last = int(np.searchsorted(offsets, base + len(part) - 1, "right")) - 1
        edges = np.clip(offsets[one : last + 2], base, base + len(part))
        text = np.repeat(np.arange(one, last + 1), np.diff(edges))
        with np.errstate(over="ignore"):
            sums = _sums(part, 0)
            grams = tx.mix((sums[GRAM:] - sums[:-GRAM]) * _BACK[0][: len(sums) - GRAM])
            least, size = (grams & ~_WITHIN) | np.arange(len(grams), dtype=_U), 1
            while 2 * size <= _REACH:
                least, size = np.minimum(least[:-size], least[size:]), 2 * size
            if size < _REACH:
                least = np.minimum(least[: -(_REACH - size)], least[_REACH - size :])
            place = (least & _WITHIN).astype(np.int64)
            n = len(place)
            whole = text[:n] == text[LENGTH - 1 : LENGTH - 1 + n]
            new = np.ones(n, bool)
            new[1:] = (place[1:] != place[:-1]) | (text[1:n] != text[: n - 1]) | ~whole[:-1]
            low = np.flatnonzero(new & whole)
            if not len(low):
                continue
            ends = np.append(np.flatnonzero(new | ~whole), n)
            high = ends[np.searchsorted(ends, low, "right")] - 1
            wide = (sums[high + LENGTH] - sums[low]) * _BACK[0][low]
            wide = tx.mix(wide + tx.mix(place[low].astype(_U) - low.astype(_U) + _U(7)))
            name = tx.mix(grams[place[low]])
        whose = text[low]
        start = base + low - offsets[whose]
        yield whose, start, high - low, name.view(np.int64), wide.view(np.int64), place[low] - low


def _first_of_equal(keys: list[np.ndarray], doc: np.ndarray, low: np.ndarray):
    """Order by keys and position; in it: where a group of equal keys starts, and
    whether a row is later than its group's first position."""
    order = np.lexsort((low, doc, *keys[::-1]))
    start = np.ones(len(order), bool)
    start[1:] = False
    for k in keys:
        s = k[order]
        start[1:] |= s[1:] != s[:-1]
    group = np.cumsum(start) - 1
    head = np.flatnonzero(start)[group]
    d, p = doc[order], low[order]
    return order, start, group, (d != d[head]) | (p != p[head])


def _merged(doc: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Overlapping or touching ranges of one document as one."""
    if not len(doc):
        return doc, low, high
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    _, number = np.unique(doc, return_inverse=True)
    shift = number * (int(high.max()) + 2)  # so that one running maximum serves all
    reach = np.maximum.accumulate(high + shift)
    new = np.ones(len(doc), bool)
    new[1:] = low[1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], low[at], (np.append(reach[at[1:] - 1], reach[-1]) - shift[at])


def _batch(ddl: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [x.split() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _spread(doc: np.ndarray, low: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tx.mix(doc.astype(_U) * _U(31) + low.astype(_U)).view(np.int64)


def _by_place(ddl: str, parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Rows in order of document and place, not of names, which are all different: so the
    two columns are much alike from row to row, and the shuffle's files small."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.lexsort((columns[3], columns[2]))
    return _batch(ddl, [c[order] for c in columns])


def _passed_on(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    doc, low, span, name, wide, ahead = (np.concatenate(x) for x in zip(*held, strict=True))
    wide = (wide >> 2 * _PLACE << 2 * _PLACE) | ahead << _PLACE | span
    order, start, group, later = _first_of_equal([name, wide], doc, low)
    doc, low, span, name, wide, ahead = (x[order] for x in (doc, low, span, name, wide, ahead))
    # Names whose stretches differ here already.
    first_name = np.ones(len(name), bool)
    first_name[1:] = name[1:] != name[:-1]
    of_name = np.cumsum(first_name) - 1
    several = (np.bincount(of_name, start) > 1)[of_name]
    again = np.zeros(len(name), bool)  # the same position once more: repeated rows
    again[1:] = ~start[1:] & ~later[1:]
    single, open_ = ~later & ~several & ~again, ~later & several & ~again
    d, a, b = _merged(doc[later], low[later], low[later] + span[later] + LENGTH)
    marker = first_name & several
    zeros = lambda x, kind: np.full(int(x if isinstance(x, int) else x.sum()), kind, np.int64)
    ends = (low + span) << _PLACE | ahead
    rows = [
        [name[single], wide[single], doc[single], low[single], zeros(single, SINGLE)],
        [_spread(d, a), b, d, a, zeros(len(d), REPEAT)],
        [_spread(doc[open_], low[open_]), ends[open_], doc[open_], low[open_], zeros(open_, OPEN)],
        [name[marker], zeros(marker, 0), doc[marker], low[marker], zeros(marker, SEVERAL)],
    ]
    return _by_place(NAMES_DDL, rows)


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0
    for batch, raw, offsets in tx.pieces(batches):
        ids = batch.column("doc_id").to_numpy()
        for whose, low, span, name, wide, ahead in _stretches(raw, offsets):
            held.append([ids[whose], low, span, name, wide, ahead])
            count += len(low)
        if count >= HELD:
            yield _passed_on(held)
            held, count = [], 0
    if held:
        yield _passed_on(held)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Sorted batches as arrays that end where a run of the first column ends."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = [batch.column(c).to_numpy() for c in names]
        if rest is not None:
            block = [np.concatenate(x) for x in zip(rest, block, strict=True)]
        cut = int(np.searchsorted(block[0], block[0][-1], "left"))
        rest = [x[cut:] for x in block]
        if cut:
            yield [x[:cut] for x in block]
    if rest is not None:
        yield rest


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by name, wide name and position: repeats, and open stretches."""
    for name, wide, doc, low, kind in _runs(batches, ["name", "wide", "doc_id", "low", "kind"]):
        repeat, open_ = kind == REPEAT, kind == OPEN
        plain = kind == SINGLE
        n, w, d, p = (x[plain] for x in (name, wide, doc, low))
        _, of_name = np.unique(np.concatenate([n, name[kind == SEVERAL]]), return_inverse=True)
        order, start, _, later = _first_of_equal([n, w], d, p)
        size = int(of_name.max()) + 1 if len(of_name) else 0
        several = np.bincount(of_name[: len(n)][order], start, minlength=size) > 1
        several[of_name[len(n) :]] = True
        w, d, p, mixed = w[order], d[order], p[order], several[of_name[: len(n)][order]]
        span = w & _SPAN
        place = p + (w >> _PLACE & _SPAN)
        rest = mixed & ~later
        none = lambda rows: np.zeros(rows.sum(), np.int64)
        columns = [
            [d[later], p[later], p[later] + span[later] + LENGTH, none(later) > 0, none(later)],
            [doc[repeat], low[repeat], wide[repeat], none(repeat) > 0, none(repeat)],
            [d[rest], p[rest], p[rest] + span[rest], none(rest) == 0, place[rest]],
            [doc[open_], low[open_], wide[open_] >> _PLACE, none(open_) == 0, low[open_] + (wide[open_] & _SPAN)],
        ]
        yield _batch(FOUND_DDL, [np.concatenate(x) for x in zip(*columns, strict=True)])


def _pairs(column: pa.Array, k: int, fields: int = 2) -> tuple[np.ndarray, ...]:
    """The low and high values of a row's list of ranges (and its further fields)."""
    if not column[k].is_valid:
        return (np.zeros(0, np.int64),) * fields
    values = column[k].values
    return tuple(values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(fields))


def _cut(low: np.ndarray, high: np.ndarray, place: np.ndarray):
    """Stretches in blocks: where each core starts, and its first and last string, of
    which string ``j`` starts ``j`` bytes ahead of the core."""
    near, far = place - high, place - low  # from a string's start to the sampled position
    number = far // BLOCK - near // BLOCK + 1
    of = np.repeat(np.arange(len(low)), number)
    k = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number) + near[of] // BLOCK
    first = np.maximum(near[of] - BLOCK * k, 0)
    last = np.minimum(far[of] - BLOCK * k, BLOCK - 1)
    return place[of] - BLOCK * k, first, last


def _around(raw: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray):
    """The bytes that a block's strings have to the left of the core, nearest lowest, with
    the block's bounds above them; and to the right."""
    side = np.zeros(BLOCK - 1, np.uint8)
    padded = np.concatenate([side, raw, side])
    left, right = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for i in range(BLOCK - 1):
        left |= padded[at + BLOCK - 2 - i].astype(np.int64) << 8 * i
        right |= padded[at + CORE + BLOCK - 1 + i].astype(np.int64) << 8 * i
    return left & _BYTES[last] | first << _FIRST | last << _LAST, right & _BYTES[BLOCK - 1 - first]


def _bounds(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return left >> _FIRST & BLOCK - 1, left >> _LAST & BLOCK - 1


def _open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of the open stretches, by blocks."""
    held, count = [], 0
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        packed, sizes = batch.column("packed"), batch.column("size").to_numpy()
        for k in range(batch.num_rows):
            raw = unpacked(packed[k].as_py(), int(sizes[k]))
            low, high, place = _pairs(batch.column("ranges"), k, 3)
            high = np.minimum(high, len(raw) - LENGTH)  # another text of this id may be longer
            low, high, place = (x[low <= high] for x in (low, high, place))
            at, first, last = _cut(low, high, place)
            order = np.argsort(at, kind="stable")
            at, first, last = at[order], first[order], last[order]
            left, right = _around(raw, at, first, last)
            edges = np.searchsorted(at, np.arange(0, len(raw) + STEP, STEP))
            for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if a == b:
                    continue
                part, here = raw[n * STEP : n * STEP + STEP + LENGTH - 1], at[a:b] - n * STEP
                with np.errstate(over="ignore"):
                    named = []
                    for which in range(2):
                        sums = _sums(part, which)
                        named.append(tx.mix((sums[here + CORE] - sums[here]) * _BACK[which][here]))
                wide = (named[1] >> _U(32)).view(np.int64)
                name = named[0].view(np.int64)
                held.append([name, wide, np.full(b - a, ids[k]), at[a:b], left[a:b], right[a:b]])
                count += b - a
            if count >= HELD:
                yield _blocks_passed_on(held)
                held, count = [], 0
    if held:
        yield _blocks_passed_on(held)


def _strings_of(block: list[np.ndarray]) -> list[np.ndarray]:
    """Every string of blocks: its name and wide name, document and start."""
    name, wide, doc, at, left, right = block
    first, last = _bounds(left)
    out = []
    for j in range(BLOCK):
        has = (first <= j) & (j <= last)
        sides = [(left[has] & _BYTES[j]).view(_U), (right[has] & _BYTES[BLOCK - 1 - j]).view(_U)]
        with np.errstate(over="ignore"):
            one, two = tx.mix(sides[0] + _U((j + 1) << 56)), tx.mix(sides[1] * _BASES[0] + _U(1))
            whole = tx.mix(name[has].view(_U) + one + tx.mix(two))
            other = tx.mix(wide[has].view(_U) * _BASES[1] + two + tx.mix(one)) >> _U(32)
        out.append([whole.view(np.int64), other.view(np.int64), doc[has], at[has] - j])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _blocks_passed_on(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    block = [np.concatenate(x) for x in zip(*held, strict=True)]
    name, wide, doc, at, left, right = block
    order, start, _, later = _first_of_equal([name, wide, left, right], doc, at)
    block = [x[order] for x in block]
    _, _, doc, at, left, _ = (x[later] for x in block)
    first, last = _bounds(left)
    repeats = [[doc, at - last, at - first + LENGTH]]
    block = [x[start] for x in block]
    name, wide = block[:2]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (wide[1:] != wide[:-1])
    group = np.cumsum(new) - 1
    many = (np.bincount(group) > HOT)[group] if len(group) else new
    string = _strings_of([x[many] for x in block])
    order, start, _, later = _first_of_equal(string[:2], *string[2:])
    string = [x[order] for x in string]
    repeats.append([string[2][later], string[3][later], string[3][later] + LENGTH])
    string = [x[start] for x in string]
    d, a, b = _merged(*[np.concatenate(x) for x in zip(*repeats, strict=True)])
    none = lambda like: np.zeros(len(like), np.int64)
    mark = new & many
    columns = [
        [*[x[~many] for x in block], np.full((~many).sum(), SINGLE)],
        [_spread(d, a), b, d, a, none(d), none(d), np.full(len(d), REPEAT)],
        [*string, none(string[0]), none(string[0]), np.full(len(string[0]), STRING)],
        [*[x[mark] for x in block], np.full(mark.sum(), MANY)],
    ]
    return _by_place(BLOCKS_DDL, columns)


COMPARED_DDL = "name long, wide long, doc_id long, low long, high long, kind int"


def _blocks_compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks sorted by core: repeated strings, and the strings of cores that some
    task found with many surroundings."""
    for *block, kind in _runs(batches, [x.split()[0] for x in BLOCKS_DDL.split(", ")]):
        found = [[x[kind == REPEAT] for x in (block[2], block[3], block[1])]]
        string = [[x[kind == STRING] for x in block[:4]]]
        order = np.lexsort((block[1], block[0]))
        block, kind = [x[order] for x in block], kind[order]
        new = np.ones(len(kind), bool)
        new[1:] = (block[0][1:] != block[0][:-1]) | (block[1][1:] != block[1][:-1])
        group = np.cumsum(new) - 1
        plain = kind == SINGLE
        many = (np.bincount(group, kind == MANY) > 0)[group] & plain
        string.append(_strings_of([x[many] for x in block]))
        several = (np.bincount(group, plain) > 1)[group] & plain & ~many  # a core alone has no equal
        core, (_, _, doc, at, left, right) = group[several], (x[several] for x in block)
        first, last = _bounds(left)
        for j in range(BLOCK):
            has = (first <= j) & (j <= last)
            sides = [left[has] & _BYTES[j], right[has] & _BYTES[BLOCK - 1 - j]]
            order, _, _, later = _first_of_equal([core[has], *sides], doc[has], at[has])
            d, p = doc[has][order][later], at[has][order][later] - j
            found.append([d, p, p + LENGTH])
        d, a, b = _merged(*[np.concatenate(x) for x in zip(*found, strict=True)])
        name, wide, doc, start = (np.concatenate(x) for x in zip(*string, strict=True))
        none = np.zeros(len(d), np.int64)
        columns = [
            [none, none, d, a, b, np.full(len(d), REPEAT)],
            [name, wide, doc, start, start + LENGTH, np.full(len(name), STRING)],
        ]
        yield _batch(COMPARED_DDL, [np.concatenate(x) for x in zip(*columns, strict=True)])


def _strings_compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, wide, doc, low in _runs(batches, ["name", "wide", "doc_id", "low"]):
        order, _, _, later = _first_of_equal([name, wide], doc, low)
        d, p = doc[order][later], low[order][later]
        d, a, b = _merged(d, p, p + LENGTH)
        yield _batch("doc_id long, low long, high long", [d, a, b])


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("name").sortWithinPartitions("name", "wide", "doc_id", "low")


def _ranges(found: DataFrame) -> DataFrame:
    """A row per document: its ranges, of which there are no more than it has bytes."""
    fields = [c for c in ("low", "high", "place") if c in found.columns]
    return found.groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("ranges"))


def find(documents: DataFrame) -> DataFrame:
    """``doc_id, ranges`` of bytes to remove (low and high, overlapping ones too)."""
    texts = documents.filter("doc_id IS NOT NULL").select("doc_id", "text")
    named = texts.mapInArrow(_names, NAMES_DDL)
    found = written(_sorted(named).mapInArrow(_compared, FOUND_DDL), "suffix-found")
    free_shuffles(found)
    open_ = _ranges(found.filter("open"))
    blocks = packed(texts).join(open_.hint("merge"), "doc_id").mapInArrow(_open_blocks, BLOCKS_DDL)
    compared = written(_sorted(blocks).mapInArrow(_blocks_compared, COMPARED_DDL), "suffix-blocks")
    free_shuffles(compared)
    ranges = ["doc_id", "low", "high"]
    strings = compared.filter(F.col("kind") == STRING).drop("high", "kind")
    more = _sorted(strings).mapInArrow(_strings_compared, "doc_id long, low long, high long")
    closed = found.filter("NOT open").select(ranges)
    return _ranges(closed.unionByName(compared.filter(F.col("kind") == REPEAT).select(ranges)).unionByName(more))


def _left(raw: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[bytes, int, int]:
    """What remains, how many bytes go, and in how many runs."""
    if not len(low):
        return raw.tobytes(), 0, 0
    low, high = np.minimum(low, len(raw)), np.minimum(high, len(raw))
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, low, 1)
    np.add.at(edge, high, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return raw[~gone].tobytes(), int(gone.sum()), runs


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, runs, digests = batch.column("size").to_numpy(), [], [], []
        for k in range(batch.num_rows):
            raw = unpacked(batch.column("packed")[k].as_py(), int(sizes[k]))
            left, gone, n = _left(raw, *_pairs(batch.column("ranges"), k))
            removed.append(gone)
            runs.append(n)
            digests.append(hashlib.sha256(left).hexdigest())
        columns = [batch.column("doc_id"), batch.column("size")]
        columns += [pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests)]
        yield pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def judge(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, a row per row.

    A null text is empty. A row without id is compared with nothing and keeps all
    its bytes. Rows alike in id and text are one document; if they differ in text,
    the ranges found in any are removed from each, as far as it reaches. Other
    columns are left behind.
    """
    rows = packed(documents).join(find(documents).hint("merge"), "doc_id", "left")
    return rows.mapInArrow(
        _judged, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove(documents: DataFrame) -> DataFrame:
    """The documents without the bytes to remove. Characters cut in two go, too;
    ``n_chars``, if there is one, follows the text. A document of which nothing but
    space is left goes."""
    names, changed = documents.columns, "n_chars" in documents.columns
    extra = spare_name("ranges", names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ranges = batch.column(extra)
            for k in range(batch.num_rows):
                if ranges[k].is_valid and texts[k]:
                    raw = np.frombuffer(texts[k].encode(), np.uint8)
                    texts[k] = _left(raw, *_pairs(ranges, k))[0].decode("utf-8", "ignore")
            columns = {c: batch.column(c) for c in names}
            columns["text"] = pa.array(texts, pa.string())
            if changed:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            out = pa.RecordBatch.from_arrays(list(columns.values()), names=names)
            kept = [not r or bool(t and t.strip()) for r, t in zip(ranges.is_valid().to_pylist(), texts, strict=True)]
            yield out.filter(pa.array(kept, pa.bool_()))

    found = find(documents).withColumnRenamed("ranges", extra)
    rows = documents.join(found.hint("merge"), "doc_id", "left").select(*names, extra)
    return rows.mapInArrow(cut, documents.schema)
