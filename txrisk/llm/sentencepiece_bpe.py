"""SentencePiece merges: whole texts to ids and back, exactly.

A sequence of pieces is the one that merging gives if each piece, and each two
neighbours, merge to themselves. So no merge queue is run over a text: from the left
the longest piece that begins at a place is taken (an Aho-Corasick automaton finds all
pieces of a unit at once), if it fits its left neighbour, which merging the two again
tells, else the next shorter one. Where none fits, the place is marked in a bitfield of
failed places and the last piece is given back. Work is linear in the text.

No piece holds a space behind another character, so that merges never pass from one
unit (spaces, then what is up to the next space) to the next; a task keeps a bounded
number of short units it has seen, and of pairs it has tried.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"  # stands for a space in pieces
KEPT_UNITS, KEPT_PAIRS = 1 << 18, 1 << 19  # of a Python worker
SHORT = 64  # characters of a unit that is kept
BATCH_CHARS = 1 << 22  # of texts handed on at once
_UNKNOWN_TEXT = " ⁇ "  # what an unknown id decodes to


class Vocabulary:
    """Pieces, ids and merge ranks of a model file: merges with byte fallback, text as it
    is but for a space put before it, no pieces of the user's own."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError(f"{path}: only models that leave texts as they are")
        self.size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.spelled: list[bytes] = []
        self.is_byte = np.zeros(self.size, bool)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_control(i):
                self.spelled.append(b"")
            elif model.is_unknown(i):
                self.spelled.append(_UNKNOWN_TEXT.encode())
            elif model.is_byte(i):
                self.is_byte[i] = True
                self.spelled.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.ids[piece], self.rank[piece] = i, -model.get_score(i)
                self.spelled.append(piece.replace(SPACE, " ").encode())
        self.of_byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or not self.is_byte.sum() == 256:
            raise ValueError(f"{path}: only models with byte pieces, and spaces in front of pieces")


class Encoder(dict):
    """Units to their ids, as bytes of 32-bit numbers; works out what it does not hold."""

    def __init__(self, words: Vocabulary):
        import ahocorasick

        super().__init__()
        self.words = words
        self.found = ahocorasick.Automaton()
        for piece in words.ids:
            self.found.add_word(piece, len(piece))
        self.found.make_automaton()
        self._older: dict[str, bytes] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._shorter: dict[str, str | None] = {}
        self._edges: dict[str, tuple | None] = {}

    def merged(self, text: str, down_to: int = 1) -> list[str]:
        """Plain merging, always of the best pair, the leftmost of equals, until so many
        symbols are left or no pair is a piece."""
        symbols, rank = list(text), self.words.rank
        while len(symbols) > down_to:
            pairs = [rank.get(a + b, np.inf) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = min(pairs)
            if best == np.inf:
                break
            k = pairs.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def edges(self, piece: str) -> tuple | None:
        """What stands at the piece's left end, and at its right end, while it is merged:
        lists of (symbol, rank at which it comes, rank at which it goes), the piece itself
        first. None if it does not merge to itself. A third value tells whether ranks
        rise from step to step, so that they can stand for time."""
        if piece in self._edges:
            return self._edges[piece]
        if len(piece) == 1:
            own = [(piece, -1.0, np.inf)]
            found = (own, own, True)
        else:
            halves = self.merged(piece, 2)
            parts = [self.edges(h) for h in halves] if len(halves) == 2 else [None]
            rank = self.words.rank.get(piece)
            if None in parts or rank is None:
                found = None
            else:
                (left, _, a), (_, right, b) = parts
                rises = all(x[0][1] < rank for x in (left, right)) and SPACE * 2 not in piece
                own = (piece, rank, np.inf)
                found = (
                    [own, (*left[0][:2], rank), *left[1:]],
                    [own, (*right[0][:2], rank), *right[1:]],
                    a and b and rises,
                )
        self._edges[piece] = found
        return found

    def _stay(self, left: str, piece: str) -> bool:
        before, after = self.edges(left), self.edges(piece)
        if before is None or after is None:
            return False
        if not (before[2] and after[2]):  # equal ranks of several pieces, as of runs of spaces
            return self.merged(left + piece) == [left, piece]
        rank = self.words.rank
        for a, comes, goes in before[1]:
            for b, comes_too, goes_too in after[0]:
                across = rank.get(a + b)
                # Of equal ranks the left one goes first: inside the left piece, then across.
                if across is not None and goes > (t := max(across, comes, comes_too)) <= goes_too:
                    return False
        return True

    def fits(self, left: str, piece: str) -> bool:
        """Whether both stay what they are when merged again, which the symbols at their
        common border tell; ``left`` is empty at the start."""
        key = (left, piece)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= KEPT_PAIRS:
                self._fits.clear()
            alone = not left and self.edges(piece) is not None
            known = self._fits[key] = alone or bool(left and self._stay(left, piece))
        return known

    def shorter(self, piece: str) -> str | None:
        """The longest piece in front of a longer one; a character alone is always one."""
        if len(piece) == 1:
            return None
        if piece not in self._shorter:
            fronts = (piece[:k] for k in range(len(piece) - 1, 0, -1))
            self._shorter[piece] = next(f for f in fronts if f in self.words.ids or len(f) == 1)
        return self._shorter[piece]

    def pieces(self, unit: str) -> list[str]:
        size = len(unit)
        longest = [1] * size
        for end, length in self.found.iter(unit):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        failed = bytearray((size >> 3) + 1)
        taken: list[str] = []
        known, fits = self._fits.get, self.fits
        at, piece = 0, unit[: longest[0]]
        while at < size:
            left = taken[-1] if taken else ""
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fit = known((left, piece))
                    if fit if fit is not None else fits(left, piece):
                        break
                piece = self.shorter(piece)
            if piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                given_back = taken.pop()
                at -= len(given_back)
                piece = self.shorter(given_back)
            else:
                taken.append(piece)
                at = end
                if at < size:
                    piece = unit[at : at + longest[at]]
        return taken

    def __missing__(self, unit: str) -> bytes:
        row = self._older.get(unit)
        return self._kept(unit, self._encoded(unit) if row is None else row)

    def _kept(self, unit: str, row: bytes) -> bytes:
        """Kept in two generations: units in use outlast those seen once."""
        if len(unit) <= SHORT:
            if len(self) >= KEPT_UNITS:
                self._older = dict(self)
                self.clear()
            self[unit] = row
        return row

    def _encoded(self, unit: str) -> bytes:
        ids: list[int] = []
        for piece in self.pieces(unit):
            known = self.words.ids.get(piece)
            if known is None:
                ids.extend(self.words.of_byte[b] for b in piece.encode())
            else:
                ids.append(known)
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return b"".join(map(self.__getitem__, units(text)))


def units(text: str) -> list[str]:
    """A text with a space put before it, cut ahead of every run of spaces."""
    if not text:
        return []
    words = text.replace(" ", SPACE).split(SPACE)
    if "" not in words:
        return [SPACE + w for w in words]
    out, spaces = [], ""
    for word in words:
        spaces += SPACE
        if word:
            out.append(spaces + word)
            spaces = ""
    return [*out, spaces] if spaces else out


class Decoder:
    def __init__(self, words: Vocabulary):
        self.words = words
        self.sizes = np.array([len(s) for s in words.spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.spelled = np.frombuffer(b"".join(words.spelled), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8: bytes that make no character become U+FFFD each, and
        the space put before the text goes."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1])) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        out = self.spelled[places].tobytes()
        if self.words.is_byte[ids].any():
            try:
                out.decode()
            except UnicodeDecodeError:
                out = self._mended(ids)
        # Only the first piece that shows loses a space of its own; an unknown id's stays.
        first = int(np.flatnonzero(sizes)[0]) if ends[-1] else 0
        spaced = self.words.spelled[int(ids[first])] != _UNKNOWN_TEXT.encode()
        return out[1:] if spaced and not self.words.is_byte[ids[first]] and out[:1] == b" " else out

    def _mended(self, ids: np.ndarray) -> bytes:
        out, run = [], b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.words.is_byte[i]:
                run += self.words.spelled[i]
                continue
            while run:
                for k in (1, 2, 3, 4):
                    try:
                        run[:k].decode()
                    except UnicodeDecodeError:
                        continue
                    out.append(run[:k])
                    run = run[k:]
                    break
                else:
                    out.append("�".encode())
                    run = run[1:]
            if i >= 0:
                out.append(self.words.spelled[i])
        return b"".join(out)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(Vocabulary(path))


@cache
def _decoder(path: str) -> Decoder:
    return Decoder(Vocabulary(path))


def _cut(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` together, one row at least."""
    ends, at = np.concatenate([[0], np.cumsum(sizes)]), 0
    while at < len(sizes):
        to = max(int(np.searchsorted(ends, ends[at] + limit, "right")) - 1, at + 1)
        yield at, to
        at = to


def _sizes(column: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])


def encode(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids``, a row per row: the ids of every whole text, without those of begin
    and end; none of a null or empty text. ``model`` is the file's path on every machine.
    Repeated rows, and rows without id, are texts like any other; other columns stay behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            for a, b in _cut(_sizes(texts), BATCH_CHARS) if len(texts) else ():
                rows = [encoder.encode(t) if t else b"" for t in texts.slice(a, b - a).to_pylist()]
                ends = np.cumsum([0, *map(len, rows)]) // 4
                flat = pa.array(np.frombuffer(b"".join(rows), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), ids], names=["doc_id", "ids"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, text`` of rows ``doc_id, ids``; no ids (or null) give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(model)
        for batch in batches:
            lists = batch.column("ids")
            for k, part in ((k, lists.slice(k, 256)) for k in range(0, len(lists), 256)):
                flat = part.flatten().to_numpy(zero_copy_only=False)
                sizes = np.array([len(x) if x.is_valid else 0 for x in part], np.int64)
                ends = np.cumsum(sizes)
                texts = [decoder.decode(flat[e - s : e]) for s, e in zip(sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(k, 256), part, pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "ids", "text"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
