"""Repair of conversations by the cheapest edits, in chunks that run side by side.

A conversation's roles must read ``(s?(ua)+)?`` by their initials. Edits: K keeps a row,
R gives it the role user or assistant, D deletes it (which blank and repeated rows need),
I inserts a row without text. The cheapest sequence is a shortest way through four
states, found backwards from the end, row by row (Viterbi).

Rows are dealt in order, so that a conversation may lie in many tasks, and cut into
chunks. A chunk does not wait for the one behind it: it starts from a speculative vector
of costs to the end. Where the vector that the next chunk then gives differs from that
by more than a constant, a fix-up pass runs the chunk again, until none differs: steps
soon forget what they started from (their rank falls to one). Constants do not matter
for the choice between edits, so the stitched vectors are then traced forwards for the
least letters, each chunk from every state it may be entered in; which one it is follows
from chunk to chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.ordered import turn_key
from txrisk.llm.tables import written

CHUNK = 128  # rows
CHUNK_CHARS = 1 << 20  # characters of texts in a chunk (one longer text at least)
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3  # costs

# States: nothing yet, after a system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FILL = (_USER, _USER, _ASSISTANT, _USER)  # state after the row that may be put in
_ROLE_OF = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = "sua"
_GOES = {  # (state, initial) -> state, for rows kept
    (_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER,
}
_FINE, _CUT_OFF, _GONE = range(3)  # what is wrong with a row
END = (0, 6, 3, 0)  # costs behind the last row, rows put in being allowed there
GUESS = (0, 0, 0, 0)

PIECES_DDL = (
    "conv_id {kind}, piece long, open boolean, codes binary, marks array<struct<at:int,mark:binary>>, "
    "roles array<string>, texts array<string>, audit string, cost long, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string"
)


def _ways(code: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of every edit of a row, in order of letters."""
    kind, fault = divmod(code, 3)
    ways = [("D", DELETE, state)]
    if fault != _GONE:
        more = TRUNCATED if fault == _CUT_OFF else 0
        if kind < 3 and (state, _INITIALS[kind]) in _GOES:
            ways.append(("K", more, _GOES[state, _INITIALS[kind]]))
        ways.append(("R", REROLE + more, _FILL[state]))
    return ways


@cache
def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end ahead of a row, less the least of them, from those behind it."""
    row = [min(cost + after[to] for _, cost, to in _ways(code, s)) for s in range(4)]
    best = [min(row[s], INSERT + row[_FILL[s]], 2 * INSERT + row[_FILL[_FILL[s]]]) for s in range(4)]
    return tuple(b - min(best) for b in best)


@cache
def _step(code: int, state: int, after: tuple[int, ...]) -> tuple[str, int, int]:
    """The least letters, their cost and the state behind the row, of a cheapest way
    from ``state``: rows put in and the row's own edit."""
    choices = []
    letters, spent = "", 0
    for _ in range(3):
        for letter, cost, to in _ways(code, state):
            choices.append((spent + cost + after[to], letters + letter, spent + cost, to))
        letters, spent, state = letters + "I", spent + INSERT, _FILL[state]
    _, letters, cost, to = min(choices)
    return letters, cost, to


@cache
def _last(state: int) -> tuple[str, int, int]:
    """What is put in behind the last row."""
    return {_START: ("", 0, _START), _SYSTEM: ("II", 6, _ASSISTANT), _USER: ("I", 3, _ASSISTANT),
            _ASSISTANT: ("", 0, _ASSISTANT)}[state]


def costs(codes: bytes, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs to the end ahead of every row, and behind the last; constants left out."""
    out = [end]
    for code in reversed(codes):
        out.append(_before(code, out[-1]))
    return out[::-1]


def trace(codes: bytes, vectors: list[tuple[int, ...]], state: int, is_last: bool) -> tuple[list[str], int, int]:
    """The letters of every row (and of what comes behind the last), their cost, and
    the state at the end."""
    out, spent = [], 0
    for code, after in zip(codes, vectors[1:], strict=True):
        letters, cost, state = _step(code, state, after)
        out.append(letters)
        spent += cost
    if is_last:
        letters, cost, state = _last(state)
        out.append(letters)
        spent += cost
    return out, spent, state


def edited(letters: list[str], roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits of a chunk entered in ``state``."""
    new_roles, new_texts, row = [], [], 0
    for letter in "".join(letters):
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            role, text = roles[row], texts[row]
            state = _GOES[state, role[:1]]
        else:
            state = _FILL[state]
            role, text = _ROLE_OF[state], texts[row] if letter == "R" else ""
        row += letter != "I"
        new_roles.append(role)
        new_texts.append(text)
    return new_roles, new_texts


def _breaks(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


class _Chunk:
    """Rows of one conversation, as far as a task has them together."""

    def __init__(self, conv_id, sure: bool):
        self.conv_id, self.sure = conv_id, sure  # whether the task saw its conversation begin
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.marks: list[tuple[int, bytes]] = []
        self.codes, self.chars = bytearray(), 0
        self.faults = [0, 0, 0]

    def add(self, role: str, text: str, mark: bytes, fault: str, again: bool) -> None:
        if fault != "blank" and not again:
            self.marks.append((len(self.roles), mark))
        fault = "duplicate" if again and fault != "blank" else fault
        if fault:
            self.faults[("blank", "duplicate", "truncated").index(fault)] += 1
        kind = _INITIALS.find(role[:1]) if role else -1
        wrong = {"": _FINE, "truncated": _CUT_OFF}.get(fault, _GONE)
        self.codes.append((3 if kind < 0 else kind) * 3 + wrong)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def row(self, piece: int, is_open: bool) -> tuple:
        codes, initials = bytes(self.codes), [r[:1] for r in self.roles]
        ends = (initials[0], initials[-1]) if initials else ("", "")
        head = (self.conv_id, piece, is_open)
        if is_open:
            shown = (codes, self.marks, self.roles, self.texts, None, None)
        else:
            letters, cost, _ = trace(codes, costs(codes, END), _START, True)
            shown = (b"", [], *edited(letters, self.roles, self.texts, _START), "".join(letters), cost)
        return (*head, *shown, *self.faults, _breaks(initials), *ends)


def _pieces(chunk_rows: int, kind: pa.DataType):
    types = [kind, pa.int64(), pa.bool_(), pa.binary(),
             pa.list_(pa.struct([("at", pa.int32()), ("mark", pa.binary())])),
             pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), *[pa.int64()] * 5, pa.string(), pa.string()]
    names = ["conv_id", "piece", "open", "codes", "marks", "roles", "texts", "audit", "cost", "blank",
             "duplicate", "truncated", "illegal", "first", "last"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        columns[4] = [[{"at": a, "mark": m} for a, m in x] for x in columns[4]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        chars = 0
        chunk: _Chunk | None = None
        cut, seen = False, set()  # whether the conversation has a chunk already; its marks here
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "mark", "fault")]
            for conv_id, role, text, mark, fault in zip(*columns, strict=True):
                if chunk is None:
                    chunk = _Chunk(conv_id, False)
                elif chunk.conv_id != conv_id:
                    out.append(chunk.row(number, cut or not chunk.sure))
                    chars += chunk.chars
                    number, chunk, cut, seen = number + 1, _Chunk(conv_id, True), False, set()
                elif len(chunk.roles) >= chunk_rows or chunk.chars + len(text) > CHUNK_CHARS:
                    out.append(chunk.row(number, True))
                    chars += chunk.chars
                    number, chunk, cut = number + 1, _Chunk(conv_id, chunk.sure), True
                chunk.add(role, text, mark, fault, mark in seen)
                seen.add(mark)
                if chars > CHUNK_CHARS:
                    yield batch_of(out)
                    out, chars = [], 0
        if chunk is not None:  # the conversation may go on in the next task
            yield batch_of([*out, chunk.row(number, True)])

    return pieces


def fault(text: str = "text") -> Column:
    """``blank``, ``truncated`` or empty; repeats are told apart later."""
    shown = F.rtrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    return (
        F.when(shown == "", "blank")
        .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )


def _repeated(opened: DataFrame) -> DataFrame:
    """``piece, repeats``: places of rows that an earlier task has, too. A task names the
    first of equal rows only, so no group has more rows than there are tasks."""
    rows = opened.select("conv_id", "piece", F.inline("marks"))
    where = F.sort_array(F.collect_list(F.struct("piece", "at")))
    groups = rows.groupBy("conv_id", "mark").agg(where.alias("where")).filter(F.size("where") > 1)
    later = groups.select(F.inline(F.slice("where", F.lit(2), F.size("where"))))
    return later.groupBy("piece").agg(F.collect_list("at").alias("repeats"))


def _patched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats known only now become rows to delete; counts follow."""
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        for k, repeats in enumerate(columns["repeats"]):
            codes = bytearray(columns["codes"][k])
            for at in repeats or ():
                kind, wrong = divmod(codes[at], 3)
                codes[at] = kind * 3 + _GONE
                columns["duplicate"][k] += 1
                columns["truncated"][k] -= wrong == _CUT_OFF
            columns["codes"][k] = bytes(codes)
        del columns["repeats"]
        names = list(columns)
        types = [batch.schema.field(c).type for c in names]
        yield pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in zip(names, types, strict=True)], names=names)


def _run_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs at the start of chunks whose costs at the end are new."""
    for batch in batches:
        codes, ends, given, start = (batch.column(c).to_pylist() for c in ("codes", "ends", "given", "start"))
        for k, end in enumerate(given):
            if start[k] is None or end != ends[k]:
                start[k] = list(costs(codes[k], tuple(end))[0])
        ints = pa.list_(pa.int64())
        columns = [batch.column(c) for c in ("piece", "behind", "codes")]
        changed = pa.array([a != b for a, b in zip(given, ends, strict=True)])
        columns += [pa.array(given, ints), pa.array(start, ints), changed]
        yield pa.RecordBatch.from_arrays(columns, names=["piece", "behind", "codes", "ends", "start", "changed"])


def _converged(chunks: DataFrame) -> DataFrame:
    """``piece, codes, ends``: chunks with the costs at their end, constants left out, of
    rows ``piece, behind, codes`` (``behind`` is the next chunk, null at the last)."""
    ddl = "piece long, behind long, codes binary, ends array<long>, start array<long>, changed boolean"
    vector = lambda v: F.array(*[F.lit(x).cast("long") for x in v])
    given = F.when(F.col("behind").isNull(), vector(END)).otherwise(vector(GUESS))
    none = F.lit(None).cast("array<long>")
    first = chunks.withColumns({"given": given, "ends": none, "start": none})
    now = written(first.mapInArrow(_run_again, ddl), "repair-vectors")
    while True:
        behind = now.select(F.col("piece").alias("behind"), F.col("start").alias("next_start"))
        told = now.drop("changed").join(behind, "behind", "left")
        told = told.withColumn("given", F.coalesce("next_start", "ends")).drop("next_start")
        now = written(told.mapInArrow(_run_again, ddl), "repair-vectors")
        if now.filter("changed").isEmpty():
            return now.select("piece", "codes", "ends")


def _through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk the state it is left in, for each that it may be entered in."""
    for batch in batches:
        exits = []
        for codes, end in zip(batch.column("codes").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            vectors = costs(codes, tuple(end))
            exits.append([trace(codes, vectors, s, False)[2] for s in range(4)])
        columns = [batch.column("piece"), pa.array(exits, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["piece", "exits"])


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a conversation in order: the state each is entered in, and whether the
    roles at its border to the one before it may not follow each other."""
    state, conv, last, known = _START, None, "", False
    for batch in batches:
        states, breaks = [], []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "exits", "first", "last")]
        for conv_id, exits, first, its_last in zip(*columns, strict=True):
            if not known or conv_id != conv:
                state, conv, known = _START, conv_id, True
                breaks.append(0)
            else:
                breaks.append(_breaks([last, first]))
            states.append(state)
            state, last = exits[state], its_last
        yield pa.RecordBatch.from_arrays(
            [batch.column("piece"), pa.array(states, pa.int32()), pa.array(breaks, pa.int64())],
            names=["piece", "entered", "border"],
        )


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {n: batch.column(n).to_pylist() for n in ("codes", "ends", "entered", "is_last", "roles", "texts")}
        audits, spent, roles, texts = [], [], [], []
        for codes, end, state, is_last, old_roles, old_texts in zip(*c.values(), strict=True):
            letters, cost, _ = trace(codes, costs(codes, tuple(end)), state, is_last)
            new = edited(letters, old_roles, old_texts, state)
            for to, value in zip((audits, spent, roles, texts), ("".join(letters), cost, *new), strict=True):
                to.append(value)
        strings = pa.list_(pa.string())
        columns = [batch.column("conv_id"), batch.column("piece"), pa.array(roles, strings), pa.array(texts, strings)]
        columns += [pa.array(audits), pa.array(spent, pa.int64())]
        columns += [batch.column(n) for n in ("blank", "duplicate", "truncated", "illegal")]
        yield pa.RecordBatch.from_arrays(
            columns,
            names=["conv_id", "piece", "roles", "texts", "audit", "cost", "blank", "duplicate", "truncated", "illegal"],
        )


def repair(conversations: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """Repaired conversations, a row per piece: ``conv_id, piece, whole, roles, texts``
    (the rows that result), ``audit, cost`` (the edits) and ``blank, duplicate, truncated,
    illegal`` (what was wrong). Pieces of a conversation follow each other by ``piece``;
    ``whole`` ones are all of theirs.

    Reads ``conv_id, turn, role, text``. Rows go by turn, nulls first, those of one turn
    by role and text (its first 64 characters, then its digest). A null role or text is
    one space, which makes a text blank. Rows without id are one conversation. Repeated
    rows are duplicates. An empty table gives no row; other columns are left behind.
    """
    kind = conversations.schema["conv_id"].dataType
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumns({"mark": turn_key(), "fault": fault(), "front": F.substring("text", 1, 64)})
    order = ["conv_id", "turn", "role", "front", "mark"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ddl = PIECES_DDL.format(kind=kind.simpleString())
    arrow = pa.string() if kind.simpleString() == "string" else pa.int64()
    pieces = dealt.select("conv_id", "role", "text", "mark", "fault").mapInArrow(_pieces(chunk_rows, arrow), ddl)
    pieces = written(pieces, "repair-pieces")
    columns = ["conv_id", "piece", "roles", "texts", "audit", "cost", "blank", "duplicate", "truncated", "illegal"]
    whole = pieces.filter("NOT open").select(*columns, F.lit(True).alias("whole"))
    opened = pieces.filter("open")

    small = ["piece", "conv_id", "codes", "duplicate", "truncated", "illegal", "first", "last"]
    next_piece = "lead(piece) OVER (PARTITION BY conv_id ORDER BY piece) AS behind"
    told = opened.select(*small).join(_repeated(opened), "piece", "left")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in opened.select(*small).schema)
    told = written(told.mapInArrow(_patched, schema).selectExpr("*", next_piece), "repair-codes")
    found = _converged(told.select("piece", "behind", "codes"))
    exits = found.mapInArrow(_through, "piece long, exits array<int>")
    ways = told.select("piece", "conv_id", "first", "last").join(exits, "piece")
    ways = ways.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    entered = ways.mapInArrow(_entered, "piece long, entered int, border long")
    state = found.join(entered, "piece").join(
        told.select("piece", "duplicate", "truncated", F.col("illegal").alias("inside"), F.col("behind").isNull().alias("is_last")),
        "piece",
    )
    state = state.withColumn("illegal", F.col("inside") + F.col("border")).drop("inside", "border")
    left = opened.select("conv_id", "piece", "roles", "texts", "blank").join(state, "piece")
    ddl = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns)
    mended = left.mapInArrow(_repaired, ddl).withColumn("whole", F.lit(False))
    return whole.unionByName(mended)


def gaps(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps``: turn numbers missing between a conversation's least and
    greatest; rows without number do not count."""
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    found = conversations.groupBy("conv_id").agg(missing.alias("gaps"))
    return found.select("conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))
