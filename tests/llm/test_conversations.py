"""Conversation trie and repair against plain versions, and their odd cases."""

from __future__ import annotations

import itertools
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402

from txrisk.llm import conversation_repair, conversation_trie, queries  # noqa: E402
from txrisk.llm.ordered import sha256_in_order  # noqa: E402

DDL = "conv_id long, turn long, role string, text string"
TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
LONG = "ä long one. " * 20_000


def made(n_convs: int, seed: int = 1) -> list[tuple]:
    """Conversations of few different turns, so that they share much, some of them long."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n_convs):
        size = rnd.choice([1, 2, 3, 5, 8, 40]) if c % 10 else rnd.randint(5, 300)
        for turn in range(size):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])
            rows.append((c, turn + turn // 7, role, rnd.choice(["a.", "b?", "no end", " ", "a.", "c!", f"x{turn}."])))
    return rows


ODD = [
    (0, 0, "user", "hello."), (0, 1, "assistant", None), (0, None, None, "first"), (0, None, None, "first"),
    (7, None, None, None), (7, 2, "user", LONG), (7, 2, "user", LONG), (7, 2, "a", "x"),
    (-5, 0, "user", "hello."), (-5, 1, "user", "é🙂."), (101, 3, "system", "only"), (250, 9, "user", "9"),
    (250, -4, "user", "minus."), (100, 0, "user", "hello."),
]


@pytest.fixture(scope="module")
def queried(spark, tmp_path_factory):
    def run(name: str, rows: list[tuple], parts: int = 3):
        folder = tmp_path_factory.mktemp("conversations")
        table = spark.createDataFrame(rows, DDL).withColumns(
            {c: F.lit("clash") for c in ("piece", "codes", "node", "shard", "turns", "_hurt", "mark", "key", "h")}
        )
        table.repartition(parts).write.parquet(f"{folder}/conversations.parquet")
        return queries.QUERIES[name](spark, str(folder))

    return run


def trie_of(spark, rows: list[tuple], **shards) -> list[tuple]:
    nodes, ends = conversation_trie.build(queries.rebuilt(spark.createDataFrame(rows, DDL)), **shards)
    digests = sha256_in_order(ends.withColumn("listed", F.array_join("ids", ",")), "node", "shard", "listed", ",")
    told = nodes.join(digests, "node", "left").withColumn(
        "ends_sha256", F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256))
    )
    return sorted(map(tuple, told.select(*TRIE).collect()), key=str)


def given(spark, sf: str) -> list[tuple]:
    table = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    return [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]


def test_trie_of_the_table(spark):
    rows = given(spark, "sf0.01")
    got = queries.op12_conversation_trie(spark, "/root/testdata/sf0.01")
    want = plain.trie_nodes(plain.rebuilt_conversations(rows))
    assert sorted(map(tuple, got.select(*TRIE).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("shards", [{"convs": 3}, {"convs": 16, "turns": 20}, {}])
def test_trie_in_any_shards(spark, shards):
    rows = [(c, t, "user" if t % 2 else "assistant", x[:1]) for c, t, _, x in made(300)]
    rows += [(1000 + c, t, "user", str(t)) for c in range(150) for t in range(4)]  # copies
    want = plain.trie_nodes(plain.rebuilt_conversations(rows))
    assert trie_of(spark, rows, **shards) == sorted(want, key=str)


def test_trie_odd(spark, queried):
    want = plain.trie_nodes(plain.rebuilt_conversations(ODD))
    got = queried("op12_conversation_trie", [*ODD, (None, 1, "user", "left out")])
    assert sorted(map(tuple, got.select(*TRIE).collect()), key=str) == sorted(want, key=str)
    assert queried("op12_conversation_trie", []).collect() == []


def test_trie_of_conversations_without_turns(spark):
    path = "conv_id long, turns array<struct<turn:long,role:string,key:binary,size:long>>"
    turn = (0, "user", b"k" * 16, 4)
    of = spark.createDataFrame([(3, []), (1, []), (2, [turn])], path)
    nodes, ends = conversation_trie.build(of)
    got = {r.depth: (r.conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in nodes.collect()}
    assert got == {0: (1, 3, 1, 1, 0), 1: (2, 1, 0, 1, 0)}
    assert sorted(r.ids for r in ends.collect()) == [[1, 3], [2]]


def reports(df) -> dict:
    return {r["conv_id"]: tuple(r[c] for c in REPORT) for r in df.collect()}


def test_plain_repair_is_the_cheapest():
    """The plain version against every string of letters, on all short conversations."""
    roles = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    cases = [c for n in range(4) for c in itertools.product("suat", [0, 1, 2], repeat=n)][::7]

    def ways(rows, faults, state, depth):
        if not rows:
            fill = {"": [""], "a": [""], "u": ["I"], "s": ["II"]}[state]
            for f in fill:
                yield 3 * len(f), f
        else:
            (role, _), wrong = rows[0], faults[0]
            to = "a" if state == "u" else "u"
            after = {"D": (state, 4)}
            if wrong not in ("blank", "duplicate"):
                more = 3 * (wrong == "truncated")
                after["R"] = (to, 3 + more)
                if state + role[:1] in ("s", "u", "su", "ua", "au"):
                    after["K"] = (role[:1], more)
            for letter, (state_after, cost) in after.items():
                for c, rest in ways(rows[1:], faults[1:], state_after, 0):
                    yield c + cost, letter + rest
        if depth < 2:
            for c, rest in ways(rows, faults, "a" if state == "u" else "u", depth + 1):
                yield c + 3, "I" + rest

    for case in cases:
        rows = [(roles[r], ["end.", f"none {k}", ""][w]) for k, (r, w) in enumerate(zip(case[::2], case[1::2], strict=True))]
        faults = plain.row_faults(rows)
        assert plain.repaired_conversation(rows)[:2] == min(ways(rows, faults, "", 0)), rows
        codes = bytes(
            3 * "suat".index(r[:1]) + {"": 0, "truncated": 1}.get(w, 2) for (r, _), w in zip(rows, faults, strict=True)
        )
        letters, cost, _ = conversation_repair.trace(codes, conversation_repair.costs(codes, conversation_repair.END), 0, True)
        assert (cost, "".join(letters)) == plain.repaired_conversation(rows)[:2]


def test_repair_of_the_table(spark):
    got = queries.op13_conversation_repair(spark, "/root/testdata/sf0.01")
    assert reports(got) == plain.conversation_reports(given(spark, "sf0.01"))


@pytest.mark.parametrize("chunk", [1, 3, 128])
def test_repair_in_any_chunks(spark, queried, monkeypatch, chunk):
    """Conversations over many chunks and tasks; rows that an earlier task has, too."""
    monkeypatch.setattr(conversation_repair.repair, "__defaults__", (chunk,))
    rows = made(60)
    rows += [(5000, t, "user" if t % 3 else "assistant", f"t{t % 400}.") for t in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert reports(queried("op13_conversation_repair", rows)) == plain.conversation_reports(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repair_odd(queried):
    rows = [*ODD, (None, 1, "user", "no id."), (None, None, "assistant", "no id.")]
    assert reports(queried("op13_conversation_repair", rows)) == plain.conversation_reports(rows)
    assert queried("op13_conversation_repair", []).collect() == []


def test_a_chunk_forgets_what_it_started_from():
    codes = bytes([3, 6] * 20)
    starts = {conversation_repair.costs(codes, end)[0] for end in [(0, 0, 0, 0), (0, 6, 3, 0), (9, 0, 2, 5)]}
    assert len(starts) == 1
