"""The trie of conversations that begin with the same turns, by vertical bitmaps.

Conversations in order of id are cut into shards. A shard has a bitset of its
conversations for every (position, turn). From the root down, a node's bitset meets the
postings of its lowest conversation that is still without a child: what both hold is
the child, and the rest gives the next one. Popcounts are members; those that end at a
node's depth are its end list.

Nodes are known by a digest of the turns that lead to them, so that nodes of several
shards are put together by it, shard by shard: no hot node brings more rows than there
are shards. What sums over a subtree adds up over shards if each node counts in one
shard only, its owner; for that the shards' trees are gone through once more, from the
leaves up.

Of a conversation its turns' digests come together in one task (16 bytes a turn), its
texts do not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.ordered import runs, turn_key
from txrisk.llm.tables import written

SHARD = 2048  # conversations of a shard
SHARD_TURNS = 1 << 16  # turns of a shard (of one longer conversation at least)
ROOT = bytes(16)

LOCAL_DDL = (
    "shard long, id int, up int, node binary, depth int, n long, conv_id long, size long, "
    "childless boolean, ends array<long>"
)
SUMS_DDL = (
    "node binary, depth int, conv_id long, parent_conv_id long, n long, kids long, leaves long, "
    "gross long, net long"
)


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: a row per conversation, its turns in order (null first; of one
    turn number by role, then digest) as ``turn, role, key, size``; ``key`` stands for
    role and text, ``size`` is the text's code points. Null role or text is empty. Rows
    without id are left out, as are other columns; repeated rows are turns of their own.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turn = F.struct("turn", "role", turn_key().alias("key"), F.length("text").cast("long").alias("size"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


class _Shard:
    """The trie of a few conversations ``(id, keys, sizes)``, in order of id."""

    def __init__(self, members: list[tuple[int, list[bytes], list[int]]]):
        self.members = members
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ending: dict[int, int] = {}
        for k, (_, keys, _) in enumerate(members):
            bit = 1 << k
            for place in enumerate(keys):
                self.postings[place] = self.postings.get(place, 0) | bit
            self.ending[len(keys)] = self.ending.get(len(keys), 0) | bit

    def _ids(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.members[low.bit_length() - 1][0])
            bits ^= low
        return out

    def nodes(self) -> Iterator[tuple]:
        """``id, up, node, depth, n, conv_id, size, childless, ends``, parents first."""
        waiting = [((1 << len(self.members)) - 1, -1, ROOT, 0)]
        number = 0
        while waiting:
            bits, up, node, depth = waiting.pop()
            first, keys, sizes = self.members[(bits & -bits).bit_length() - 1]
            ends = bits & self.ending.get(depth, 0)
            rest = bits ^ ends
            yield (
                number, up, node, depth, bits.bit_count(), first, sizes[depth - 1] if depth else 0,
                not rest, self._ids(ends),
            )
            while rest:
                key = self.members[(rest & -rest).bit_length() - 1][1][depth]
                child = rest & self.postings[depth, key]
                digest = hashlib.blake2b(node + key, digest_size=16).digest()
                waiting.append((child, number, digest, depth + 1))
                rest ^= child
            number += 1


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in ddl.split(", ")]
    columns = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _local(convs: int, turns: int):
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        members, held, count = [], 0, 0
        for batch in batches:
            for one, path in zip(batch.column("conv_id").to_pylist(), batch.column("turns"), strict=True):
                values = path.values
                keys = values.field("key").to_pylist()
                if members and (len(members) >= convs or held + len(keys) > turns):
                    yield from _told(members, first + count)
                    members, held, count = [], 0, count + 1
                members.append((one, keys, values.field("size").to_pylist()))
                held += len(keys)
        if members:
            yield from _told(members, first + count)

    return local


def _told(members: list, shard: int) -> Iterator[pa.RecordBatch]:
    rows = [(shard, *row) for row in _Shard(members).nodes()]
    for at in range(0, len(rows), 1 << 14):
        yield _table(rows[at : at + (1 << 14)], LOCAL_DDL)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the leaves up: what each node of a shard adds to the node of all shards."""
    for part in runs(batches, "shard"):
        up, n, size, conv, leaf, owned = (
            part.column(c).to_pylist() for c in ("up", "n", "size", "first_id", "leaf", "owned")
        )
        kids, leaves = [0] * len(up), [int(a and b) for a, b in zip(leaf, owned, strict=True)]
        gross = [a * b for a, b in zip(n, size, strict=True)]
        net = [s if o else 0 for s, o in zip(size, owned, strict=True)]
        for k in range(len(up) - 1, 0, -1):
            p = up[k]
            kids[p] += owned[k]
            leaves[p] += leaves[k]
            gross[p] += gross[k]
            net[p] += net[k]
        parents = [conv[p] if p >= 0 else None for p in up]
        rows = zip(part.column("node").to_pylist(), part.column("depth").to_pylist(), conv, parents,
                   n, kids, leaves, gross, net, strict=True)
        yield _table(list(rows), SUMS_DDL)


def build(of: DataFrame, convs: int = SHARD, turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """Nodes and end lists of the trie of ``conv_id, turns`` rows (as :func:`paths` gives
    them, ids once each; turns may be none).

    Nodes: ``node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens``. Ends: ``node, shard, ids``; shards follow each other in order of id.
    No conversations, no nodes: the root is there if any conversation is.
    """
    of = written(of, "trie-paths")
    dealt = of.repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    nodes = written(dealt.mapInArrow(_local(convs, turns), LOCAL_DDL), "trie-nodes")
    shared = nodes.groupBy("node").agg(
        F.count(F.lit(1)).alias("shards"),
        F.min("conv_id").alias("least"),
        F.min("shard").alias("owner"),
        F.min("childless").alias("all_childless"),
    )
    told = nodes.join(shared.filter("shards > 1"), "node", "left").select(
        "shard", "id", "up", "node", "depth", "n", "size",
        F.coalesce("least", "conv_id").alias("first_id"),
        F.coalesce("all_childless", "childless").alias("leaf"),
        F.coalesce(F.col("owner") == F.col("shard"), F.lit(True)).alias("owned"),
    )
    sums = told.repartition("shard").sortWithinPartitions("shard", "id").mapInArrow(_summed, SUMS_DDL)
    whole = sums.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").cast("long").alias("depth"),
        F.min("parent_conv_id").alias("parent_conv_id"),
        F.sum("n").alias("n_convs"),
        F.sum("kids").alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        (F.sum("gross") - F.sum("net")).alias("saved_tokens"),
    )
    ends = nodes.filter(F.size("ends") > 0).select("node", "shard", F.col("ends").alias("ids"))
    return whole, ends
