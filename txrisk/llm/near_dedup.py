"""Near-duplicate documents by SetSketch registers.

A document is its set of three-word shingles. Equal sets make one class. A class
is sketched by registers, each the smallest of the set's hashes on an exponential
scale, cut to whole steps. Classes that agree in a band of registers are
candidates; the likelihood of all registers jointly gives an estimate that weeds
them; the rest is compared shingle by shingle.

In a bucket every class is first compared with the smallest only; buckets of many
bands have many smallest, and what is linked is mostly one component then. All pairs
of one bucket and different components are compared after that, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import text as tx
from txrisk.llm.graph import components
from txrisk.llm.tables import packed, unpacked, written

SHINGLE = 3  # words
PERCENT = 85  # of the union that the intersection must be
_M = 288  # registers
MISSED = 1e-4  # chance that no band has a pair at the limit, at most
BASE, RATE, TOP = 1.1, 20.0, 255  # scale of the registers: a byte each
MARGIN = 0.10  # below the limit, for estimates: nearly five standard deviations
BLOCK = 128  # members of a bucket compared with as many at once

_FACTORS = np.random.default_rng(20240101).integers(1, 1 << 63, _M, np.uint64) * np.uint64(2)
_FACTORS += np.uint64(1)
SKETCH_DDL = "doc_id long, n_shingles long, d1 long, d2 long, registers binary"


def banding(percent: int) -> tuple[int, int]:
    """Bands, and registers in each: as many as ``MISSED`` allows. Registers of sets
    of equal size at the limit agree with chance log(1 + limit * (base - 1)), to the
    base of the scale."""
    agree = np.log1p(percent / 100 * (BASE - 1)) / np.log(BASE)
    rows = max(r for r in range(1, _M) if r == 1 or (1 - agree**r) ** (_M // r) <= MISSED)
    return _M // rows, rows


def _sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of each text, sorted, and where each text's begin."""
    low = tx.LOWER[raw]
    starts, ends = tx.words(low, offsets)
    first = np.searchsorted(starts, offsets)
    found, whose = tx.shingles(tx.hashes(low, starts, ends), first, size)
    order = np.lexsort((found, whose))
    found, whose = found[order], whose[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (whose[1:] != whose[:-1])
    found, whose = found[keep], whose[keep]
    return found, np.searchsorted(whose, np.arange(len(offsets)))


def _registers(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts by registers; a text without shingles has zeros."""
    n = len(first) - 1
    out = np.zeros((n, _M), np.uint8)
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return out
    least = np.empty((len(some), _M), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(_M):
            least[:, k] = np.minimum.reduceat(found * _FACTORS[k], first[some])
    x = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64.00001) / RATE
    out[some] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP)
    return out


def _sketch(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in tx.pieces(batches):
            found, first = _sets(raw, offsets, size)
            whose = np.repeat(np.arange(batch.num_rows), np.diff(first))
            with np.errstate(over="ignore"):
                digests = [np.zeros(batch.num_rows, np.uint64) for _ in range(2)]
                for digest, salt in zip(digests, (1, 2), strict=True):
                    np.add.at(digest, whose, tx.mix(found ^ tx.mix(np.array([salt], np.uint64))))
            registers = [x.tobytes() for x in _registers(found, first)]
            columns = [pa.array(np.diff(first))]
            columns += [pa.array(d.view(np.int64)) for d in digests]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(registers, pa.binary())],
                names=[x.split()[0] for x in SKETCH_DDL.split(", ")],
            )

    return sketch


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs, given how many registers are larger, smaller
    and equal, and the sizes of the sets."""
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - larger - smaller
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    best, most = np.zeros(len(a)), np.full(len(a), -np.inf)
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    for share in np.linspace(0, 1, 101):
        j = share * np.minimum(u / v, v / u)
        p, q = chance(u - v * j), chance(v - u * j)
        logs = [np.log(np.maximum(x, 1e-9)) for x in (p, q, 1 - p - q)]
        value = larger * logs[0] + smaller * logs[1] + equal * logs[2]
        best = np.where(value > most, j, best)
        most = np.maximum(value, most)
    return best


def _likely(limit: float):
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                a, b = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, _M)
                    for c in ("registers_a", "registers_b")
                )
                n_a, n_b = (part.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                good = estimate(a, b, n_a, n_b) >= limit
                yield part.select(["a", "b"]).filter(pa.array(good))

    return likely


def _compare(size: int, percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            good, ids = [], batch.column("a").to_numpy()
            for k in range(batch.num_rows):
                sets = []
                for c in "ab":
                    row = batch.column(f"packed_{c}")[k].as_py()
                    if c == "a" and (ids[k], row) == last:  # an id may have several texts
                        sets.append(known)
                        continue
                    last = (ids[k], row) if c == "a" else last
                    raw = unpacked(row, batch.column(f"size_{c}")[k].as_py())
                    sets.append(_sets(raw, np.array([0, len(raw)]), size)[0])
                known = sets[0]
                both = len(np.intersect1d(*sets, assume_unique=True))
                good.append(100 * both >= percent * (len(sets[0]) + len(sets[1]) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return compare


def _verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int):
    """Those of the pairs ``a < b`` of class ids that are linked."""
    pairs = written(pairs.distinct(), "near-pairs")
    side = lambda c: reps.select(
        F.col("id").alias(c),
        F.col("n_shingles").alias(f"n_{c}"),
        F.col("registers").alias(f"registers_{c}"),
    )
    told = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    sized = told.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    likely = sized.mapInArrow(_likely(percent / 100 - MARGIN), "a long, b long")
    likely = written(likely.distinct(), "near-likely")
    ids = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    used = written(texts.join(ids.hint("merge"), "doc_id", "left_semi"), "near-used")
    text = lambda c: used.select(
        F.col("doc_id").alias(c), F.col("packed").alias(f"packed_{c}"), F.col("size").alias(f"size_{c}")
    )
    # Pairs of one id come together: its set is made once in a task.
    both = likely.join(text("b").hint("merge"), "b").join(text("a").hint("merge"), "a")
    return written(both.mapInArrow(_compare(size, percent), "a long, b long").distinct(), "near-links")


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, band, id, component, main, n, n_out`` of the buckets of several
    components: ``main`` is the one of most members, ``n_out`` how many of all ``n``
    are outside it."""
    part = rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    part = written(part.select("key", "band", "id", "component"), "near-members")
    sizes = part.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
    most = F.max(F.struct("n", "component"))
    told = sizes.agg(F.sum("n").alias("n"), most.alias("most"), F.count(F.lit(1)).alias("several"))
    told = told.filter("several > 1").select(
        "key", F.col("most.component").alias("main"), "n", (F.col("n") - F.col("most.n")).alias("n_out")
    )
    return written(part.join(written(told, "near-mixed"), "key"), "near-unresolved")


def _blocks(rows: DataFrame, count: str, side: str, columns: list[str]) -> DataFrame:
    """A bucket's rows in blocks of about ``BLOCK``, dealt by hash."""
    dealt = F.pmod(F.xxhash64("id"), F.ceil(F.col(count) / BLOCK))
    packed_rows = F.collect_list(F.struct(*columns)).alias(side)
    return rows.groupBy("key", "band", "main", dealt.alias("block")).agg(packed_rows).drop("block")


def _opposed(members: DataFrame, columns: list[str]) -> DataFrame:
    """``key, band, main, x, y``: blocks of what is outside a bucket's main component
    beside blocks of all of it."""
    out = _blocks(members.filter("component <> main"), "n_out", "x", columns)
    every = _blocks(members, "n", "y", columns).drop("band", "main")
    pairs = out.join(every.hint("merge"), "key")
    # A few rows take long: they are spread over all tasks, not packed by their size.
    return pairs.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class _Block:
    def __init__(self, rows: pa.Array):
        self.rows = rows
        take = lambda c: rows.field(rows.type.get_field_index(c))
        self.id, self.component, self.n = (
            take(c).to_numpy(zero_copy_only=False) for c in ("id", "component", "n_shingles")
        )
        data = b"".join(take("registers").to_pylist())
        self.registers = np.frombuffer(data, np.uint8).reshape(-1, _M)


def _likely_across(x: _Block, y: _Block, main: int, band: int, percent: int):
    """Places in both blocks of the pairs to compare: of different components, of
    sizes and registers that allow it, in the first band that they share."""
    open_ = x.component[:, None] != y.component[None, :]
    open_ &= (y.component == main)[None, :] | (x.id[:, None] < y.id[None, :])
    n_x, n_y = x.n[:, None], y.n[None, :]
    open_ &= 100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y)
    i, j = np.nonzero(open_)
    if not len(i):
        return i, j
    same = x.registers[i] == y.registers[j]
    near = same.mean(1) >= percent / 100 - 2 * MARGIN
    i, j, same = i[near], j[near], same[near]
    bands, rows = banding(percent)
    first = same[:, : bands * rows].reshape(-1, bands, rows).all(2).argmax(1) == band
    i, j = i[first], j[first]
    likely = estimate(x.registers[i], y.registers[j], x.n[i].astype(float), y.n[j].astype(float))
    good = likely >= percent / 100 - MARGIN
    return i[good], j[good]


def _each_opposed(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for k in range(batch.num_rows):
            x, y = (_Block(batch.column(c)[k].values) for c in "xy")
            yield x, y, batch.column("main")[k].as_py(), batch.column("band")[k].as_py(), batch.column("key")[k].as_py()


def _ids_across(percent: int):
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, main, band, key in _each_opposed(batches):
            i, j = _likely_across(x, y, main, band, percent)
            if len(i):
                found = np.unique(np.concatenate([x.id[i], y.id[j]]))
                columns = [pa.array(np.full(len(found), key)), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "id"])

    return ids


def _links_across(size: int, percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, main, band, _ in _each_opposed(batches):
            i, j = _likely_across(x, y, main, band, percent)
            sets: list[dict[int, np.ndarray]] = [{}, {}]  # by place: an id may have several texts
            for known, block, places in zip(sets, (x, y), (i, j), strict=True):
                for k in np.unique(places).tolist():
                    row = block.rows[k]
                    raw = unpacked(row["packed"].as_py(), row["size"].as_py())
                    known[k] = _sets(raw, np.array([0, len(raw)]), size)[0]
            pairs = []
            for p, q in zip(i.tolist(), j.tolist(), strict=True):
                a, b, one, other = int(x.id[p]), int(y.id[q]), sets[0][p], sets[1][q]
                both = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(other) - both):
                    pairs.append((min(a, b), max(a, b)))
            if pairs:
                low, high = zip(*pairs, strict=True)
                columns = [pa.array(low, pa.int64()), pa.array(high, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return links


def _across(members: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int):
    """The links ``a < b`` between different components of one bucket.

    What is outside a bucket's main component meets the whole bucket, block by block
    and inside a task: no pair is written. By registers first, which leaves few ids
    whose texts are then brought and compared.
    """
    told = members.join(reps.hint("merge"), "id")
    columns = ["id", "component", "n_shingles", "registers"]
    needed = _opposed(told, columns).mapInArrow(_ids_across(percent), "key long, id long")
    needed = written(needed.distinct(), "near-needed")
    few = told.join(needed.hint("merge"), ["key", "id"])
    few = few.join(texts.withColumnRenamed("doc_id", "id").hint("merge"), "id")
    opposed = _opposed(few, [*columns, "packed", "size"])
    found = opposed.mapInArrow(_links_across(size, percent), "a long, b long").distinct()
    return written(found, "near-across")


def label(
    documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row per row.

    A null or empty text has no shingles and is linked with nothing, as is a row
    without id (its ``component_id`` is null; it is kept). Rows of one id are one
    node, whatever their texts. Equal texts are one class, however many. Other
    columns are left behind.
    """
    sketched = documents.select("doc_id", "text").mapInArrow(_sketch(size), SKETCH_DDL)
    sketched = written(sketched, "near-sketches")
    usable = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("d1", "d2").agg(F.min("doc_id").alias("id"))
    classes = written(classes, "near-classes")
    reps = usable.join(classes.hint("merge"), ["d1", "d2"]).filter("doc_id = id")
    reps = written(reps.select("id", "n_shingles", "registers").distinct(), "near-reps")

    n_bands, in_band = banding(percent)
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * in_band + 1, F.lit(in_band))),
    )
    bands = reps.select("id", F.posexplode(keys).alias("band", "key")).distinct()
    leads = bands.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n"))
    leads = written(leads.filter("n > 1").select("key", "a"), "near-leads")
    shared = written(bands.join(leads.hint("merge"), "key"), "near-buckets")
    members = shared.select("key", "band", "id")
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    texts = packed(documents.filter("doc_id IS NOT NULL")).join(ids.hint("merge"), "doc_id", "left_semi")
    texts = written(texts, "near-texts")
    stars = shared.filter("a < id").select("a", F.col("id").alias("b"))
    links = _verified(stars, reps, texts, size, percent)

    # Rows of one id with different texts: their classes are linked by the id.
    several = usable.select("doc_id", "d1", "d2").distinct().groupBy("doc_id")
    several = several.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    same = usable.join(several, "doc_id").join(classes, ["d1", "d2"]).select("doc_id", "id")
    links = links.union(same.filter("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")))

    labels = components(links)
    more = _across(_mixed(members, labels), reps, texts, size, percent)
    if not more.isEmpty():
        labels = components(links.union(more))

    of_class = classes.join(labels, "id", "left").select(
        "d1", "d2", F.coalesce("component", "id").alias("component_id")
    )
    of_class = written(of_class, "near-components")
    rows = sketched.select("doc_id", "n_shingles", "d1", "d2")
    found = rows.join(of_class.hint("merge"), ["d1", "d2"], "left").withColumn(
        "component_id",
        F.when(F.col("doc_id").isNull(), None)
        .when(F.col("n_shingles") == 0, F.col("doc_id"))
        .otherwise(F.least("component_id", "doc_id")),
    )
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents that are their component's smallest id, with all their columns;
    of rows alike in id, all."""
    dropped = label(documents, size, percent).filter("NOT kept").select("doc_id").distinct()
    return documents.join(dropped.hint("merge"), "doc_id", "left_anti")
