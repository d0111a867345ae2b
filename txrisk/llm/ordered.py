"""Work on groups that come sorted, with a task holding no more than it must."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def turn_key(role: str = "role", text: str = "text") -> Column:
    """16 bytes that stand for a role and a text."""
    both = F.concat(F.length(role), F.lit(":"), F.col(role), F.col(text))
    return F.unhex(F.substring(F.sha2(both.cast("binary"), 256), 1, 32))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of one key, together: for groups of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_pylist()
        at = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[at]:
                if held and held[-1].column(key)[0].as_py() != keys[at]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(at, k - at))
                at = k
    if held:
        yield pa.Table.from_batches(held)


def sha256_in_order(pieces: DataFrame, key: str, order: str, value: str, between: str) -> DataFrame:
    """``key, sha256`` of each key's strings, joined in order. A string is hashed and
    forgotten, so that a key may have any number of them; a null key is one, too."""
    kind = pieces.schema[key].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running, keys, found = None, None, [], []
        for batch in batches:
            for one, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if running is not None and one == last:
                    running.update(between.encode())
                else:
                    if running is not None:
                        keys.append(last)
                        found.append(running.hexdigest())
                    last, running = one, hashlib.sha256()
                running.update(text.encode())
            if len(found) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(found)], names=[key, "sha256"])
                keys, found = [], []
        if running is not None:
            types = batch.schema.field(0).type
            yield pa.RecordBatch.from_arrays(
                [pa.array([*keys, last], types), pa.array([*found, running.hexdigest()])], names=[key, "sha256"]
            )

    rows = pieces.select(key, F.col(value).alias("_value"), F.col(order).alias("_order"))
    rows = rows.repartition(key).sortWithinPartitions(key, "_order").select(key, "_value")
    return rows.mapInArrow(hashed, f"{key} {kind}, sha256 string")
