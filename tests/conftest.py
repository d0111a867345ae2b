"""One local session for all tests, and a way to play rows as micro-batches."""

from __future__ import annotations

import os
import sys
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table() -> str:
    return f"t_{uuid.uuid4().hex[:12]}"


@pytest.fixture
def play(spark, tmp_path):
    """``play(batches, transform)``: feed each DataFrame as one micro-batch through
    ``transform`` and return ``(rows out, progress of every batch)``."""

    def run(batches: list[DataFrame], transform) -> tuple[DataFrame, list]:
        source, out = tmp_path / "in", tmp_path / f"out-{uuid.uuid4().hex[:6]}"
        if not source.exists():
            source.mkdir()
            for n, batch in enumerate(batches):
                part = tmp_path / f"part-{n}"
                batch.coalesce(1).write.parquet(str(part))
                (file,) = part.glob("*.parquet")
                target = source / f"{n:03d}.parquet"
                file.rename(target)
                stamp = time.time() - 1000 + n * 10
                os.utime(target, (stamp, stamp))
        stream = (
            spark.readStream.schema(batches[0].schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(str(source))
        )
        query = (
            transform(stream)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(out) + ".checkpoint")
            .trigger(availableNow=True)
            .start(str(out))
        )
        query.awaitTermination()
        return spark.read.parquet(str(out)), query.recentProgress

    return run
