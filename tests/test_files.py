"""Files of a size worth reading: closed days written again behind a view."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txrisk.plans import files
from txrisk.plans.days import DAY
from txrisk.plans.files import add_batch, close_days

TARGET = 6000


def batch(spark, number: int, days: int = 4, rows: int = 400):
    """Rows of all days and of no day, scattered over tasks; some wholly alike."""
    return spark.range(rows).repartition(5).selectExpr(
        f"if(id % 10 = 0, -1, id * 100 + {number}) AS event_id",
        "if(id % 10 = 0, 'same', sha2(concat('x', id), 256)) AS note",
        f"if(id % 50 = 3, NULL, timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(id % {days} AS INT))) AS event_ts",
    )


def rows_in(df):
    return sorted(map(str, df.select("event_id", "note", "event_ts").collect()))


def files_of(folder: Path, day: str) -> list[Path]:
    return sorted(folder.glob(f"batch=*/{DAY}={day}/*.parquet"))


def test_small_files_become_few_of_the_wanted_size(spark, tmp_path, table):
    root, want = tmp_path / "root", []
    for n in range(6):
        add_batch(batch(spark, n), n, table, str(root))
        add_batch(batch(spark, n), n, table, str(root))  # handed over again
        want += rows_in(batch(spark, n))
    small = {d: files_of(root / "open", d) for d in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04")}
    sizes = {d: sum(f.stat().st_size for f in found) for d, found in small.items()}
    assert all(len(found) == 6 for found in small.values())  # a file per batch and day
    close_days(spark, table, str(root), 5, dt.date(2024, 1, 3), TARGET)
    for day in ("2024-01-01", "2024-01-02"):
        made = files_of(root / "closed", day)
        assert 1 < len(made) == math.ceil(sizes[day] / TARGET) < 60
    assert not files_of(root / "closed", "2024-01-03")
    assert rows_in(spark.read.table(table)) == sorted(want)
    # A reader that began before still finds the small files; the next closing deletes them.
    assert files_of(root / "open", "2024-01-01") == small["2024-01-01"]
    close_days(spark, table, str(root), 5, dt.date(2024, 1, 3), TARGET)
    assert not files_of(root / "open", "2024-01-01") and files_of(root / "open", "2024-01-03")
    assert rows_in(spark.read.table(table)) == sorted(want)


def test_late_rows_of_closed_days_are_open_until_the_next_time(spark, tmp_path, table):
    root, want = str(tmp_path / "root"), []
    for n in range(8):
        add_batch(batch(spark, n), n, table, root)
        want += rows_in(batch(spark, n))
        assert rows_in(spark.read.table(table)) == sorted(want)
        if n % 3 == 2:
            written = {f: f.stat().st_mtime_ns for f in (tmp_path / "root" / "closed").rglob("*.parquet")}
            close_days(spark, table, root, n, dt.date(2024, 1, 2 + n // 3), 1 << 20)
            assert rows_in(spark.read.table(table)) == sorted(want)
            assert all(f.stat().st_mtime_ns == at for f, at in written.items())  # once written, left alone
    assert len(files_of(tmp_path / "root" / "closed", "2024-01-01")) == 2
    add_batch(batch(spark, 1), 1, table, root)  # closed long ago
    assert rows_in(spark.read.table(table)) == sorted(want)


@pytest.mark.parametrize("dies_at", ["_write", "_publish"])
def test_a_closing_that_dies_shows_nothing(spark, tmp_path, table, monkeypatch, dies_at):
    root, want = str(tmp_path / "root"), []
    for n in range(2):
        add_batch(batch(spark, n), n, table, root)
        want += rows_in(batch(spark, n))
    real = getattr(files, dies_at)

    def dies(*args):
        if dies_at == "_write":
            real(args[0].filter(F.col(DAY) == "2024-01-01"), *args[1:])  # some of the days only
        raise OSError("lost")

    monkeypatch.setattr(files, dies_at, dies)
    with pytest.raises(OSError, match="lost"):
        close_days(spark, table, root, 1, dt.date(2024, 1, 4), TARGET)
    monkeypatch.undo()
    assert rows_in(spark.read.table(table)) == sorted(want)
    assert files_of(tmp_path / "root" / "closed", "2024-01-01")
    add_batch(batch(spark, 2), 2, table, root)
    want += rows_in(batch(spark, 2))
    close_days(spark, table, root, 2, dt.date(2024, 1, 2), TARGET)  # another mark than before
    assert rows_in(spark.read.table(table)) == sorted(want)


def test_marks_never_go_back_and_empty_tables_close(spark, tmp_path, table):
    root = str(tmp_path / "root")
    add_batch(batch(spark, 0).limit(0), 0, table, root)
    close_days(spark, table, root, 0, dt.date(2024, 1, 9))
    assert spark.read.table(table).count() == 0
    add_batch(batch(spark, 1), 1, table, root)
    close_days(spark, table, root, 1, dt.date(2024, 1, 2))
    assert rows_in(spark.read.table(table)) == rows_in(batch(spark, 1))
    assert files._closed_until(spark, table) == (1, dt.date(2024, 1, 9))


def test_a_day_is_read_from_its_folders(spark, tmp_path, table):
    root = str(tmp_path / "root")
    for n in range(3):
        add_batch(batch(spark, n), n, table, root)
    close_days(spark, table, root, 1, dt.date(2024, 1, 3), 1 << 20)
    one = spark.read.table(table).filter(F.col(DAY) == "2024-01-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PushedFilters: []" in plan
    assert one.count() == sum(batch(spark, n).filter("to_date(event_ts) = '2024-01-02'").count() for n in range(3))
    # Two small files of the batch that is open, and one large file.
    assert len(one.inputFiles()) >= 1
