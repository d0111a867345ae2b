"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES

SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def _sorted_rows(names, order, rows):
    at = [names.index(n) for n in order]
    return sorted(tuple(_text(row[i]) for i in at) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.collect()
    want = duck.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    kinds = {c[0]: str(c[1]) for c in want.description}
    rows = want.fetchall()
    assert {n: SPARK_TO_DUCKDB[k] for n, k in df.dtypes} == kinds
    order = sorted(names)
    assert rows
    assert _sorted_rows(df.columns, order, got) == _sorted_rows(names, order, rows)


def test_entry(spark):
    df = contract.entry(spark)
    assert "suspicious_rate_pct" in df.columns
    assert df.count() > 0
