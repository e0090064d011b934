"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows):
    """In a fixed order, with NaN, which equals nothing, as a mark that equals itself."""
    marked = [tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in r) for r in rows]
    return sorted(marked)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    assert rows
    if name not in entry.oracle_sql():
        return
    answer = duck.sql(entry.oracle_sql()[name])
    assert sorted(answer.columns) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == {
        c: str(t) for c, t in zip(answer.columns, answer.types)
    }
    expected = answer.select(*[f'"{c}"' for c in columns]).fetchall()
    assert _sorted(rows) == _sorted(expected)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
