from __future__ import annotations

import duckdb
import pytest

from airstrata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "labels", "embeddings", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda frame: sorted(map(repr, frame[columns].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
