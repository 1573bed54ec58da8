"""The training-data queries that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from lexloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    got = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]}) AS oracle").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want))


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 11)] and set(queries.ORACLES) <= set(queries.QUERIES)
