"""Every table query against its DuckDB equivalent on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lexloom.functions import text
from lexloom.plans import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def plain(rows):
    return sorted(tuple(str(None if x != x else (int(x) if isinstance(x, float) and x.is_integer() else x)) for x in row) for row in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]}) AS oracle").fetchall()
    assert plain(tuple(r) for r in got.select(*columns).collect()) == plain(want)


def test_odd_texts_are_cleaned_as_in_sql(spark, tmp_path):
    spaces = [" ", "\u00a0", "\u1680", "\u2003", "\u202f", "\u3000"]
    texts = [None, "", " ", ".", ". ", ". a", " . a", "a.", "a. b", "a\n", "a.\n", "\n", "a\u0085", "a\u200b", "\ufeffa", "a\x00", "\t. a", "é", "😀", "x12 345\u00a06", "٣٤٥"]
    texts += ["a-\nb", "a-\nb-\nc", "a-\nb-\nc-\nd", "Ab-\ncd-\nef", "a-\n-\nb", "é-\na", "a-\nB", "a-\r\nb"] + spaces + [x + "a" + x for x in spaces] + [x + ". a" for x in spaces]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = registry.QUERIES["text_cleaned"](spark, str(tmp_path))
    want = connection.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLES['text_cleaned']}) AS oracle ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == want
    repaired = spark.createDataFrame([("a-\nb-\nc",)], "t string").select(text.hyphens_repaired(F.col("t")), text.hyphens_repaired(F.col("t"), shared=False))
    assert tuple(repaired.first()) == ("abc", "ab-\nc")


def test_long_chains_and_cycles(spark):
    from lexloom.operators import relational

    chain = [(i, i - 1 if i else None) for i in range(5000)] + [(9001, 9002), (9002, 9003), (9003, 9001), (8000, 7999), (7000, None)]
    got = {r.node: (r.root, r.depth) for r in relational.chain_depths(spark.createDataFrame(chain, "n long, p long"), "n", "p", spark).collect()}
    assert got == {i: (0, i) for i in range(5000)} | {7000: (7000, 0)}
