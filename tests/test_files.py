"""Sources and sinks on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.sources import files

ROW = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])


def test_ndjson_and_csv_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", None), (None, 3)], ROW)
    files.write_ndjson(df, f"{tmp_path}/j")
    assert files.read_ndjson(spark, f"{tmp_path}/j", ROW).exceptAll(df).count() == 0
    files.write_csv(df, f"{tmp_path}/c", ["n", "a"])
    back = files.read_csv_back(spark, f"{tmp_path}/c", T.StructType([ROW["n"], ROW["a"]]))
    assert back.select("a", "n").exceptAll(df).count() == 0
    files.write_ordered_parquet(df, f"{tmp_path}/p", ["n"])
    assert files.snapshot_id(spark.read.parquet(f"{tmp_path}/p")) == files.snapshot_id(df.repartition(3)) != files.snapshot_id(df.limit(1))


def test_malformed_rows(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": "x", "n": 1}\n\n{bad\n')
    with pytest.raises(Exception):
        files.read_ndjson(spark, f"{tmp_path}/x.json", ROW).collect()
    assert [r._corrupt for r in files.read_ndjson(spark, f"{tmp_path}/x.json", ROW, strict=False).collect()] == [None, "{bad"]
    (tmp_path / "x.csv").write_text("a,n\nx,1\nz,2\n")
    assert files.read_csv(spark, f"{tmp_path}/x.csv", ROW, {"a": ["x", "z"]}).count() == 2
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_path}/x.csv", ROW, {"a": ["x"]}).collect()


def test_results_chunks_and_pins(spark, tmp_path):
    folder = tmp_path / "r"
    folder.mkdir()
    for name, content in (("2023-12.json", json.dumps({"a": "x"})), ("2023-13.json", json.dumps({"error": "no"})), ("2023-14.json", "{"), ("other.txt", "{}")):
        (folder / name).write_text(content)
    got = {r.key: (r.status, r.result and r.result.a) for r in files.read_results(spark, str(folder), r"^2023-(\d+)\.json$", ROW).collect()}
    assert got == {"12": ("parsed", "x"), "13": ("parser-error", None), "14": ("invalid-json", None)}
    chunks = tmp_path / "c" / "deep"
    chunks.mkdir(parents=True)
    (chunks / "a.txt").write_text("CITATION: 1.005\nTitle: T\nBody here")
    (chunks / "b.xml").write_text('<s citation="2.010"><title>X</title><text>Some <i>text</i></text></s>')
    (chunks / "c.txt").write_text("nothing")
    assert {(r.citation, r.title, r.body) for r in files.read_chunks(spark, str(tmp_path / "c")).collect()} == {("1.005", "T", "Body here"), ("2.010", "X", "Some text")}
    have = files.read_binary(spark, str(chunks), "*.txt")
    pins = have.select("path", F.when(F.col("path").endswith("a.txt"), F.col("sha256")).otherwise("0").alias("sha256")).union(spark.createDataFrame([("gone", "0")], "path string, sha256 string"))
    assert {r.state for r in files.verify_pins(have, pins).collect()} == {"ok", "changed", "missing"}


def test_manifest_and_candidates(spark):
    documents = spark.createDataFrame([("u", "ors_chapter", "a" * 64), ("u", "session_law", "a" * 64), ("v", "other", None)], "source_url string, kind string, sha256 string")
    assert {tuple(r) for r in files.manifest_problems(documents).collect()} == {("u", "duplicate"), ("v", "kind"), ("v", "sha256")}
    got = spark.createDataFrame([(2003, 12)], "y int, n int").select(files.source_candidates(F.col("y"), F.col("n"), [(1999, 2005, "a/%s/%s.pdf"), (2004, 2030, "b/%s/%s"), (2000, 2003, "c/%s-%s")]).alias("c")).first()
    assert got.c == ["a/2003/0012.pdf", "c/2003-0012"]
