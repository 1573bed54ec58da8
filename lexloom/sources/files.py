"""Sources and sinks: manifests, result folders, NDJSON, CSV, chunked texts; ordered and typed outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """NDJSON with a declared schema, blank lines skipped; strict fails on a malformed line, else _corrupt keeps it."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    kept = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(kept).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, enums: dict[str, list[str]] | None = None) -> DataFrame:
    """CSV with a header and a declared schema; malformed rows and values outside an enum fail the query."""
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    for name, allowed in (enums or {}).items():
        message = F.concat(F.lit(f"{name}: "), F.coalesce(F.col(name), F.lit("null")))
        rows = rows.withColumn(name, F.when(F.col(name).isin(allowed), F.col(name)).otherwise(F.raise_error(message)))
    return rows


def read_results(spark: SparkSession, path: str, pattern: str, schema: T.StructType) -> DataFrame:
    """A folder of JSON results keyed by file name: key, status (parsed, parser-error, invalid-json), result."""
    texts = spark.read.text(path, wholetext=True).select("value", F.regexp_extract("_metadata.file_name", pattern, 1).alias("key")).filter("key <> ''")
    parsed = texts.withColumn("result", F.from_json("value", schema)).withColumn("_any", F.try_parse_json("value"))
    failed = F.get_json_object("value", "$.error").isNotNull() | F.get_json_object("value", "$.errors").isNotNull()
    status = F.when(F.col("_any").isNull(), "invalid-json").when(failed, "parser-error").otherwise("parsed")
    return parsed.select("key", status.alias("status"), F.when(status == "parsed", F.col("result")).alias("result"))


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files as path, sha256, length, content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "length", "modificationTime", "content")


def verify_pins(files: DataFrame, pins: DataFrame) -> DataFrame:
    """pins(path, sha256) with state: ok, changed or missing."""
    have = files.select("path", F.col("sha256").alias("actual"))
    return pins.join(have, "path", "left").withColumn("state", F.when(F.col("actual").isNull(), "missing").when(F.col("actual") == F.col("sha256"), "ok").otherwise("changed"))


def manifest_problems(documents: DataFrame) -> DataFrame:
    """(source_url, problem) of a manifest: duplicate sources, unknown kinds, missing hashes."""
    twice = documents.groupBy("source_url").agg(F.count("*").alias("n")).filter("n > 1").select("source_url", F.lit("duplicate").alias("problem"))
    kind = documents.filter(~F.coalesce(F.col("kind").isin("ors_chapter", "session_law"), F.lit(False))).select("source_url", F.lit("kind").alias("problem"))
    digest = documents.filter(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).select("source_url", F.lit("sha256").alias("problem"))
    return twice.union(kind).union(digest)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Text and XML chunks below a folder: file, citation, title, body; files without a citation are left out."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("file"))
    xml = F.lower("file").endswith(".xml")
    head = F.array_join(F.slice(F.split("value", "\n"), 1, 5), "\n")
    both = lambda tag: F.coalesce(*[F.nullif(F.regexp_extract("value", p, 1), F.lit("")) for p in (f"(?is)<[^>]*\\b{tag}=[\"']([^\"']+)[\"']", f"(?is)<{tag}>(.*?)</{tag}>")])
    named = lambda word: F.nullif(F.trim(F.regexp_extract(head, f"(?im)^{word}:\\s*(.+)$", 1)), F.lit(""))
    inline = F.nullif(F.regexp_extract("value", "\\b(\\d{1,4}[A-Z]?\\.\\d{3,4})\\b", 1), F.lit(""))
    citation = F.when(xml, both("citation")).otherwise(F.coalesce(named("citation"), inline))
    title = F.when(xml, both("title")).otherwise(named("title"))
    body = F.when(xml, F.trim(F.regexp_replace(F.regexp_extract("value", "(?is)<(?:body|text)>(.*?)</(?:body|text)>", 1), "<[^>]+>", ""))).otherwise(
        F.trim(F.regexp_replace("value", "(?im)^(?:citation|title):.*$\\n?", ""))
    )
    return files.filter(xml | F.lower("file").endswith(".txt")).select("file", citation.alias("citation"), title.alias("title"), body.alias("body")).filter("citation is not null and body <> ''")


def source_candidates(year: Column, number: Column, bases: list[tuple[int, int, str]]) -> Column:
    """Array of addresses for a year and number: the templates (with two %s) whose years cover it, in order."""
    each = [F.when((year >= low) & (year <= high), F.format_string(template, year.cast("string"), F.lpad(number.cast("string"), 4, "0"))) for low, high, template in bases]
    return F.array_compact(F.array(*each))


def write_ordered_parquet(df: DataFrame, path: str, key: list[str]) -> None:
    """Typed Parquet in key order; the folder appears with its commit (K1, K2)."""
    df.orderBy(*key).write.mode("errorifexists").parquet(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    """NDJSON with keys in order and nulls kept (K3)."""
    df.select(*sorted(df.columns)).write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV in a fixed column order, null as empty (K4)."""
    df.select(*columns).write.mode("errorifexists").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def read_csv_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV as write_csv leaves it; empty fields are null (K5)."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def write_index_shards(index: DataFrame, path: str) -> None:
    """An inverted index as JSON, one folder per shard (K6)."""
    index.write.mode("errorifexists").partitionBy("shard").json(path)


def snapshot_id(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order (K7): row hashes are summed, so nothing is sorted or gathered."""
    h = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    row = df.agg(F.count("*").alias("n"), F.sum(h).alias("h")).select(F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.coalesce(F.col("h").cast("string"), F.lit("0"))), 256)).first()
    return row[0]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of all tables (K9, A1)."""
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
