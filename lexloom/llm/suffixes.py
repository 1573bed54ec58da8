"""Passages repeated across documents, by exact runs of words around shared blocks.

Of a text's positions (by words) only minimisers stay at first: those whose run of ``GRAM`` words has the least
hash among WINDOW neighbouring positions. Any passage of min_words words that two texts share holds a common minimiser
so near its start that the block of min_words - WINDOW + 1 words from there lies inside the passage. Positions whose
block occurs in one text only are dropped by a count. Of the others, every run of min_words words that holds the block
becomes a key of its own, and the runs whose key two texts have are the repeated ones: no run of a repeated passage is
missed, none that is not repeated counts. What a text's runs cover is merged into its repeated passages.

Scale: exact copies are one text from the start. Counting is summed before the shuffle; the joins with the repeated
keys have plain exchanges on both sides, so a hot key splits. No pairs of texts are made, so neither a passage that
many texts share nor one that a text repeats costs more than its rows, and every word of every text counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm._shared import small_batches, table, written

MIN_WORDS = 50
WINDOW = 16
GRAM = 8
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)


def word_hashes(text: bytes | None) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in (text or b"").split()], dtype=np.uint64)


def _sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of word hashes times powers, and the inverse powers; run hashes follow by subtraction."""
    n = len(words)
    up, down = np.full(n, _P, dtype=np.uint64), np.full(n + 1, _P_INVERSE, dtype=np.uint64)
    down[0] = 1
    if n:
        up[0] = 1
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * np.cumprod(up))]), np.cumprod(down)


def _runs(sums: tuple[np.ndarray, np.ndarray], at: np.ndarray, size: int) -> np.ndarray:
    """Mixed hashes of the runs of ``size`` words from each position."""
    total, down = sums
    x = (total[at + size] - total[at]) * down[at]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def anchors(words: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser positions whose block fits into the text, and the blocks' hashes (signed)."""
    block = min_words - WINDOW + 1
    if len(words) < min_words:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    sums = _sums(words)
    grams = _runs(sums, np.arange(len(words) - GRAM + 1), GRAM)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    at = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    at = at[at + block <= len(words)]
    return at, _runs(sums, at, block).view(np.int64)


def _anchor_batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rids = batch.column(1).cast(pa.binary()), batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(rids), 500):
                found = [anchors(word_hashes(x.as_py()), min_words) for x in texts[start : start + 500]]
                sizes = [len(at) for at, _ in found]
                at, keys = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rids[start : start + 500], sizes)), pa.array(at.astype(np.int32)), pa.array(keys)], names=["rid", "pos", "key"])

    return run


def runs_at(words: np.ndarray, at: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts of every run of min_words words that holds the block from one of the positions, and the runs' hashes."""
    starts = np.unique(at[:, None] - np.arange(WINDOW))
    starts = starts[(starts >= 0) & (starts + min_words <= len(words))]
    return starts, _runs(_sums(words), starts, min_words).view(np.int64)


def _run_batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rids = batch.column(1).cast(pa.binary()), batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(rids), 100):
                found = [runs_at(word_hashes(x.as_py()), at.values.to_numpy().astype(np.int64), min_words) for x, at in zip(texts[i : i + 100], batch.column(2)[i : i + 100], strict=True)]
                starts, keys = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rids[i : i + 100], [len(x) for x, _ in found])), pa.array(starts.astype(np.int32)), pa.array(keys)], names=["rid", "start", "key"])

    return run


def merge_spans(spans: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """Unions of overlapping spans that are min_words long at least."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out if b - a >= min_words]


def _merge_udf(min_words: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
    def merge(starts: pa.Array) -> pa.Array:
        rows = (merge_spans([(x, x + min_words) for x in s.as_py()], min_words) for s in starts)
        return pa.array(([{"start": a, "end": b} for a, b in r] for r in rows), kind)

    return merge


def _of_two_texts(rows: DataFrame, name: str) -> DataFrame:
    """The keys of rows(key, rid, ...) that more than one text has."""
    return written(rows.groupBy("key").agg(F.min("rid").alias("a"), F.max("rid").alias("b")).filter("a <> b").select("key"), name)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_words, copies, spans (array of struct start, end in words).

    A span is a passage of min_words words or more that another text has too; of texts that several rows share, which
    ``copies`` counts, all words are one. Repeats within one text alone do not count. Words are runs of characters
    other than ASCII white space, compared byte by byte. Null and empty texts have no spans; null ids and extra
    columns are harmless; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.xxhash64("text"))
    found = texts.select("rid", "text").mapInArrow(_anchor_batches(min_words), "rid long, pos int, key long")
    found = written(found, "suffix-anchors")
    kept = found.join(_of_two_texts(found, "suffix-keys"), "key").groupBy("rid").agg(F.collect_set("pos").alias("kept"))
    kept = written(kept, "suffix-kept")
    # copies meet in one row before the shuffle
    once = texts.groupBy("rid").agg(F.first("text").alias("text"))
    runs = once.join(kept, "rid").select("rid", "text", "kept").mapInArrow(_run_batches(min_words), "rid long, start int, key long")
    runs = written(runs, "suffix-runs")
    merged = runs.join(_of_two_texts(runs, "suffix-shared"), "key").groupBy("rid").agg(F.collect_set("start").alias("all"))
    merged = merged.select("rid", _merge_udf(min_words)("all").alias("spans"))
    sized = written(texts.select("doc_id", "rid", F.regexp_count("text", F.lit("[^ \\t-\\r]+")).cast("long").alias("n_words")), "suffix-docs")
    copies = sized.groupBy("rid").agg(F.count("*").alias("copies"))
    known = written(copies.join(merged, "rid", "left"), "suffix-known")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans_of = F.when((F.col("copies") > 1) & (F.col("n_words") >= min_words), whole).otherwise(F.coalesce("spans", none))
    return sized.join(known, "rid").select("doc_id", "n_words", "copies", spans_of.alias("spans"))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its passages of 50 words or more that other documents have too."""
    found = repeated_passages(table(spark, sf_dir, "documents"))
    width = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    printed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_words", "copies", F.size("spans").cast("long").alias("n_spans"), width.alias("repeated_words"), printed.alias("spans"))
