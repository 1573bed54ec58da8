"""Exact top-k by inner product with vector-approximation files.

Candidates are cut into blocks; a block's file holds, packed, one cell number (a byte) per component of each vector.
Queries scan the files first: the cells give an upper and a lower bound of every inner product (one product with the
cell numbers), and of each block only candidates stay whose upper bound reaches the k-th greatest lower bound. Exact
vectors are then read in the order of the bounds, in two rounds: those of each query's k greatest upper bounds give a
k-th exact score; the second round reads just the candidates whose upper bound reaches that score. No other candidate
can be among the k best, so the result is exact.

Scale: scans ship files (a byte per component) and queries, never exact vectors; a task sees one block of each. Of
candidates that stay, those below the k-th greatest lower bound over all blocks go before any exact vector is read.
Exact vectors are joined by row number, each row once per query that still needs it, and scored by SQL expressions.
Work is queries times cells, as exact search without a metric index must be in the worst case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm._shared import scratch, table, written

CELLS = 256
CANDIDATES, QUERIES, CHUNK = 16384, 2048, 128


def integers(vector: Column) -> Column:
    """floor(64 * x) of each component as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 64))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _dense(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column as int64, short ones filled with zeros."""
    array = lists.combine_chunks()
    ends = array.offsets.to_numpy()
    values = array.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    if len(sizes) and (sizes == dim).all():
        return values[ends[0] : ends[-1]].reshape(-1, dim)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        out[i, : b - a] = values[a:b]
    return out


def packed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a block of integer vectors, with each component's least value and number of values in a cell."""
    low = vectors.min(axis=0)
    step = np.maximum((vectors.max(axis=0).astype(object) - low) // CELLS + 1, 1).astype(np.float64)
    return ((vectors - low).astype(np.float64) // step).clip(0, CELLS - 1).astype(np.uint8), low, step


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of queries (rows) with the cells' vectors (columns)."""
    asked, least = queries.astype(np.float64), low.astype(np.float64)
    weighted = asked * step
    base = weighted @ cells.T.astype(np.float64) + (asked @ least)[:, None]
    inside = asked * (step - 1)  # a cell's values reach step - 1 above its least
    slack = 1e-9 * (1 + np.abs(asked) @ np.maximum(np.abs(least), np.abs(least + CELLS * step)))
    return base + (np.minimum(inside, 0).sum(axis=1) - slack)[:, None], base + (np.maximum(inside, 0).sum(axis=1) + slack)[:, None]


def _pack_block(dim: int):
    def run(block: pa.Table) -> pa.Table:
        cells, low, step = packed(_dense(block.column("v"), dim))
        fields = {"rids": block.column("rid").to_numpy().astype("<i8"), "cells": cells, "low": low, "step": step}
        return pa.table({"c": block.column("c")[:1].cast(pa.int64())} | {k: pa.array([x.tobytes()], pa.binary()) for k, x in fields.items()})

    return run


def _scan_blocks(k: int, dim: int):
    def run(files: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        asked, own = (_dense(queries.column("v"), dim), queries.column("rid").to_numpy()) if queries.num_rows else (None, ())
        for file in files.to_pylist():
            rids, low, step = (np.frombuffer(file[n], dtype=t) for n, t in (("rids", "<i8"), ("low", np.int64), ("step", np.float64)))
            cells = np.frombuffer(file["cells"], dtype=np.uint8).reshape(len(rids), dim)
            for start in range(0, len(own), CHUNK):
                me = own[start : start + CHUNK]
                lower, upper = bounds(asked[start : start + CHUNK], cells, low, step)
                lower[rids == me[:, None]] = upper[rids == me[:, None]] = -np.inf
                floor = np.partition(lower, -k, axis=1)[:, -k] if len(rids) > k else np.full(len(me), -np.inf)
                i, j = np.nonzero((upper >= floor[:, None]) & (rids != me[:, None]))
                for x, y in zip(out, (me[i], rids[j], lower[i, j], upper[i, j]), strict=True):
                    x.append(y)
        kinds = (np.int64, np.int64, np.float64, np.float64)
        return pa.table({n: pa.array(np.concatenate(x) if x else np.empty(0, t)) for n, x, t in zip(("query", "rid", "lower", "upper"), out, kinds, strict=True)})

    return run


def _blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _times(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _scored(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """pairs(query, rid, ...) with the candidate's vec_id and the exact score."""
    left = vectors.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
    products = F.zip_with("qv", "v", lambda x, y: F.coalesce(x, F.lit(0)) * F.coalesce(y, F.lit(0)))
    score = F.aggregate(products, F.lit(0).cast("long"), lambda total, x: total + x)
    return pairs.join(vectors, "rid").join(left, "query").select(*pairs.columns, "query_id", "vec_id", score.alias("score"))


def _greatest(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The k rows of each query with the greatest ``by``; a rank filter, so few rows are shuffled."""
    order = Window.partitionBy("query").orderBy(F.col(by).desc(), "rid")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_k(vectors: DataFrame, asked: Column, k: int = 20, candidate_rows: int = CANDIDATES, query_rows: int = QUERIES) -> DataFrame:
    """vectors(vec_id, v), v arrays of longs, queries being the rows where ``asked`` holds -> query_id, rank, vec_id, score.

    Candidates of a query are all rows but its own, whatever their ids, so repeated rows are candidates of each other
    and a query id that several rows hold is answered once for each. Vectors of unequal lengths count as filled up with
    zeros. Rows whose vec_id or v is null take no part. Scores must fit a long. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    with scratch(spark):
        shown = vectors.filter("vec_id is not null and v is not null").select("vec_id", F.col("v").cast("array<bigint>").alias("v"), asked.alias("asked"))
        # row numbers of a written table are the same in every run of a task
        shown = written(shown, "va-rows")
        shown = written(shown.withColumn("rid", F.monotonically_increasing_id()), "va-vectors")
        exact, queries = shown.select("rid", "vec_id", "v"), shown.filter("asked").select("rid", "v")
        size = shown.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("asked").cast("int")), F.lit(0)).alias("q"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dim")).first()
        n_blocks, q_blocks, dim = _blocks(size["n"], candidate_rows), _blocks(size["q"], query_rows), max(1, size["dim"])
        dealt = exact.select(F.pmod(F.xxhash64("rid"), F.lit(n_blocks)).alias("c"), "rid", "v")
        files = written(dealt.groupBy("c").applyInArrow(_pack_block(dim), "c long, rids binary, cells binary, low binary, step binary"), "va-files")
        left = files.withColumn("q", _times(q_blocks))
        right = queries.withColumn("q", F.pmod(F.xxhash64("rid"), F.lit(q_blocks))).withColumn("c", _times(n_blocks))
        found = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(_scan_blocks(k, dim), "query long, rid long, lower double, upper double")
        found = written(found, "va-found")
        # the k-th greatest lower bound over all blocks; -inf for queries with fewer candidates
        floors = _greatest(found, "lower", k).groupBy("query").agg(F.when(F.count("*") == k, F.min("lower")).otherwise(F.lit(float("-inf"))).alias("floor"))
        left_over = written(found.join(floors, "query").filter("upper >= floor").select("query", "rid", "upper"), "va-left")
        first = written(_scored(_greatest(left_over, "upper", k).select("query", "rid"), exact), "va-first")
        known = first.groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
        rest = left_over.join(first.select("query", "rid"), ["query", "rid"], "left_anti").join(known, "query")
        second = _scored(rest.filter("kth is null or upper >= kth").select("query", "rid"), exact)
        both = written(first.unionByName(second), "va-scored", keep=True)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_top_k(spark, sf_dir: str) -> DataFrame:
    """The 20 best other vectors for every twentieth vector id, by integer inner product."""
    usable = table(spark, sf_dir, "embeddings").filter(_usable(F.col("embedding")))
    vectors = usable.select("vec_id", integers(F.col("embedding")).alias("v"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


OP4_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id IS NOT NULL AND q.rid <> c.rid
)
SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
