import math

import numpy as np
from pyspark.sql import functions as F

from lexloom.llm import vafile


def slow(vectors, k):
    out = []
    for row, (q, a) in enumerate(vectors):
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), v) for other, (v, b) in enumerate(vectors) if other != row]
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_equals_brute_force_in_blocks_with_ties(spark):
    rng = np.random.default_rng(3)
    data = [(i, [math.floor(64 * x) for x in rng.normal(size=8)]) for i in range(150)]
    data += [(150 + i, data[20][1]) for i in range(30)] + [data[20], data[40], data[40], (60, data[3][1])]
    data += [(200 + i, [int(x) for x in rng.normal(size=8) * 1e6]) for i in range(30)]
    frame = spark.createDataFrame(data, "vec_id long, v array<long>")
    got = vafile.top_k(frame, F.col("vec_id") % 20 == 0, 7, candidate_rows=40, query_rows=3)
    assert sorted(map(tuple, got.collect())) == slow(data, 7)


def test_bounds_hold_for_wide_and_narrow_ranges():
    rng = np.random.default_rng(4)
    for scale in (3, 100, 10**7):
        vectors, queries = rng.integers(-scale, scale, (200, 9)), rng.integers(-scale, scale, (20, 9))
        lower, upper = vafile.bounds(queries, *vafile.packed(vectors))
        exact = queries @ vectors.T
        assert (lower <= exact).all() and (exact <= upper).all()
        # cells of one value need no exact vectors to be told apart
        assert scale > 100 or np.allclose(lower, upper, atol=0.01)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0], 5), (1, [0.5], 5), (2, None, 5), (3, [float("nan"), 1.0], 5), (4, [None, 1.0], 5), (20, [], 5), (5, [float("inf")], 5), (6, [0.5], 5), (None, [1.0], 5)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").createOrReplaceTempView("v")
    usable = spark.table("v").filter(vafile._usable(F.col("embedding")))
    vectors = usable.select("vec_id", vafile.integers(F.col("embedding")).alias("v"))
    got = {tuple(r) for r in vafile.top_k(vectors, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1, 1, 2048), (0, 2, 6, 2048), (0, 3, 20, 0), (20, 1, 0, 0), (20, 2, 1, 0), (20, 3, 6, 0)}
    assert vafile.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
