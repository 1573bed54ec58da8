import numpy as np
import pytest
import xxhash

from lexloom.llm import simhash, similar
from lexloom.llm.components import connected_components
from tests.llm.cases import frame, rows


def slow_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_the_slow_definition():
    for r in rows():
        if len(r[1] or "") < 3000:
            assert simhash.fingerprint_of((r[1] or "").encode()) == slow_fingerprint(r[1])


def test_fingerprint_of_spark_hash(spark):
    text = "one two three four"
    assert spark.sql(f"select xxhash64('{text}') h").first().h % (1 << 64) == simhash.fingerprint_of(text.encode())


@pytest.mark.parametrize("radius", [2, 4, 6])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = np.random.default_rng(1)
    for turn in (0, 1):
        masks = simhash.covering_masks(radius, turn)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(300):
            flips = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert any(m & flips == 0 for m in masks)


@pytest.mark.parametrize("limit", [4096, 2])
def test_groups_equal_brute_force(spark, limit):
    got = {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in simhash.near_duplicates(frame(spark), bucket_limit=limit).collect()}
    known = {r[0]: simhash.fingerprint_of((r[1] or "").encode()) for r in rows() if r[0] is not None}
    want = components(list(known), lambda a, b: (known[a] ^ known[b]).bit_count() <= 4)
    assert {k[0]: v for k, v in got.items() if k[0] is not None} == want


def test_repeated_rows_stay_and_empty_tables_work(spark):
    assert simhash.near_duplicates(frame(spark)).count() == len(rows())
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert similar.deduplicate(frame(spark, [])).count() == 0


def test_deduplicate_keeps_one_of_each_group(spark):
    kept = similar.deduplicate(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and not set(ids) & {6, 7, 8, 9, 10, 11}
    assert {3, 4, *range(12, 38)} <= set(ids)


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (500, 499), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {x: 100 for x in range(100, 160)} | {500: 499, 499: 499}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
