import hashlib

import xxhash
from pyspark.sql import functions as F

from lexloom.llm import fingerprint
from tests.llm.cases import frame, prose, rows


def ordered(some):
    tie = lambda text: xxhash.xxh64_intdigest((text or "").encode(), 42)
    return sorted(some, key=lambda r: (r[0] is None, -(r[0] or 0), -(tie(r[1]) ^ 1 << 63), r[1] or ""))


def test_edited_texts_equal_the_slow_definition_for_any_ranges(spark):
    some = ordered(rows())
    want = []
    for i, r in enumerate(some):
        text, after = r[1] or "", some[(i + 1) % len(some)][1] or ""
        third = len(text) // 3
        want.append((r[0], len(text), hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()))
    got = fingerprint.edited_fingerprints(frame(spark).repartition(3)).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    for n in (1, 2, 50):
        led = fingerprint.with_next(frame(spark).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"], ranges=n).collect()
        assert sorted((str(r.doc_id), r.text, r.next_text) for r in led) == sorted((str(r[0]), r[1] or "", some[(i + 1) % len(some)][1] or "") for i, r in enumerate(some))


def test_likeness_follows_the_exact_similarity(spark):
    import random

    rng = random.Random(2)
    a, b = prose(rng, 3000).split(), prose(rng, 3000).split()
    frame = spark.createDataFrame([(" ".join(a), " ".join(a[:cut] + b[cut:])) for cut in (0, 1000, 2000, 3000)], "a string, b string")
    frame = fingerprint.with_sketch(fingerprint.with_sketch(frame, "a", "x"), "b", "y")
    got = frame.select(fingerprint.similarity(F.col("x"), F.col("y")).alias("s"), fingerprint.containment(F.col("x"), F.col("y")).alias("c")).collect()
    for r, cut in zip(got, (0, 1000, 2000, 3000)):
        share = cut / 3000
        assert abs(r.c - share) < 0.06 and abs(r.s - share / (2 - share)) < 0.06


def test_short_texts_copies_and_merges(spark):
    frame = fingerprint.with_sketch(spark.createDataFrame([("one two",), ("one two",), ("",), (None,), ("one three",)], "t string"), "t", "s")
    prints = [r[0] for r in frame.select(fingerprint.printed(F.col("s"))).collect()]
    assert prints[0] == prints[1] != prints[4] and prints[2] == prints[3]
    pair = frame.filter("t = 'one two'").limit(1).select(F.col("s").alias("x")).crossJoin(frame.filter("t = 'one three'").select(F.col("s").alias("y")))
    row = pair.select(F.size(fingerprint.merged(F.col("x"), F.col("y"))["hashes"]).alias("n"), fingerprint.similarity(F.col("x"), F.col("y")).alias("s")).first()
    assert row.n <= 2 and row.s == 0.0


def test_sketches_keep_the_same_fraction_of_every_length(spark):
    import random

    rng = random.Random(5)
    texts = [(prose(rng, n),) for n in [8] * 300 + [3000]]
    sketched = fingerprint.with_sketch(spark.createDataFrame(texts, "t string"), "t", "s").select(F.size(F.split("t", " ")).alias("n"), F.size("s.hashes").alias("k")).collect()
    short = [r.k for r in sketched if r.n == 8]
    assert 0 in short and abs(sum(short) / (4 * 300) - 0.25) < 0.05
    assert all(abs(r.k / (r.n - 4) - 0.25) < 0.03 for r in sketched if r.n == 3000)


def test_one_id_for_many_rows_is_cut_by_texts(spark):
    some = [(5 if i % 2 else i, f"text {i}", *[None] * 8) for i in range(80)] + [(None, f"none {i}", *[None] * 8) for i in range(60)]
    want = ordered(some)
    led = fingerprint.with_next(frame(spark, some).select("doc_id", "text"), ["text"], ranges=16)
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in led.collect()) == sorted((str(r[0]), r[1], want[(i + 1) % len(want)][1]) for i, r in enumerate(want))


def test_empty_and_single(spark):
    from tests.llm.cases import frame as docs

    assert fingerprint.edited_fingerprints(docs(spark, [])).count() == 0
    one = fingerprint.edited_fingerprints(docs(spark, [(1, "a b c d e f", *[None] * 8)])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
