import random
import zlib

import numpy as np

from lexloom.llm import quality
from tests.llm.cases import frame, prose


def corpus(n=240):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        text = prose(rng, rng.randint(20, 120))
        docs.append((i, " ".join(w.upper() + "!!" for w in text.split()) if bad else text + ".", *[None] * 8))
        labels.append((i, int(not bad), 0))
    return docs, labels


def test_held_out_rows_are_told_apart_and_unlabelled_ones_scored(spark):
    docs, labels = corpus()
    docs += [(1000, None, *[None] * 8), (1001, "", *[None] * 8), (None, "x y", *[None] * 8), docs[0]]
    table = spark.createDataFrame(labels + [labels[0], (5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(frame(spark, docs), table)
    scored = quality.score_quality(frame(spark, docs).drop("score"), model).collect()
    assert len(scored) == len(docs) and all(0 <= r.score <= 1 for r in scored)
    held = [r for r in scored if r.doc_id is not None and r.doc_id < 1000 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    truth = dict((a, b) for a, b, _ in labels)
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in held]) > 0.95
    kept = quality.reject_low_quality(frame(spark, docs), table)
    assert kept.columns == frame(spark).columns and 0 < kept.count() < len(docs)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(120)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    fits = [quality.fit(frame(spark, docs), spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert np.array_equal(fits[0].beta, fits[1].beta) and np.array_equal(fits[0].values, fits[1].values)


def test_fits_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    docs, labels = corpus(150)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    first = quality.fit(frame(spark, docs).repartition(7), table)
    monkeypatch.setattr(quality, "SUMS", 9)
    second = quality.fit(frame(spark, docs[::-1]).repartition(2), table)
    assert all(np.array_equal(getattr(first, n), getattr(second, n)) for n in ("mean", "scale", "beta", "knots", "values"))


def test_training_rows_are_whole_and_in_few_files_however_many_partitions_shuffles_have(spark, monkeypatch):
    docs, labels = corpus(150)
    made = []
    monkeypatch.setattr(quality, "written", lambda df, name, f=quality.written: made.append(f(df, name)) or made[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("23", "false"), strict=True):
            spark.conf.set(k, v)
        assert quality.fit(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(made[0].inputFiles()) <= quality.SUMS
    assert sorted(r.doc_id for r in made[0].collect()) == [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5]


def test_few_labels_are_calibrated_by_other_folds(spark):
    docs, labels = corpus(12)
    model = quality.fit(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert list(model.values) == sorted(model.values) and all(0 <= r.score <= 1 for r in quality.score_quality(frame(spark, docs).drop("score"), model).collect())


def test_isotonic_is_monotone_and_pools():
    x, y = quality.isotonic(np.array([3.0, 1, 2, 4]), np.array([0.0, 0, 1, 1]))
    assert list(y) == sorted(y) and np.allclose(y, [0, 0.5, 1])


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs, labels = corpus(5)
    assert quality.fit(frame(spark, docs), none) is None
    assert {r.score for r in quality.score_quality(frame(spark, docs).drop("score"), None).collect()} == {0.5}
    assert quality.fit(frame(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) is None
