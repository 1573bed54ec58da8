"""The pipeline against a plain version of its stages."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lexloom.llm import pii, quality
from tests.llm.cases import frame, prose, rows
from tests.llm.test_bpe import library
from tests.llm.test_mixing import slow_copies, words


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(3)
    some = [r[:5] for r in rows()]
    some += [(100 + i, " ".join(w.upper() + "!!" for w in prose(rng, 60).split()), "en", "a", 1) for i in range(60)]
    some += [(200 + i, prose(rng, 60) + ".", "en", "b", 1) for i in range(120)]
    path = str(tmp_path_factory.mktemp("sf"))
    frame(spark, [(*r, *[None] * 5) for r in some]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    labels = [(100 + i, 0, 0) for i in range(60)] + [(200 + i, 1, 0) for i in range(120)] + [(i, 1, 0) for i in range(0, 38, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "personal_data", "mixing", "bpe"] and corpus_pipeline.ORACLE_SQL is None


def test_run_equals_the_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    everything = [tuple(r) for r in docs.collect()]
    scores = model.score(np.array([quality.statistics((r[1] or "").encode()) for r in everything]))
    kept = [r for r, s in zip(everything, scores) if s >= 0.3]
    assert not {r[0] for r in kept} & set(range(100, 160)) and {r[0] for r in kept} >= set(range(200, 320))
    # groups alike by 0.8 keep the smallest id; no pair of these documents is close to the limit
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    sets, alone = [shingles(r[1]) for r in kept], []
    for i, r in enumerate(kept):
        if not any(alike(sets[i], sets[j]) >= 0.8 for j in range(i)):
            alone.append(r)
    hidden = [(r[0], None if r[1] is None else pii.redact(r[1], pii.find_spans(r[1])), r[3]) for r in alone]
    copies, _, _ = slow_copies([(i, text, words(text), source) for i, text, source in hidden])
    lib, want = library(), Counter()
    for (doc_id, text, source), n in zip(hidden, copies):
        if n:
            want[(doc_id, source, tuple(lib.encode_ordinary(text or "")))] += n
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.source, tuple(r.ids)) for r in out) == want
    assert all(r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(lib.decode_bytes(list(r.ids))).hexdigest() for r in out)


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0, name
        assert name == "bpe" or out.columns == docs.columns
