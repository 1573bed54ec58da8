"""Extra columns named like those that operators make for themselves stay as they are."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexloom.llm import bpe, fingerprint, mixing, pii, quality, similar
from tests.llm.cases import frame, rows

NAMES = "_id _key _row _source _copies _rate key id kept_key row number class of in limit copy ids decoded pii cuts place tie first into to led hashes word_hashes whole tid component".split()
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(38)], "doc_id long, quality int, toxic int")


CASES = {
    "deduplicate": lambda spark, d: similar.deduplicate(d),
    "mix": lambda spark, d: mixing.mix_sources(d),
    "quality": lambda spark, d: quality.reject_low_quality(d, labels(spark), threshold=0.0),
    "redact": lambda spark, d: pii.redact_pii(d),
    "detect": lambda spark, d: pii.detect_pii(d, name="spans"),
    "encode": lambda spark, d: bpe.bpe_encode(d, PATH, public_tokenizers.PATTERN, name="tokens"),
    "sketch": lambda spark, d: fingerprint.with_sketch(d, "text", "sketch"),
    "next": lambda spark, d: fingerprint.with_next(d, ["text"]),
}


@pytest.mark.parametrize("name", CASES)
def test_columns_stay(spark, name):
    docs = frame(spark, rows()[:30]).withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES})
    out = CASES[name](spark, docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    kept = out.collect()
    assert kept and all(r[n] == f"{n} {'-' if r.doc_id is None else r.doc_id}" for r in kept for n in NAMES)
