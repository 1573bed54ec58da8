"""A corpus pipeline of five of the training-data operators, each stage working on all that the one before kept.

Stages, in order: documents of low quality go; of each group of near copies one document stays; personal data is
replaced by its kind; sources are mixed to their target weights (documents may repeat or go); texts become byte-level
BPE ids, checked by decoding. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import bpe, mixing, pii, quality, similar
from lexloom.llm._shared import table, written

#: No SQL: trained scores, near-copy groups and BPE are beyond it. The tests hold run() against a brute-force version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, doesn't reject."""
    return quality.reject_low_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group alike by 0.8 or more in its five-word shingles.

    SimHash links by covering tables come first, an exact check and a complete search for what they can't reach after.
    """
    return similar.deduplicate(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix_sources(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and their number for each row, with the SHA-256 of the bytes that the ids decode to."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.bpe_rows(docs, path, pattern, ["doc_id", "source"])


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
