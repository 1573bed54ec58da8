"""Helpers shared by the training-data operators: shared scratch space, table reads, small text rules."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regular expression of a word: a maximal run of characters other than space and U+0009..U+000D.
WORD = "[^ \\t-\\r]+"
#: Paths of the tables written inside each open scratch(), the innermost last.
_made: ContextVar[tuple[list[str], ...]] = ContextVar("made", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where a local session names none (tests), a folder of this machine is set for it; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="lexloom-scratch-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with batches that go to Python workers bounded by rows and bytes, so whole texts need little memory.

    Spark reads these settings when a query runs, not when it is built, so they stay; lower ones are left alone.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        now = int(re.match(r"-?[0-9]+", spark.conf.get(name))[0])
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/lexloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and a lost executor loses nothing of it.

    Inside scratch() it goes at the end, unless it is to ``keep``, until the end of the scratch() around that one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if len(_made.get()) > keep:
        _made.get()[-1 - keep].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, but for those to keep: what outlives this block must be one of these."""
    made: list[str] = []
    before = _made.set((*_made.get(), made))
    try:
        yield
    finally:
        _made.reset(before)
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind it as keep it apart from the columns."""
    used = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(col: Column) -> Column:
    """An id as text for hashing; null has a text of its own."""
    return F.coalesce(col.cast("string"), F.lit("null"))
