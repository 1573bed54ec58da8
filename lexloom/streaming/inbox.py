"""An inbox folder as a stream: new result files are parsed and replace their key's rows in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; an aggregate that combines before it shuffles."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row")).select(key, "_row.*")


def run_inbox(spark: SparkSession, inbox: str, table: str, state: str, schema: str, key: str, order: str) -> StreamingQuery:
    """Processes what the inbox holds and stops. Each batch writes one folder batch=<id> below ``table``.

    A batch that is tried again overwrites its own folder, so a lost driver leaves nothing twice; readers take the
    latest row per key over all batches (read_inbox_table).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, key, order).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).json(inbox)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def read_inbox_table(spark: SparkSession, table: str, key: str, order: str) -> DataFrame:
    """The current row of every key."""
    return latest_per_key(spark.read.parquet(table).drop("batch"), key, order)
