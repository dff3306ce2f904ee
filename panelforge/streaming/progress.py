"""Progress over a growing log with Structured Streaming: last-wins state per block, counted by bucket.

Every batch writes only the blocks that it changed; readers take the last row of a block, and ``compact`` folds batches
together now and then. So the work of a batch follows the size of the batch, not that of the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import statuses, windows
from ..sources.shared import shared_folder


def last_status_stream(log: DataFrame, key: list[str], status: str = "status", ordinal: str = "ordinal", place: str = "block_dir") -> DataFrame:
    """A streaming aggregate: the last status of each block by append order. State holds one row per block."""
    rows = log.where(F.coalesce(F.trim(place), F.lit("")) != "")
    return rows.groupBy(*key).agg(F.max_by(status, ordinal).alias(status), F.max(ordinal).alias(ordinal))


def progress_from(latest: DataFrame, group: str) -> DataFrame:
    bucket = statuses.bucket("status", statuses.LOG_BUCKETS).alias("bucket")
    return latest.groupBy(group, bucket).agg(F.count("*").alias("blocks"))


def start(spark: SparkSession, log_path: str, schema, key: list[str], table_path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep under ``table_path`` the last status of each block: a folder for each batch, with the blocks that it changed.

    A batch that runs again after a failure replaces its own folder.
    """
    stream = spark.readStream.schema(schema).parquet(log_path)

    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    writer = last_status_stream(stream, key).writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def published(spark: SparkSession, table_path: str, key: list[str], ordinal: str = "ordinal") -> DataFrame:
    """The last status of each block over all batches."""
    return windows.last_rows(spark.read.parquet(table_path).drop("batch"), key, ordinal)


def compact(spark: SparkSession, table_path: str, to_path: str, key: list[str]) -> DataFrame:
    """All batches of a table as one, in a new folder."""
    published(spark, table_path, key).write.parquet(f"{to_path}/batch=-1")
    return spark.read.parquet(to_path)


def drained_progress(spark: SparkSession, log: DataFrame, key: list[str], group: str) -> DataFrame:
    """Write ``log`` as a log of files, run the stream over all of them, and report its last state."""
    folder = shared_folder(spark, "progress")
    log.write.parquet(f"{folder}/log")
    query = start(spark, f"{folder}/log", log.schema, key, f"{folder}/table", f"{folder}/state", available_now=True)
    query.awaitTermination()
    return progress_from(published(spark, f"{folder}/table", key), group)
