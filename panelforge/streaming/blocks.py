"""Incremental scans of a tree of blocks: file-source streams whose checkpoint knows the files that were read.

A scan reads the files that came since the last one and appends their rows, with the block of each, to a table of
batches; a batch that runs again after a failure replaces its own folder. Blocks are complete when their files
appear, as the writers of trees put files in place whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.trees import parent, relative_path


def scan_new(spark: SparkSession, root: str, schema: StructType, table_path: str, checkpoint: str, pattern: str = "*.parquet") -> int:
    """Read the blocks under ``root`` that no scan with this checkpoint has read; the number of batches."""
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(root)
    rows = source.select("*", parent(relative_path(root)).alias("block_dir"))

    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    query = rows.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)


def scanned(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of all scans."""
    return spark.read.parquet(table_path).drop("batch")
