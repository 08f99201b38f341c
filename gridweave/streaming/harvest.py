"""Harvested files as a stream: new element files are parsed once each and appended to a table of latest elements.

The build itself is a batch; this keeps its input current. Each micro-batch is written under its own number, so a batch
that runs again after a failure replaces itself and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridweave.sources.elements import latest, parsed_lines


def element_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of the files that appear below ``folder``; a line that is not an element fails the stream."""
    lines = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson").text(folder)
    return parsed_lines(lines.select("value", F.col("_metadata.file_path").alias("file")))


def keep_latest(stream: DataFrame, target: str, checkpoint: str, **trigger) -> StreamingQuery:  # noqa: ANN003
    """Write each micro-batch's longest copy of every element below ``target``."""

    def store(batch: DataFrame, number: int) -> None:
        latest(batch).write.mode("overwrite").parquet(f"{target}/batch={number:08d}")

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The latest copy of every element over all micro-batches."""
    return latest(spark.read.parquet(target).drop("batch"))
