"""Resumable runs: files that a run has handled are not handled again.

A file-source stream with trigger(availableNow=True) and a checkpoint gives each new file to a batch function exactly once; whole
samples come in one batch, so false-discovery rates see all of a sample.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_new_files(spark: SparkSession, folder: str, glob: str, schema: T.StructType, handle: Callable[[DataFrame, int], None], checkpoint: str, files_per_batch: int = 64) -> int:
    """Give all files not seen before to handle(frame, batch number), text columns by header, with `__file`; how many batches ran."""
    stream = spark.readStream.schema(schema).option("sep", "\t").option("header", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    stream = stream.withColumn("__file", F.col("_metadata.file_name"))
    done: list[int] = []

    def batch(frame: DataFrame, number: int) -> None:
        handle(frame, number)
        done.append(number)

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)
