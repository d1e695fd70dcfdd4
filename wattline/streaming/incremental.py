"""Incremental table load: each newly landed file is loaded exactly once.

Structured Streaming tracks which files of the landing directory were
already handed out (its checkpoint lives in the shared folder). The stream
only lists paths: the binary-file source reads no bytes when `content` is
not selected. Each micro-batch runs the batch table load on its new files,
with the same insert-if-absent semantics, so a file landed twice or a batch
replayed after a failure adds no duplicate keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wattline.plans.table_load import load_table_files
from wattline.session import fresh_location

_EXT_GLOB = "*.{[cC][sS][vV],[xX][lL][sS],[xX][lL][sS][xX]}"
_BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def start_incremental_load(spark: SparkSession, landing_dir: str, table_path: str,
                           rejected_path: str, checkpoint: str | None = None,
                           available_now: bool = True, max_files_per_batch: int = 1000):
    """Start the stream; with `available_now` it stops after the files present now."""
    checkpoint = checkpoint or fresh_location(spark, "incremental-load-checkpoint")
    files = (spark.readStream.format("binaryFile").schema(_BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", _EXT_GLOB)
             .option("recursiveFileLookup", "false")
             .option("maxFilesPerTrigger", max_files_per_batch)
             .load(landing_dir)
             .select("path"))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # file names only, bounded by the batch size
        if paths:
            load_table_files(spark, paths, table_path, rejected_path)

    writer = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
