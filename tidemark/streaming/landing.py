"""Landed batches and change events as streams that drain and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import apply_change_batch
from tidemark.sources.buckets import BucketLog, Merge


def landed_stream(spark: SparkSession, landing: str, schema: T.StructType,
                  files_per_trigger: int = 1000) -> DataFrame:
    """New files under landing/batch_seq=NNNNNN/, with their batch_seq as a column.

    The number may have any length. A file in no such folder stops the stream.
    """
    path = F.col("_metadata.file_path")
    seq = F.nullif(F.regexp_extract(path, r"/batch_seq=(\d+)/", 1), F.lit(""))
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", "true").parquet(landing)
        .withColumn("batch_seq", F.coalesce(seq, F.raise_error(F.concat(F.lit("no batch folder: "), path)).cast("string")).cast("bigint")))


def drain(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has landed, in micro-batches, then stop.

    The checkpoint remembers the files done, so a rerun after a failure neither skips nor
    repeats one, provided write is idempotent for a batch id.
    """
    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append landed rows to Parquet slices by batch; each micro-batch replaces its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy("batch_seq").parquet(f"{target}/micro={batch_id}")

    drain(stream, checkpoint, write)


def merge_stream(stream: DataFrame, log: BucketLog, table: str, key: str, checkpoint: str) -> None:
    """Fold change events into a bucketed table, one committed version per micro-batch.

    A batch reads and writes the buckets of its own keys, so its work follows the batch, and leaves the rows it changed in the table's
    feed. An event counts only when its sequence is beyond the stored row's, so late files and
    replayed batches leave the result unchanged. A batch whose commit exists is skipped.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{table}-{batch_id}"
        if not log.commits().where((F.col("run_id") == run_id) & (F.col("table") == table)).isEmpty():
            return
        log.merge(run_id, {table: Merge(batch.select(key), lambda rows: apply_change_batch(rows, batch, key))})

    drain(stream, checkpoint, write)
