"""Incremental Bronze ingest with Structured Streaming.

The reference overwrites each Bronze table in batch. The same ingest can run
incrementally: a file source picks up files that landed since the last run,
``trigger(availableNow=True)`` processes them and stops, and the stream
checkpoint records which files are done. The checkpoint belongs to the target:
its place is derived from the target's, so every run on a target goes on where
the last one ended, and neither loses nor repeats a file. The Bronze columns
and the strict parsing are those of the batch ingest (``sources.bronze``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.sources import bronze


def csv_stream_to_variant(spark: SparkSession, folder: str, columns: list[str], delimiter: str = ",",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming version of ``sources.bronze.csv_to_variant`` (text schema given,
    since a stream cannot infer it). A file whose header is not ``columns``, in
    this order, fails the run."""
    reader = spark.readStream.schema(StructType([StructField(c, StringType()) for c in columns]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return bronze.csv_rows(reader.csv(folder, header=True, sep=delimiter, encoding="UTF-8", enforceSchema=False))


def jsonl_stream_to_variant(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    return bronze.json_rows(spark.readStream.format("text").load(folder), strict)


def checkpoint_of(target_path: str) -> str:
    """Where the progress of the stream into a target is kept: beside it."""
    return f"{target_path.rstrip('/')}.checkpoint"


def append_new_files(stream: DataFrame, target_path: str, checkpoint: str | None = None) -> str:
    """Append what has landed since the last run to a Parquet Bronze folder
    and stop. Returns the checkpoint location used."""
    checkpoint = checkpoint or checkpoint_of(target_path)
    query = (stream.writeStream.format("parquet").option("path", target_path)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return checkpoint
