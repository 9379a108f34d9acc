"""Resumable ingest: new files only, from where the last run stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def message_stream(spark: SparkSession, path: str, schema, format: str = "parquet", files_per_batch: int = 1_000, **options) -> DataFrame:
    """Files of message rows below ``path`` as a stream; each micro-batch takes a bounded number."""
    reader = spark.readStream.schema(schema).format(format).option("maxFilesPerTrigger", files_per_batch)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def ingest_incremental(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is new to ``target`` and stop.

    Progress is kept in ``checkpoint``: a run that was interrupted goes on where it stopped, and
    the sink's commit log makes sure that no batch is written twice.
    """
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
