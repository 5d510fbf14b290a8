"""Bulk CSV loads in bounded chunks, restartable after a failure."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def load_in_chunks(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    files_per_chunk: int = 1000,
    multiline: bool = True,
    mode: str = "FAILFAST",
) -> int:
    """Append the CSV files of ``source`` that were not loaded yet to the Parquet table ``target``,
    ``files_per_chunk`` at a time, and return the rows of the table. The checkpoint remembers what
    was loaded, so a load that was cut off goes on where it stopped and no chunk is loaded twice.
    Quoted values may hold line breaks unless ``multiline`` is false. A row that does not fit the schema
    stops the load, unless ``mode`` is another of Spark's."""
    chunks = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", mode)
        .option("maxFilesPerTrigger", files_per_chunk)
        .csv(source)
    )
    load = (
        chunks.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
    load.awaitTermination()
    return spark.read.parquet(target).count()
