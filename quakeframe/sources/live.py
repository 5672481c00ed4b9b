"""Live message sources. Every reader yields ``value`` (text) and ``timestamp`` (arrival)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_kafka(
    spark: SparkSession, servers: str, topics: str, starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Needs the Kafka connector package on the class path.

    ``starting_offsets`` counts only for the first run; later ones go on from the checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """One JSON message per line; the arrival is the modification time of the file."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
        .text(path)
        .select("value", F.col("_metadata.file_modification_time").alias("timestamp"))
    )
