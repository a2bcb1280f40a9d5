"""New documents of a container as a stream, and windows over their write time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioql.sources.container import TS, ContainerMeta, row_type


def changes(spark: SparkSession, meta: ContainerMeta, path: str, max_files: int | None = None) -> DataFrame:
    """Files added to a container, as rows; `event_time` is the write time.  Rewritten partitions appear again."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    return row_type(reader.parquet(path), meta).withColumn("event_time", F.timestamp_seconds(TS))


def counts_by_window(stream: DataFrame, width: str = "5 minutes", late: str = "10 minutes", *keys: str) -> DataFrame:
    """Documents per window of write time; windows close once `late` has passed."""
    return stream.withWatermark("event_time", late).groupBy(F.window("event_time", width), *keys).agg(F.count("*").alias("n"))
