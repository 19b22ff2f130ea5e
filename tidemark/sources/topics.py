"""Reading topics, captured arrivals, and their offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import ARRIVAL_SCHEMA, LOG_SCHEMA


def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, starting: str = "earliest"
) -> DataFrame:
    """A topic as a stream of arrivals; needs the Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return as_arrivals(reader.load())


def topic_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds now, as a table of arrivals."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return as_arrivals(reader.option("startingOffsets", "earliest").load())


def as_arrivals(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("src_partition"),
        "offset",
    )


def captured_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Arrivals captured as JSON files, read as a stream with the same columns as a topic."""
    reader = spark.readStream.schema(ARRIVAL_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def log_files(spark: SparkSession, path: str, service: str) -> DataFrame:
    """Log lines of one service from text files."""
    lines = spark.read.text(path)
    return lines.select(F.lit(service).alias("service"), F.col("value").alias("raw")).select(*LOG_SCHEMA.fieldNames())


def end_offsets(arrivals: DataFrame) -> DataFrame:
    """The next offset of each source partition."""
    return arrivals.groupBy("src_partition").agg((F.max("offset") + 1).alias("end_offset"))


def end_offset_sum(arrivals: DataFrame) -> DataFrame:
    return end_offsets(arrivals).agg(F.coalesce(F.sum("end_offset"), F.lit(0)).alias("end_offset_sum"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """End offset minus committed offset of each partition; nothing committed counts as zero."""
    done = F.coalesce("committed_offset", F.lit(0))
    return ends.join(committed, "src_partition", "left").select(
        "src_partition", "end_offset", done.alias("committed_offset"), (F.col("end_offset") - done).alias("lag")
    )
