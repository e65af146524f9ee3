"""Streaming inputs. Every pipeline takes any streaming frame with a ``value`` column
(and optionally ``key``), so the broker is one choice among several."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import Entity


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    entity: Entity,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """The change topic of an entity from its beginning. Needs the Kafka connector on the
    class path. ``max_offsets_per_trigger`` bounds a micro-batch during catch-up."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", entity.topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def text_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of text files, one envelope per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def landed_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The bronze landing of raw messages as a stream, for replays."""
    reader = spark.readStream.schema("key string, value string, landed_at timestamp")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
