"""Streaming sources: a broker topic, or files with the same envelope."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rillmark.schemas import ENVELOPE, TOPICS


@dataclass(frozen=True)
class StreamConfig:
    """``kind`` is ``kafka`` (needs the connector on the classpath) or ``files``."""

    kind: str = "kafka"
    servers: str = "localhost:9092"
    directory: str = ""
    fail_on_data_loss: bool = True
    max_records: int | None = None  # of a broker topic per batch
    max_files: int | None = None  # of a file source per batch


def read_events_stream(spark: SparkSession, config: StreamConfig, topic: str) -> DataFrame:
    """Messages of a topic in the fixed envelope; a batch is as large as the configuration allows, by default all there is.

    The first run starts with the earliest message. Later runs go on from the
    checkpoint, where Spark does not look at the start position any more.
    """
    if config.kind == "files":
        return read_files_stream(spark, f"{config.directory}/{topic}", ENVELOPE, config.max_files)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", config.servers)
        .option("subscribe", TOPICS.get(topic, topic))
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", str(config.fail_on_data_loss).lower())
    )
    if config.max_records:
        reader = reader.option("maxOffsetsPerTrigger", config.max_records)
    return reader.load().select(*ENVELOPE.fieldNames())


def read_files_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None, glob: str | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
