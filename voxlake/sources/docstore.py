"""Document collections and message logs: connector readers with the operations on top."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sort order of a collection scan.
SCAN_ORDER = ("collection_date", "run_id", "query_id", "video_id", "comment_id")


def read_collection(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """A document collection through a Spark connector, e.g. ``fmt="mongodb"``."""
    return spark.read.format(fmt).options(**options).load()


def scan_collection(documents: DataFrame, collection_date: str | None = None, limit: int | None = None) -> DataFrame:
    """Optional date equality (pushed to the source), fixed order, optional positive limit.

    Without a limit no sort is planned: the order matters only for which rows a limit keeps.
    """
    if collection_date:
        documents = documents.filter(F.col("collection_date") == collection_date)
    if limit and limit > 0:
        documents = documents.orderBy(*SCAN_ORDER).limit(limit)
    return documents


def read_message_log(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_messages: int | None = None,
    **options: str,
) -> DataFrame:
    """A Kafka topic as a stream of (topic, partition, offset, key, value), from the earliest offset."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_messages))
    raw = reader.options(**options).load()
    return raw.select(
        "topic",
        F.col("partition").cast("bigint").alias("partition"),
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same columns from JSON files, for tests and replays."""
    reader = spark.readStream.schema("topic string, partition bigint, offset bigint, key string, value string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(path)
