"""Comment events as streams.

Progress lives in the checkpoint, next to which the sinks are idempotent: a micro-batch that is repeated after a
failure replaces exactly the table partitions it wrote before (``load_id`` is consumer plus batch id).
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxlake.contracts import CONTRACTS, align
from voxlake.functions.columns import as_timestamp, int_or_zero
from voxlake.operators.bronze import envelopes_to_bronze
from voxlake.session import staged
from voxlake.sinks.runlogs import stream_run_log
from voxlake.sinks.tables import overwrite
from voxlake.sources.tables import DEFAULT_FORMAT, read_contract, read_if_exists

COMMENTS = "bronze.youtube_comments_kafka_raw"
RUNS = "bronze.kafka_ingestion_runs"


def consumer_name(checkpoint: str) -> str:
    """A name that stays the same for all restarts from one checkpoint."""
    return "consumer-" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]


class _Enough(Exception):
    """Raised in a micro-batch that is not wanted any more: it is not committed, so a later run reads it."""


def consume_to_bronze(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    fmt: str = DEFAULT_FORMAT,
    executed_at: str | None = None,
    max_messages: int | None = None,
) -> StreamingQuery:
    """Drain the log into the bronze table and write run rows; ends when everything available is read.

    ``messages`` has topic, partition, offset, key and value. With ``max_messages`` the drain takes up micro-batches
    until so many messages are read; the reader bounds a micro-batch by the same number (see ``read_message_log``).
    """
    consumer = consumer_name(checkpoint)
    taken = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal taken
        if max_messages is not None and taken >= max_messages:
            raise _Enough(f"{taken} messages are read")
        moment = executed_at or dt.datetime.now(dt.UTC).isoformat()
        rows = staged(align(envelopes_to_bronze(batch, moment, f"{consumer}-{batch_id}"), CONTRACTS[COMMENTS]), "batch")
        log = align(stream_run_log(rows, consumer, batch_id, moment, root), CONTRACTS[RUNS])
        for key, frame in ((COMMENTS, rows), (RUNS, log)):
            contract = CONTRACTS[key]
            overwrite(frame, contract.path(root), contract.partition_by, fmt, only_touched_partitions=True)
        taken += rows.count()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def consume_available(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    checkpoint: str,
    max_messages: int | None = None,
    executed_at: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, int | str]:
    """Drain, wait, and report: ``status`` is ``empty`` when there was nothing to read, else ``success``."""

    def written() -> int:
        found = read_contract(spark, root, RUNS, fmt).filter(F.col("run_id") == consumer_name(checkpoint))
        return found.agg(F.coalesce(F.sum("messages_consumed"), F.lit(0))).first()[0]

    before = written()
    query = consume_to_bronze(messages, root, checkpoint, fmt, executed_at, max_messages)
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if _Enough.__name__ not in str(error):
            raise
    consumed = written() - before
    return {"status": "success" if consumed else "empty", "messages_consumed": consumed}


def publish_stream(events: DataFrame, checkpoint: str, fmt: str = "kafka", **options: str) -> StreamingQuery:
    """Stream (key, value) rows to a log."""
    return (
        events.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def event_time(events: DataFrame, column: str = "comment_published_at") -> DataFrame:
    """``event_time`` with time zone, as watermarks need it."""
    return events.withColumn("event_time", as_timestamp(events, column))


def without_repeats(events: DataFrame, delay: str = "7 days", key: str = "event_id") -> DataFrame:
    """Each event id once. Repeats are recognised for ``delay`` after the first arrival, which bounds the state.

    The watermark runs on arrival, not on publication: however old an event is when it comes, it is kept.
    """
    arrived = events.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", delay)
    return arrived.dropDuplicatesWithinWatermark([key]).drop("arrived_at")


def windowed_mart(
    events: DataFrame, window: str = "1 day", delay: str | None = None, keys: tuple[str, ...] = ("topic", "genre")
) -> DataFrame:
    """Tumbling-window mart per key: comments, labels, mean score and likes.

    Without ``delay`` every window stays open, the state being the mart itself; with it, events that are later than the
    newest by more are left out and their windows are forgotten.

    Feed it events without repeats: rows are counted, which for unique events equals the batch mart.
    """
    df = events.withColumn("_likes", int_or_zero(events, "comment_like_count"))
    if delay is not None:
        df = df.withWatermark("event_time", delay)
    label = lambda name: F.count_if(F.col("sentiment_label") == name).alias(f"{name}_comments")
    out = df.groupBy(F.window("event_time", window).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("comments_count"),
        *[label(name) for name in ("positive", "neutral", "negative")],
        F.round(F.avg("sentiment_score"), 4).alias("avg_sentiment_score"),
        F.sum("_likes").alias("total_comment_likes"),
    )
    start: Column = F.date_format("w.start", "yyyy-MM-dd HH:mm:ss")
    return out.select(
        start.alias("window_start"),
        *keys,
        "comments_count",
        "positive_comments",
        "neutral_comments",
        "negative_comments",
        "avg_sentiment_score",
        "total_comment_likes",
    )


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = DEFAULT_FORMAT) -> None:
    """Run a stream to the end of what is available and wait for it."""
    query = (
        stream.writeStream.format(fmt)
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_windows(mart: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("topic", "genre")) -> None:
    """Keep a table of all windows: a micro-batch brings the windows that grew, which replace their older rows.

    A row of the table lies in the folder of its window's start, and only the folders of windows that grew are written
    again. A repeated micro-batch brings the same totals, so it changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        grown = staged(batch, "windows")
        if grown.isEmpty():
            return
        known = read_if_exists(spark, path)
        if known is not None:
            starts = grown.select("window_start").distinct()
            same = [F.col(f"k.{name}").eqNullSafe(F.col(f"g.{name}")) for name in ("window_start", *keys)]
            touched = known.select(*grown.columns).withColumn("window_start", F.col("window_start").cast("string"))
            older = touched.join(starts, "window_start", "left_semi").alias("k").join(grown.alias("g"), same, "left_anti")
            grown = staged(grown.unionByName(older.select(*grown.columns)), "windows")
        overwrite(grown, path, ("window_start",), only_touched_partitions=True)

    query = (
        mart.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
