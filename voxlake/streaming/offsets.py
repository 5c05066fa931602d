"""A bounded drain of a message log that takes exactly as many messages as asked for, in batch.

Progress is a table of offset ranges. A drain first writes its plan, one range for each partition of the log, then the
rows of these ranges, then the mark that the load is done. What is planned but not done is carried out first by the next
drain, over the same ranges and under the same load id, so that it replaces what the broken one wrote: every message is
written once, wherever a drain stopped. No stream, and no exception as a stop.

Of a partition with holes in its offsets (compacted or transactional logs) messages count, not offsets. A bound is shared
out evenly over the partitions; what one of them lacks goes to the others. One drain of a consumer runs at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS, align
from voxlake.operators.bronze import envelopes_to_bronze
from voxlake.operators.silver import first_per_group
from voxlake.session import discard, staged
from voxlake.sinks.runlogs import stream_run_log
from voxlake.sinks.tables import overwrite
from voxlake.sources.tables import DEFAULT_FORMAT, read_if_exists

COMMENTS = "bronze.youtube_comments_kafka_raw"
RUNS = "bronze.kafka_ingestion_runs"
_PLANS = "consumer string, topic string, partition bigint, first_offset bigint, end_offset bigint, messages bigint, load bigint"
_DONE = "consumer string, load bigint"


def _paths(root: str) -> tuple[str, str]:
    base = f"{root.rstrip('/')}/bronze/stream_progress"
    return f"{base}/plans", f"{base}/done"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = read_if_exists(spark, path, "parquet", spark.createDataFrame([], schema).schema)
    return spark.createDataFrame([], schema) if found is None else found.select(*[c.split()[0] for c in schema.split(", ")])


def plans(spark: SparkSession, root: str, consumer: str) -> DataFrame:
    """The ranges of all loads of a consumer, and whether each is ``done``."""
    at, done_at = _paths(root)
    done = _read(spark, done_at, _DONE).filter(F.col("consumer") == consumer).select("load", F.lit(True).alias("done")).distinct()
    mine = _read(spark, at, _PLANS).filter(F.col("consumer") == consumer)
    return mine.join(done, "load", "left").withColumn("done", F.coalesce("done", F.lit(False)))


def progress(spark: SparkSession, root: str, consumer: str) -> DataFrame:
    """``topic, partition, next_offset, messages``: where the next load begins, and how many messages are taken."""
    found = plans(spark, root, consumer).filter("done").groupBy("topic", "partition")
    return found.agg(F.max("end_offset").alias("next_offset"), F.sum("messages").alias("messages"))


def even_shares(available: dict, most: int | None) -> dict:
    """How many of each key's items to take: ``most`` in all, as evenly as what they have allows, earlier keys first."""
    if most is None or sum(available.values()) <= most:
        return {key: n for key, n in available.items() if n}
    taken, left, room = dict.fromkeys(available, 0), most, [k for k, n in sorted(available.items()) if n]
    while left and room:
        each = max(1, left // len(room))
        for key in room:
            n = min(each, available[key] - taken[key], left)
            taken[key] += n
            left -= n
        room = [key for key in room if taken[key] < available[key]]
    return {key: n for key, n in taken.items() if n}


def plan_load(spark: SparkSession, log: DataFrame, root: str, consumer: str, max_messages: int | None = None) -> DataFrame | None:
    """Ranges of the next load, one row for each partition of the log that gives messages; ``None`` without any."""
    known = F.broadcast(progress(spark, root, consumer).select(F.col("topic").alias("t"), F.col("partition").alias("p"), "next_offset"))
    open_ = log.join(known, (F.col("topic") == F.col("t")) & (F.col("partition") == F.col("p")), "left").filter(
        F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset"))
    )
    open_ = open_.select("topic", "partition", "offset")
    # One row for each partition of the log.
    found = open_.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    shares = even_shares({(r["topic"], r["partition"]): r["n"] for r in found}, max_messages)
    whole = [(r["topic"], r["partition"], r["low"], r["high"] + 1, r["n"]) for r in found if shares.get((r["topic"], r["partition"])) == r["n"]]
    cut = [(*key, n) for key, n in sorted(shares.items()) if not any(w[:2] == key for w in whole)]
    kind = "topic string, partition bigint, first_offset bigint, end_offset bigint, messages bigint"
    ranges = spark.createDataFrame(whole, kind)
    if cut:
        limits = F.broadcast(spark.createDataFrame(cut, "topic string, partition bigint, share bigint"))
        few = first_per_group(open_.join(limits, ["topic", "partition"]), ["topic", "partition"], [F.col("offset")], F.col("share"))
        part = few.groupBy("topic", "partition").agg(
            F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset"), F.count(F.lit(1)).alias("messages")
        )
        ranges = ranges.unionByName(part)
    return ranges if shares else None


def messages_of(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """The messages within the ranges; there is one range for each partition of the log, a small table that goes to the log.

    Messages met by topic and partition would come to as many tasks as the log has partitions, however long it is.
    """
    named = F.broadcast(ranges.select(F.col("topic").alias("t"), F.col("partition").alias("p"), "first_offset", "end_offset"))
    within = (F.col("topic") == F.col("t")) & (F.col("partition") == F.col("p")) & (F.col("offset") >= F.col("first_offset")) & (F.col("offset") < F.col("end_offset"))
    return log.join(named, within).select(*log.columns)


def drain_log(
    spark: SparkSession,
    log: DataFrame,
    root: str,
    consumer: str,
    max_messages: int | None = None,
    executed_at: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, int | str]:
    """Up to ``max_messages`` further messages of the log into the bronze table, exactly that many where it has them.

    ``log`` is a batch frame with topic, partition, offset, key and value. A load that an earlier drain left undone is
    done first and counts. ``status`` is ``empty`` when there was nothing to take, else ``success``.
    """
    plans_at, done_at = _paths(root)
    known = plans(spark, root, consumer)
    undone = known.filter(~F.col("done"))
    pending = undone.agg(F.min("load").alias("load"), F.coalesce(F.sum("messages"), F.lit(0)).alias("n")).first()
    if pending["load"] is None:
        load = (known.agg(F.max("load")).first()[0] or 0) + 1
        ranges = plan_load(spark, log, root, consumer, max_messages)
        if ranges is None:
            return {"status": "empty", "messages_consumed": 0}
        plan = ranges.withColumns({"consumer": F.lit(consumer), "load": F.lit(load).cast("bigint")}).coalesce(1)
        plan.select(*[c.split()[0] for c in _PLANS.split(", ")]).write.mode("append").parquet(plans_at)
    else:
        load = pending["load"]
    ranges = plans(spark, root, consumer).filter(F.col("load") == load)
    moment = executed_at or dt.datetime.now(dt.UTC).isoformat()
    rows = staged(align(envelopes_to_bronze(messages_of(log, ranges), moment, f"{consumer}-{load}"), CONTRACTS[COMMENTS]), "load")
    run = align(stream_run_log(rows, consumer, load, moment, root), CONTRACTS[RUNS])
    for key, frame in ((COMMENTS, rows), (RUNS, run)):
        contract = CONTRACTS[key]
        overwrite(frame, contract.path(root), contract.partition_by, fmt, only_touched_partitions=True)
    spark.createDataFrame([(consumer, load)], _DONE).coalesce(1).write.mode("append").parquet(done_at)
    taken = rows.count()
    discard(rows)
    if pending["load"] is not None and (max_messages is None or taken < max_messages):
        more = drain_log(spark, log, root, consumer, None if max_messages is None else max_messages - taken, executed_at, fmt)
        taken += int(more["messages_consumed"])
    return {"status": "success" if taken else "empty", "messages_consumed": taken}
