"""Latest version per comment as a stream: keyed state holds each comment's newest version, changes come out.

A version that is not newer is passed over, however late it comes; a newer one is given out and takes its place. The
order is a rank of three times and a hash, that of ``silver.latest_versions``, so the rows that the stream has given out
last are the rows of the batch table.

State kept for good is that of a streaming aggregate: the newest row of a comment, its rank and the micro-batch that
brought it; no row goes to Python. State that has had no new version for ``keep`` is forgotten, if such a time is set; a
comment whose state is gone starts anew. That needs a processor in Python, which holds the rank alone and asks for it
comment by comment: far slower (README). A checkpoint of one kind cannot be carried on with the other.

The sink is a store of hash buckets by comment id: a micro-batch rewrites the buckets in which it changes a row, and a
repeated one changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.operators.silver import curate, has_required_fields
from voxlake.sinks import buckets

KEY = "comment_id"
_TIMES = ("comment_updated_at", "comment_published_at", "ingested_at")
_RANK = ("rank_updated", "rank_published", "rank_ingested", "rank_tie")
_ARRIVED = "rank_arrived_at"
#: Stands for no time: before all others.
_NEVER = -(1 << 63)
_STORE = "spark.sql.streaming.stateStore"
#: State on disk, in memory within a bound for all stores of an executor. A micro-batch leaves a log of its changes instead
#: of the store's files; rows are not looked up to be counted.
_STORE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with the numbers that order their versions; the last one settles equal times as the batch table does."""
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    numbers: list[Column] = [F.coalesce(F.unix_micros(F.col(name).cast("timestamp")), F.lit(_NEVER)) for name in _TIMES]
    numbers.append(F.bitwise_not(F.xxhash64(*plain)))
    return rows.withColumns(dict(zip(_RANK, numbers, strict=True)))


def _as_numbers(rows: DataFrame) -> DataFrame:
    """Times and dates as whole numbers, which no worker's time zone can shift."""
    to = {"timestamp": F.unix_micros, "date": F.unix_date}
    return rows.select([to[kind](name).alias(name) if kind in to else F.col(name) for name, kind in rows.dtypes])


def _restored(rows: DataFrame, like: DataFrame) -> DataFrame:
    back = {"timestamp": F.timestamp_micros, "date": F.date_from_unix_date}
    return rows.select([back[kind](name).alias(name) if kind in back else F.col(name) for name, kind in like.dtypes])


def _processor(names: list[str], keep_ms: int):
    from pyspark.sql.streaming import StatefulProcessor

    rank_names = _RANK

    class Newest(StatefulProcessor):
        def init(self, handle) -> None:
            self.newest = handle.getValueState("newest", ", ".join(f"{n} long" for n in rank_names), keep_ms)

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
            rank = tuple(self.newest.get()) if self.newest.exists() else None
            best = None
            for row in rows:
                own = tuple(row[n] for n in rank_names)
                if rank is None or own > rank:
                    rank, best = own, row
            if best is not None:
                self.newest.update(rank)
                yield Row(**{n: best[n] for n in names})

        def close(self) -> None:
            pass

    return Newest()


def _changes_kept_for(rows: DataFrame, keep: int) -> DataFrame:
    keyed = _as_numbers(_ranked(rows)).groupBy(KEY)
    changes = keyed.transformWithState(_processor(rows.columns, 1000 * keep), _as_numbers(rows).schema, "Update", "ProcessingTime")
    return _restored(changes, rows)


def latest_changes(bronze: DataFrame, keep: int | None = None) -> DataFrame:
    """Curated rows of a stream of bronze comments that are newer than all earlier versions of their comment.

    ``keep`` is the number of seconds after which a comment's state is forgotten; without it, state is kept for good.
    The query needs the state store of :func:`drain_latest` and the output mode ``update``.
    """
    rows = has_required_fields(curate(bronze))
    if keep is not None:
        return _changes_kept_for(rows, keep)
    # Of equal ranks the one that came first stays, so that a version that comes again is not given out again.
    order = F.struct(*_RANK, (-F.unix_micros(_ARRIVED)).alias("sooner"))
    held = F.struct(*[name for name in rows.columns if name != KEY], _ARRIVED)
    arrived = _ranked(rows).withColumn(_ARRIVED, F.current_timestamp())
    newest = arrived.groupBy(KEY).agg(F.max_by(held, order).alias("newest")).select(KEY, "newest.*")
    # The time is the micro-batch's: one in all its rows, and the same one when the micro-batch is repeated.
    return newest.filter(F.col(_ARRIVED) == F.current_timestamp()).select(rows.columns)


def drain_latest(bronze: DataFrame, path: str, checkpoint: str, keep: int | None = None, dealt: int = buckets.BUCKETS) -> dict[str, int]:
    """Run the stream to the end of what is available and keep the store of latest versions; returns what changed."""
    spark = bronze.sparkSession
    totals = {"upserted_documents": 0, "modified_documents": 0, "buckets_written": 0}

    def write(batch: DataFrame, batch_id: int) -> None:
        found = buckets.upsert(batch.sparkSession, path, batch, [KEY], dealt)
        for name in totals:
            totals[name] += found[name]

    before = {name: spark.conf.get(name, None) for name in _STORE_CONF}
    for name, value in _STORE_CONF.items():
        spark.conf.set(name, value)
    try:
        query = (
            latest_changes(bronze, keep)
            .writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)
    return totals


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest version of every comment that the stream has seen."""
    return buckets.read(spark, path)
