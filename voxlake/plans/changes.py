"""Changes carried from bronze into silver and the marts: only the dates that they touch are read and written.

An index, a bucketed store by comment id, holds for each silver comment its date and the order of its version. New rows
are curated among themselves, then meet their index entries, which are read from the buckets of their keys alone. What
is newer is a change ``(comment id, old date, new date)``: the old date's partition loses the row, the new date's gets
it. A date that loses its last row loses its partition.

Every step can be repeated: the index is written last, so a run that died before finds the same changes again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS, align
from voxlake.operators import forecast, marts, silver
from voxlake.session import delete_path, discard, staged
from voxlake.sinks import buckets
from voxlake.sinks.tables import overwrite
from voxlake.sources.tables import DEFAULT_FORMAT, read_contract

SILVER = "silver.youtube_comments_silver"
SCORED = "silver.youtube_comments_sentiment"
METRICS = "gold.youtube_comments_daily_topic_metrics"
KEY = ("comment_id",)
_TIMES = ("comment_updated_at", "comment_published_at", "ingested_at")
Days = Iterable[str | None]


def on_days(day: Column, days: Days) -> Column:
    """Whether a day is one of the days; null is a day of its own."""
    days = list(days)
    known = F.coalesce(day.cast("string").isin([d for d in days if d is not None]), F.lit(False))
    return known | day.isNull() if None in days else known


def in_order(days: Days) -> list[str | None]:
    return sorted(set(days), key=lambda day: (day is not None, day))


def index_path(root: str) -> str:
    return CONTRACTS[SILVER].path(root) + "_index"


def _entries(rows: DataFrame) -> DataFrame:
    """Index entries of silver rows: date, version times, and the hash that settles equal times."""
    plain = [f.name for f in CONTRACTS[SILVER].schema if f.name != "processed_at"]
    return rows.select("comment_id", F.col("collection_date").cast("string").alias("day"), *_TIMES, F.xxhash64(*plain).alias("row_hash"))


def _rank(prefix: str) -> Column:
    """Greater for the version that silver keeps (see ``latest_versions``)."""
    times = [F.col(f"{prefix}.{name}").alias(name) for name in _TIMES]
    return F.struct(*times, F.bitwise_not(F.col(f"{prefix}.row_hash")).alias("tie"))


def build_index(spark: SparkSession, root: str, fmt: str = DEFAULT_FORMAT, dealt: int = buckets.BUCKETS) -> None:
    """The index of the silver table as it is."""
    drop_index(spark, root)
    buckets.upsert(spark, index_path(root), _entries(read_contract(spark, root, SILVER, fmt)), KEY, dealt)


def drop_index(spark: SparkSession, root: str) -> None:
    """For whoever rewrites silver as a whole; the next change builds the index anew."""
    delete_path(spark, index_path(root))


def replace_days(spark: SparkSession, rows: DataFrame, key: str, root: str, days: Days, fmt: str = DEFAULT_FORMAT) -> str:
    """``rows`` in the place of what a table partitioned by date has on these days; days without rows go."""
    contract = CONTRACTS[key]
    (by,) = contract.partition_by
    days = list(days)
    fresh = staged(align(rows, contract).filter(on_days(F.col(by), days)), "days")
    present = {row[0] for row in fresh.select(F.col(by).cast("string")).distinct().collect()}
    path = contract.path(root)
    if present:
        overwrite(fresh, path, contract.partition_by, fmt, only_touched_partitions=True)
    for day in set(days) - present:
        # Fixed value: the folder of rows without a partition value.
        delete_path(spark, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")
    discard(fresh)
    return path


def apply_to_silver(spark: SparkSession, root: str, new_rows: DataFrame, at: Column | None = None, fmt: str = DEFAULT_FORMAT) -> dict:
    """Bring bronze rows (as ``union_bronze`` gives them) into silver; returns counts and the days that changed."""
    if buckets.read(spark, index_path(root)) is None:
        build_index(spark, root, fmt)
    latest = staged(silver.build_silver(new_rows, F.current_timestamp() if at is None else at), "latest")
    # Values as the silver table will hold them, so that hashes agree with those of rows read from it.
    fresh = align(latest, CONTRACTS[SILVER])
    entries = _entries(fresh).alias("n")
    known = buckets.matching(spark, index_path(root), fresh, KEY)
    stored = known.alias("o") if known is not None else entries.limit(0).alias("o")
    joined = entries.join(stored, F.col("n.comment_id") == F.col("o.comment_id"), "left")
    newer = F.col("o.comment_id").isNull() | (_rank("n") > _rank("o"))
    changes = staged(
        joined.filter(newer).select(
            F.col("n.comment_id").alias("comment_id"),
            F.col("o.comment_id").isNotNull().alias("known"),
            F.col("o.day").alias("old_day"),
            F.col("n.day").alias("new_day"),
        ),
        "changes",
    )
    # A few values: collection days, not comments.
    days = {r[0] for r in changes.filter("known").select("old_day").distinct().collect()}
    days = in_order(days | {r[0] for r in changes.select("new_day").distinct().collect()})
    written = 0
    if days:
        ids = changes.select("comment_id")
        winners = fresh.join(ids, "comment_id", "left_semi")
        kept = read_contract(spark, root, SILVER, fmt).filter(on_days(F.col("collection_date"), days)).join(ids, "comment_id", "left_anti")
        replace_days(spark, kept.unionByName(winners), SILVER, root, days, fmt)
        buckets.upsert(spark, index_path(root), _entries(winners), KEY)
        written = ids.count()
    discard(latest, changes)
    return {"silver_path": CONTRACTS[SILVER].path(root), "rows_written": written, "days": days}


def apply_to_mart(spark: SparkSession, root: str, key: str, build, days: Days, at: str, fmt: str = DEFAULT_FORMAT) -> str:
    """A mart by collection date, for these days only."""
    scored = read_contract(spark, root, SCORED, fmt).filter(on_days(F.col("collection_date"), days))
    return replace_days(spark, build(scored, unique_ids=True, built_at=at), key, root, days, fmt)


def apply_to_metrics(spark: SparkSession, root: str, days: Days, fmt: str = DEFAULT_FORMAT) -> dict[str, str]:
    """Daily topic metrics of these days, then summary and forecast from the table of metrics.

    Comments without a date count on the day of their publication, so their partition is read along. Where they are what
    changed, any day may have: then the metrics are those of the whole scored table.
    """
    contract, now = CONTRACTS[METRICS], F.current_timestamp()
    scored = read_contract(spark, root, SCORED, fmt)
    days = list(days)
    if None not in days:
        near = scored.filter(on_days(F.col("collection_date"), [*days, None]))
        fresh = marts.daily_topic_metrics(near, unique_ids=True, built_at=now).filter(on_days(F.col("metric_date"), days))
        kept = read_contract(spark, root, METRICS, fmt).filter(~on_days(F.col("metric_date"), days))
        fresh = align(fresh, contract).unionByName(kept)
    else:
        fresh = align(marts.daily_topic_metrics(scored, unique_ids=True, built_at=now), contract)
    table = staged(fresh, "metrics")
    overwrite(table, contract.path(root), (), fmt)
    discard(table)
    daily = read_contract(spark, root, METRICS, fmt)
    out = {METRICS: contract.path(root)}
    for key, frame in {
        "gold.youtube_comments_forecast_summary": forecast.forecast_summary(daily, built_at=now),
        "gold.youtube_comments_forecast_7d": forecast.topic_forecast(daily, built_at=now),
    }.items():
        overwrite(align(frame, CONTRACTS[key]), CONTRACTS[key].path(root), (), fmt)
        out[key] = CONTRACTS[key].path(root)
    return out
