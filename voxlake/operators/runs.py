"""Collection run marts: errors, query performance, daily summary, overview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions.numeric import outcome

_KEYS = ["run_id", "query_id"]


def keyed_errors(errors: DataFrame) -> DataFrame:
    """Errors with the default key and message filled in."""
    return errors.withColumns(
        {
            "query_id": F.coalesce(F.col("query_id").cast("string"), F.lit("unknown")),
            "error": F.coalesce(F.col("error").cast("string"), F.lit("unknown_error")),
        }
    )


def error_index(errors: DataFrame) -> DataFrame:
    """Messages of each query in order of occurrence, with their number.

    One array per query and run is the result itself; its length is the number of failed calls of that query,
    which the plan's per-query limits bound.
    """
    listed = F.array_sort(F.collect_list(F.struct("position", "error")))
    return (
        keyed_errors(errors)
        .groupBy(*_KEYS)
        .agg(listed.alias("_errors"))
        .select(*_KEYS, F.col("_errors.error").alias("messages"), F.size("_errors").cast("bigint").alias("error_count"))
    )


def error_counts(errors: DataFrame) -> DataFrame:
    return keyed_errors(errors).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("error_count"))


def _with_errors(summaries: DataFrame, index: DataFrame) -> DataFrame:
    return (
        summaries.withColumn("query_id", F.col("query_id").cast("string"))
        .join(index, _KEYS, "left")
        .withColumns(
            {
                "error_count": F.coalesce("error_count", F.lit(0)).cast("bigint"),
                "comments_count": F.col("comments_count").cast("bigint"),
            }
        )
    )


def query_performance(summaries: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per query and run with counts and outcome."""
    return performance_rows(_with_errors(summaries, error_counts(errors)))


def performance_rows(collected: DataFrame) -> DataFrame:
    """Query performance from summaries that have their errors."""
    return collected.select(
        "run_date",
        "run_id",
        "query_id",
        "query_text",
        "topic",
        "genre",
        F.col("expected_units").cast("bigint").alias("expected_units"),
        F.col("videos_count").cast("bigint").alias("videos_fetched"),
        F.col("comments_count").alias("records_fetched"),
        F.col("comments_count").alias("records_written"),
        "error_count",
        outcome(F.col("comments_count"), F.col("error_count")).alias("collection_status"),
        "created_at",
    )


def with_messages(summaries: DataFrame, errors: DataFrame) -> DataFrame:
    """Summaries with the messages and the number of their errors, from which both tables of queries follow."""
    # Only messages of queries that have a row are gathered, so errors without a query id do not meet in one list.
    asked = summaries.select("run_id", F.col("query_id").cast("string").alias("query_id")).distinct()
    return _with_errors(summaries, error_index(keyed_errors(errors).join(asked, _KEYS, "left_semi")))


def ingestion_runs(summaries: DataFrame, errors: DataFrame) -> DataFrame:
    """The same rows for the bronze run table, with the joined error messages."""
    return ingestion_rows(with_messages(summaries, errors))


def ingestion_rows(collected: DataFrame) -> DataFrame:
    """Rows of the bronze run table from summaries that have their errors."""
    return collected.select(
        "run_id",
        "run_date",
        F.lit("youtube").alias("source_name"),
        F.lit("daily_api").alias("ingestion_mode"),
        "plan_date",
        "query_id",
        "query_text",
        "topic",
        "genre",
        F.col("expected_units").cast("bigint").alias("expected_units"),
        F.col("videos_count").cast("bigint").alias("videos_fetched"),
        F.col("comments_count").alias("records_fetched"),
        F.col("comments_count").alias("records_written"),
        "error_count",
        outcome(F.col("comments_count"), F.col("error_count")).alias("status"),
        F.coalesce(F.array_join("messages", "; "), F.lit("")).alias("error_message"),
        "created_at",
    )


def collection_daily_summary(performance: DataFrame, created_at: str | None = None) -> DataFrame:
    """Queries and records per run date, topic and genre."""
    for key in ("run_date", "topic", "genre"):
        performance = performance.filter(F.col(key).isNotNull())
    stamp = F.max("created_at") if created_at is None else F.lit(created_at)
    return (
        performance.groupBy("run_date", "topic", "genre")
        .agg(
            F.count_distinct("query_id").alias("queries_executed"),
            F.sum("videos_fetched").alias("total_videos_fetched"),
            F.sum("records_fetched").alias("total_records_fetched"),
            F.sum("records_written").alias("total_records_written"),
            F.sum("error_count").alias("total_error_count"),
            stamp.alias("created_at"),
        )
        .withColumns({"source_name": F.lit("youtube"), "ingestion_mode": F.lit("daily_api")})
    )


def run_totals(collection: DataFrame) -> DataFrame:
    """Coverage and sums per run date, source and mode."""
    keys = ["run_date", "source_name", "ingestion_mode"]
    for key in keys:
        collection = collection.filter(F.col(key).isNotNull())
    sums = ("queries_executed total_videos_fetched total_records_fetched total_records_written "
            "total_error_count").split()
    return collection.groupBy(*keys).agg(
        F.count_distinct("topic").alias("topics_covered"),
        F.count_distinct("genre").alias("genres_covered"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in sums],
        F.max("created_at").alias("created_at"),
    )


# Overview column per query status.
_STATUS = {
    "success": "successful_queries",
    "partial_success": "partial_success_queries",
    "failed": "failed_queries",
    "no_data": "no_data_queries",
}


def status_counts(performance: DataFrame) -> DataFrame:
    """Queries by outcome per run date."""
    return (
        performance.filter(F.col("run_date").isNotNull())
        .groupBy("run_date")
        .agg(
            *[F.count_if(F.col("collection_status") == status).alias(name) for status, name in _STATUS.items()],
            F.count_distinct("query_id").alias("unique_queries_seen"),
        )
    )


def run_overview(collection: DataFrame, performance: DataFrame) -> DataFrame:
    """Run totals with the day's status counts; days without query rows count 0."""
    counts = [*_STATUS.values(), "unique_queries_seen"]
    as_text = lambda df: df.withColumn("run_date", F.col("run_date").cast("string"))
    joined = run_totals(as_text(collection)).join(status_counts(as_text(performance)), "run_date", "left")
    return joined.fillna(0, counts)


__all__ = [
    "collection_daily_summary",
    "error_counts",
    "error_index",
    "ingestion_runs",
    "keyed_errors",
    "query_performance",
    "run_overview",
    "run_totals",
    "status_counts",
]
