"""Collection runs: performance, summaries, overview, ingestion totals, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import case, errors, rounded, scratch, sql, summaries, view
from voxlake.operators import descriptive, prescriptive, runs
from voxlake.plans import jobs
from voxlake.sinks.tables import write_contract
from voxlake.sources.tables import read_contract

view(
    "err_index",
    """SELECT run_id, query_id, count(*) AS error_count,
    string_agg(error, '; ' ORDER BY position, error) AS messages FROM errs GROUP BY ALL""",
    "errs",
)
_OUTCOME = """CASE WHEN comments_count > 0 AND coalesce(error_count, 0) = 0 THEN 'success'
      WHEN comments_count > 0 THEN 'partial_success' WHEN coalesce(error_count, 0) > 0 THEN 'failed' ELSE 'no_data' END"""
view(
    "perf",
    f"""SELECT run_date, s.run_id, s.query_id, query_text, topic, genre, expected_units, videos_count AS videos_fetched,
    comments_count AS records_fetched, comments_count AS records_written, coalesce(error_count, 0) AS error_count,
    {_OUTCOME} AS collection_status, created_at
  FROM summ s LEFT JOIN err_index e ON e.run_id = s.run_id AND e.query_id = s.query_id""",
    "summ",
    "err_index",
)
view(
    "cds",
    """SELECT run_date, topic, genre, count(DISTINCT query_id) AS queries_executed,
    CAST(sum(videos_fetched) AS BIGINT) AS total_videos_fetched,
    CAST(sum(records_fetched) AS BIGINT) AS total_records_fetched,
    CAST(sum(records_written) AS BIGINT) AS total_records_written,
    CAST(sum(error_count) AS BIGINT) AS total_error_count, max(created_at) AS created_at,
    'youtube' AS source_name, 'daily_api' AS ingestion_mode
  FROM perf GROUP BY run_date, topic, genre""",
    "perf",
)
view(
    "run_totals",
    """SELECT run_date, source_name, ingestion_mode, count(DISTINCT topic) AS topics_covered,
    count(DISTINCT genre) AS genres_covered, CAST(sum(queries_executed) AS BIGINT) AS queries_executed,
    CAST(sum(total_videos_fetched) AS BIGINT) AS total_videos_fetched,
    CAST(sum(total_records_fetched) AS BIGINT) AS total_records_fetched,
    CAST(sum(total_records_written) AS BIGINT) AS total_records_written,
    CAST(sum(total_error_count) AS BIGINT) AS total_error_count, max(created_at) AS created_at
  FROM cds GROUP BY run_date, source_name, ingestion_mode""",
    "cds",
)
view(
    "overview",
    """SELECT t.*, coalesce(successful_queries, 0) AS successful_queries,
    coalesce(partial_success_queries, 0) AS partial_success_queries, coalesce(failed_queries, 0) AS failed_queries,
    coalesce(no_data_queries, 0) AS no_data_queries, coalesce(unique_queries_seen, 0) AS unique_queries_seen
  FROM run_totals t LEFT JOIN (
    SELECT run_date, count(*) FILTER (collection_status = 'success') AS successful_queries,
      count(*) FILTER (collection_status = 'partial_success') AS partial_success_queries,
      count(*) FILTER (collection_status = 'failed') AS failed_queries,
      count(*) FILTER (collection_status = 'no_data') AS no_data_queries,
      count(DISTINCT query_id) AS unique_queries_seen
    FROM perf GROUP BY run_date) s USING (run_date)""",
    "run_totals",
)


def performance(spark, d):
    return runs.query_performance(summaries(spark, d), errors(spark, d))


def collection(spark, d):
    return runs.collection_daily_summary(performance(spark, d))


@case("query_performance", sql("SELECT * FROM perf", "perf"))
def _performance(spark, d):
    return performance(spark, d)


@case(
    "ingestion_run_rows",
    sql(
        f"""SELECT s.run_id, run_date, 'youtube' AS source_name, 'daily_api' AS ingestion_mode, plan_date, s.query_id,
    query_text, topic, genre, expected_units, videos_count AS videos_fetched, comments_count AS records_fetched,
    comments_count AS records_written, coalesce(error_count, 0) AS error_count, {_OUTCOME} AS status,
    coalesce(messages, '') AS error_message, created_at
  FROM summ s LEFT JOIN err_index e ON e.run_id = s.run_id AND e.query_id = s.query_id""",
        "summ",
        "err_index",
    ),
)
def _ingestion(spark, d):
    return runs.ingestion_runs(summaries(spark, d), errors(spark, d))


@case(
    "error_index",
    sql("SELECT run_id, query_id, error_count, messages FROM err_index", "err_index"),
)
def _errors(spark, d):
    index = runs.error_index(errors(spark, d))
    return index.select("run_id", "query_id", "error_count", F.array_join("messages", "; ").alias("messages"))


@case("collection_daily_summary", sql("SELECT * FROM cds", "cds"))
def _collection(spark, d):
    return collection(spark, d)


@case("run_totals", sql("SELECT * FROM run_totals", "run_totals"))
def _totals(spark, d):
    return runs.run_totals(collection(spark, d))


@case("run_overview_join", sql("SELECT * FROM overview", "overview"))
def _overview(spark, d):
    rows = performance(spark, d)
    return runs.run_overview(runs.collection_daily_summary(rows), rows)


@case("collection_metrics_job", sql("SELECT * FROM overview", "overview"))
def _metrics_job(spark, d):
    root = scratch(spark, "lakehouse")
    jobs.collection_metrics(spark, root, summaries(spark, d), errors(spark, d))
    return read_contract(spark, root, "gold.dashboard_overview_daily")


@case("run_overview_job", sql("SELECT * FROM overview", "overview"))
def _overview_job(spark, d):
    root = scratch(spark, "lakehouse")
    rows = runs.query_performance(summaries(spark, d), errors(spark, d))
    write_contract(rows, "gold.query_performance_summary", root)
    write_contract(runs.collection_daily_summary(rows), "gold.collection_daily_summary", root)
    jobs.overview_gold(spark, root)
    return read_contract(spark, root, "gold.dashboard_overview_daily")


view(
    "ingest",
    """SELECT run_date AS run_date_label, CAST(sum(total_records_written) AS BIGINT) AS written_records,
    CAST(sum(total_videos_fetched) AS BIGINT) AS fetched_videos FROM cds GROUP BY run_date""",
    "cds",
)


@case(
    "ingestion_running_total",
    sql(
        """SELECT *, CAST(sum(written_records) OVER (ORDER BY run_date_label) AS BIGINT) AS cumulative_records
  FROM ingest""",
        "ingest",
    ),
)
def _running(spark, d):
    return descriptive.ingestion_trend(collection(spark, d))


@case(
    "ingestion_headline",
    sql(
        """SELECT max(run_date_label) AS latest_run_date, max_by(written_records, run_date_label) AS today_written,
    CAST(sum(written_records) AS BIGINT) AS total_written FROM ingest""",
        "ingest",
    ),
)
def _headline(spark, d):
    return descriptive.ingestion_headline(descriptive.ingestion_trend(collection(spark, d)))


@case(
    "query_efficiency",
    sql(
        """SELECT run_id, query_id, topic, genre, records_written,
    round(CASE WHEN expected_units > 0 THEN records_written / expected_units ELSE 0 END, 6) AS efficiency_ratio
  FROM perf""",
        "perf",
    ),
)
def _efficiency(spark, d):
    out = prescriptive.efficiency(performance(spark, d))
    return rounded(
        out.select(
            "run_id", "query_id", "topic", "genre", F.col("records_written").cast("bigint").alias("records_written"),
            "efficiency_ratio",
        )
    )


@case(
    "collection_recommendations",
    sql(
        """SELECT 'Query ''' || query_id || ''' is underperforming for topic ''' || topic
    || '''. Rewrite or deprioritize it.' AS recommendation
  FROM perf ORDER BY CASE WHEN expected_units > 0 THEN records_written / expected_units ELSE 0 END, records_written,
    query_id, topic, run_date, genre LIMIT 3""",
        "perf",
    ),
)
def _recommend(spark, d):
    return prescriptive.recommendations(performance(spark, d))
