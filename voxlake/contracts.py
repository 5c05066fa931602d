"""Table contracts: zone, partitioning, key and ordered columns; alignment of frames to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column sets shared by several tables. A name alone is a string column.
_METRICS = (
    "comments_count bigint, positive_comments bigint, neutral_comments bigint, negative_comments bigint, "
    "avg_sentiment_score double, avg_sentiment_confidence double, avg_negative_probability double, "
    "avg_neutral_probability double, avg_positive_probability double, positive_ratio double, negative_ratio double, "
    "total_comment_likes bigint, avg_comment_likes double"
)
_BRONZE_COMMENT = (
    "run_id, collection_date, ingested_at, platform, ingestion_type, manifest_path, normalized_comments_path, "
    "plan_path, query_id, query_text, topic, genre, cadence, priority bigint, expected_units bigint, video_id, "
    "video_title, channel_title, video_published_at, video_url, thread_id, comment_id, comment_text, "
    "comment_like_count bigint, comment_published_at, comment_updated_at, reply_count bigint, "
    "author_display_name, author_channel_id, language_target, raw_record_json"
)
_STREAM_COMMENT = (
    "run_id, collection_date, ingested_at, platform, ingestion_type, kafka_topic, kafka_partition bigint, "
    "kafka_offset bigint, producer_run_id, event_id, manifest_path, normalized_comments_path, plan_path, query_id, "
    "query_text, topic, genre, cadence, priority bigint, expected_units bigint, video_id, video_title, "
    "video_description, channel_id, channel_title, video_published_at, video_url, thread_id, comment_id, "
    "comment_text, comment_like_count bigint, comment_published_at, comment_updated_at, reply_count bigint, "
    "author_display_name, author_channel_id, raw_record_json, load_id"
)
_SILVER_COMMENT = (
    "run_id, collection_date date, ingested_at timestamp, platform, ingestion_type, source_table, topic, genre, "
    "query_id, query_text, video_id, video_title, video_description, video_published_at timestamp, video_url, "
    "channel_id, channel_title, comment_id, comment_text, comment_like_count bigint, "
    "comment_published_at timestamp, comment_updated_at timestamp, reply_count bigint, author_display_name, "
    "author_channel_id, kafka_topic, kafka_partition int, kafka_offset bigint, producer_run_id, event_id"
)
_RUN_LOG = (
    "run_id, collection_date, executed_at, ingestion_type, manifest_path, normalized_comments_path, plan_path, "
    "queries_executed bigint, total_comments_collected bigint, ingested_records bigint, error_count bigint, "
    "status, target_comments_table, target_runs_table"
)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class TableContract:
    zone: str
    name: str
    partition_by: tuple[str, ...]
    columns: str
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        fields = []
        for part in self.columns.split(","):
            name, _, dtype = part.strip().partition(" ")
            fields.append(T.StructField(name, _TYPES[dtype or "string"], True))
        return T.StructType(fields)

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.zone}/{self.name}"


def _contracts(*items: TableContract) -> dict[str, TableContract]:
    return {f"{item.zone}.{item.name}": item for item in items}


CONTRACTS = _contracts(
    TableContract(
        "bronze",
        "youtube_comments_raw",
        ("ingestion_type",),
        "source_run_id, ingestion_type, query_id, query_text, topic, genre, thread_id, record_type, video_id, "
        "channel_id, comment_id, parent_comment_id, author_name, author_channel_id, text, like_count bigint, "
        "reply_count bigint, published_at, fetched_at, language_target, detected_language_label, "
        "detected_language_code",
    ),
    TableContract("bronze", "youtube_comments_daily_raw", ("collection_date",), _BRONZE_COMMENT),
    TableContract(
        "bronze", "youtube_comments_kafka_raw", ("collection_date", "load_id"), _STREAM_COMMENT
    ),
    TableContract("bronze", "daily_ingestion_runs", ("collection_date", "ingestion_type"), _RUN_LOG),
    TableContract(
        "bronze",
        "kafka_ingestion_runs",
        ("load_id",),
        "run_id, load_id, batch_id bigint, collection_date, executed_at, topic, ingestion_type, messages_consumed bigint, "
        "records_written bigint, target_comments_table, target_runs_table, error_count bigint, status",
    ),
    TableContract(
        "bronze",
        "ingestion_runs",
        ("ingestion_mode",),
        "run_id, run_date, source_name, ingestion_mode, plan_date, query_id, query_text, topic, genre, "
        "expected_units bigint, videos_fetched bigint, records_fetched bigint, records_written bigint, "
        "error_count bigint, status, error_message, created_at",
    ),
    TableContract(
        "silver", "youtube_comments_silver", ("collection_date",), _SILVER_COMMENT + ", processed_at timestamp",
        ("comment_id",),
    ),
    TableContract(
        "silver",
        "youtube_comments_sentiment",
        ("collection_date",),
        "run_id, collection_date, ingested_at, platform, ingestion_type, query_id, query_text, topic, genre, "
        "video_id, video_title, channel_title, comment_id, comment_text, comment_like_count bigint, "
        "reply_count bigint, comment_published_at, author_display_name, language_target, sentiment_score double, "
        "sentiment_label, sentiment_confidence double, positive_probability double, neutral_probability double, "
        "negative_probability double, sentiment_model, positive_hits bigint, negative_hits bigint, "
        "token_count bigint, processed_at",
        ("comment_id",),
    ),
    TableContract(
        "gold",
        "collection_daily_summary",
        (),
        "run_date, source_name, ingestion_mode, topic, genre, queries_executed bigint, total_videos_fetched bigint, "
        "total_records_fetched bigint, total_records_written bigint, total_error_count bigint, created_at",
    ),
    TableContract(
        "gold",
        "query_performance_summary",
        (),
        "run_date, run_id, query_id, query_text, topic, genre, expected_units bigint, videos_fetched bigint, "
        "records_fetched bigint, records_written bigint, error_count bigint, collection_status, created_at",
    ),
    TableContract(
        "gold",
        "dashboard_overview_daily",
        (),
        "run_date, source_name, ingestion_mode, topics_covered bigint, genres_covered bigint, "
        "queries_executed bigint, successful_queries bigint, partial_success_queries bigint, "
        "failed_queries bigint, no_data_queries bigint, unique_queries_seen bigint, total_videos_fetched bigint, "
        "total_records_fetched bigint, total_records_written bigint, total_error_count bigint, created_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_daily_summary",
        ("collection_date",),
        f"collection_date, topic, genre, {_METRICS}, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_video_summary",
        ("collection_date",),
        f"collection_date, topic, genre, video_id, video_title, channel_title, {_METRICS}, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_topic_summary",
        ("genre",),
        f"topic, genre, collection_dates_seen bigint, videos_covered bigint, {_METRICS}, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_daily_trend",
        ("collection_date",),
        f"collection_date, topic, genre, videos_covered bigint, {_METRICS}, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_weekday_hour_engagement",
        ("collection_date",),
        "collection_date, topic, genre, weekday_name, comment_hour_24 bigint, videos_covered bigint, "
        f"{_METRICS}, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_keyword_frequency",
        ("collection_date",),
        "collection_date, topic, genre, keyword, keyword_count bigint, distinct_comments bigint, "
        "avg_sentiment_score double, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_overview_kpis",
        ("collection_date",),
        "collection_date, platform, topics_covered bigint, genres_covered bigint, videos_covered bigint, "
        f"{_METRICS}, built_at",
    ),
    TableContract(
        "gold",
        "youtube_sentiment_day_states",
        ("collection_date",),
        "collection_date, platform, topic, genre, video_id, comment_rows bigint, comment_ids bigint, "
        "positive_comments bigint, neutral_comments bigint, negative_comments bigint, sentiment_score double, "
        "sentiment_confidence double, negative_probability double, neutral_probability double, "
        "positive_probability double, comment_like_count bigint, built_at",
    ),
    TableContract(
        "gold",
        "youtube_comments_daily_topic_metrics",
        (),
        "metric_date date, topic, genre, comment_count bigint, distinct_videos bigint, avg_sentiment_score double, "
        "positive_comments bigint, neutral_comments bigint, negative_comments bigint, "
        "avg_sentiment_confidence double, avg_negative_probability double, avg_neutral_probability double, "
        "avg_positive_probability double, total_like_count bigint, total_reply_count bigint, avg_like_count double, "
        "built_at timestamp",
    ),
    TableContract(
        "gold",
        "youtube_comments_forecast_summary",
        (),
        "topic, genre, history_days bigint, total_comments bigint, history_start_date date, history_end_date date, "
        "avg_daily_comments double, avg_daily_sentiment double, stddev_daily_comments double, "
        "stddev_daily_sentiment double, is_forecast_eligible boolean, forecast_method, built_at timestamp",
    ),
    TableContract(
        "gold",
        "youtube_comments_forecast_7d",
        (),
        "topic, genre, forecast_date date, horizon_day int, forecast_comment_count double, "
        "forecast_sentiment_score double, model_name, history_days_used int, built_at timestamp",
    ),
)


def _coerced(column: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return column
    if isinstance(target, T.StringType):
        if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(column)
        return column.cast(target)
    if isinstance(target, (T.LongType, T.IntegerType)):
        as_double = column.try_cast("double")
        whole = F.when(as_double == F.floor(as_double), as_double).try_cast(target)
        fractional = isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType))
        return whole if fractional else F.coalesce(column.try_cast(target), whole)
    return column.try_cast(target)


def align(df: DataFrame, contract: TableContract) -> DataFrame:
    """Contract columns in contract order: missing ones null, others dropped, bad values null."""
    types = {field.name: field.dataType for field in df.schema}
    return df.select(
        [
            (
                _coerced(F.col(field.name), types[field.name], field.dataType)
                if field.name in types
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in contract.schema
        ]
    )
