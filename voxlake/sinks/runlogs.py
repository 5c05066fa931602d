"""One row per run: what was read, prepared and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS
from voxlake.functions.columns import date_part, safe_int, safe_text

COMMENTS_TABLE = "bronze.youtube_comments_daily_raw"
RUNS_TABLE = "bronze.daily_ingestion_runs"


def daily_run_log(manifests: DataFrame, comments: DataFrame, executed_at: str, root: str = "") -> DataFrame:
    """Run rows of the daily bronze load: one per manifest, with the number of its comment rows."""
    written = comments.groupBy("manifest_path").agg(F.count(F.lit(1)).alias("ingested_records"))
    rows = manifests.join(written, "manifest_path", "left")
    return rows.select(
        safe_text(F.col("run_id")).alias("run_id"),
        date_part(safe_text(F.col("generated_at"), executed_at)).alias("collection_date"),
        F.lit(executed_at).alias("executed_at"),
        F.lit("youtube_daily_api_to_bronze").alias("ingestion_type"),
        safe_text(F.col("manifest_path")).alias("manifest_path"),
        safe_text(F.col("normalized_comments_path")).alias("normalized_comments_path"),
        safe_text(F.col("plan_path")).alias("plan_path"),
        safe_int(F.col("queries_executed")).alias("queries_executed"),
        safe_int(F.col("total_comments_collected")).alias("total_comments_collected"),
        F.coalesce("ingested_records", F.lit(0)).cast("bigint").alias("ingested_records"),
        safe_int(F.col("error_count")).alias("error_count"),
        F.lit("success").alias("status"),
        F.lit(CONTRACTS[COMMENTS_TABLE].path(root)).alias("target_comments_table"),
        F.lit(CONTRACTS[RUNS_TABLE].path(root)).alias("target_runs_table"),
    )


def collection_run_log(
    spark: SparkSession,
    read: int,
    written: int,
    run_id: str,
    executed_at: str,
    source: str,
    dry_run: bool = False,
    collection_date: str | None = None,
    limit: int | None = None,
    root: str = "",
) -> DataFrame:
    """The run row of a document-store load from its counts of documents read and rows written."""
    kind = "youtube_mongo_raw_to_bronze"
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(executed_at[:10]).alias("collection_date"),
        F.lit(executed_at).alias("executed_at"),
        F.lit(f"{kind}_dry_run" if dry_run else kind).alias("ingestion_type"),
        F.lit(source).alias("manifest_path"),
        F.lit(f"mongo_collection_date={collection_date or 'all'};limit={limit or 'none'}").alias(
            "normalized_comments_path"
        ),
        F.lit("").alias("plan_path"),
        F.lit(0).cast("bigint").alias("queries_executed"),
        F.lit(read).cast("bigint").alias("total_comments_collected"),
        F.lit(written).cast("bigint").alias("ingested_records"),
        F.lit(0).cast("bigint").alias("error_count"),
        F.lit("dry_run" if dry_run else "success").alias("status"),
        F.lit(CONTRACTS[COMMENTS_TABLE].path(root)).alias("target_comments_table"),
        F.lit(CONTRACTS[RUNS_TABLE].path(root)).alias("target_runs_table"),
    )


def stream_run_log(batch: DataFrame, run_id: str, batch_id: int, executed_at: str, root: str = "") -> DataFrame:
    """Run rows of a stream consumer: one per micro-batch, topic and collection date."""
    return batch.groupBy("collection_date", F.col("kafka_topic").alias("topic"), "load_id").agg(
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(executed_at).alias("executed_at"),
        F.lit("youtube_kafka_to_bronze").alias("ingestion_type"),
        F.count(F.lit(1)).alias("messages_consumed"),
        F.count(F.lit(1)).alias("records_written"),
        F.lit(CONTRACTS["bronze.youtube_comments_kafka_raw"].path(root)).alias("target_comments_table"),
        F.lit(CONTRACTS["bronze.kafka_ingestion_runs"].path(root)).alias("target_runs_table"),
        F.lit(0).cast("bigint").alias("error_count"),
        F.lit("success").alias("status"),
    )


# Labels of the historical load.
HISTORICAL = {
    "query_id": "historical_youtube_dump_50k",
    "query_text": "historical archive bootstrap",
    "topic": "historical_archive",
    "genre": "mixed",
}


def historical_run_log(comments: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """The run row of a historical load, in which every fetched record is written."""
    return comments.agg(F.count(F.lit(1)).alias("records_fetched")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(created_at[:10]).alias("run_date"),
        F.lit("youtube").alias("source_name"),
        F.lit("historical_bootstrap").alias("ingestion_mode"),
        *[F.lit(value).alias(name) for name, value in HISTORICAL.items()],
        F.lit("success").alias("status"),
        "records_fetched",
        F.col("records_fetched").alias("records_written"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(created_at).alias("created_at"),
    )
