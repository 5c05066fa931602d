"""The medallion jobs.

Stages hand over through written tables, so a lost executor costs a retried task and never a recomputed chain.
Where one input feeds several marts it is a table too: every mart scans only the columns it needs.
Counts that a job reports are observed while writing, not by extra scans.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS
from voxlake.functions.columns import as_date
from voxlake.operators import bronze, forecast, marts, planning, runs, scoring, silver
from voxlake.plans import changes
from voxlake.session import discard, staged
from voxlake.sinks import buckets
from voxlake.sinks.runlogs import collection_run_log, daily_run_log, historical_run_log
from voxlake.sinks.tables import append, write_contract
from voxlake.sinks.upsert import PRESENT, field_by_field, merge_rows, upsertable
from voxlake.sources.docstore import scan_collection
from voxlake.sources.documents import limit_per_source, source_summary
from voxlake.sources.tables import DEFAULT_FORMAT, read_contract, read_if_exists

DAILY = "bronze.youtube_comments_daily_raw"
STREAMED = "bronze.youtube_comments_kafka_raw"
SILVER = "silver.youtube_comments_silver"
SCORED = "silver.youtube_comments_sentiment"

SENTIMENT_MARTS = {
    "gold.youtube_sentiment_daily_summary": marts.daily_summary,
    "gold.youtube_sentiment_video_summary": marts.video_summary,
}
STATES = "gold.youtube_sentiment_day_states"
DESCRIPTIVE_MARTS = {
    STATES: marts.day_states,
    "gold.youtube_sentiment_weekday_hour_engagement": marts.weekday_hour,
    "gold.youtube_sentiment_keyword_frequency": marts.keyword_frequency,
}
#: Marts that follow from the states of days, with no further scan of the comments.
MARTS_FROM_STATES = {
    "gold.youtube_sentiment_topic_summary": "topic_summary",
    "gold.youtube_sentiment_daily_trend": "daily_trend",
    "gold.youtube_sentiment_overview_kpis": "overview_kpis",
}


def now_iso() -> str:
    return dt.datetime.now(dt.UTC).isoformat()


def _observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and further metrics) while the frame is being written."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    named = [metric.alias(name) for name, metric in metrics.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *named), seen


def _rows(seen: Observation, metric: str = "rows") -> int:
    """An observed count."""
    return int(seen.get.get(metric) or 0)


def _load_daily(
    spark: SparkSession, root: str, records: DataFrame, manifests: DataFrame, plan: DataFrame | None, at: str, fmt: str
) -> tuple[dict[str, Any], DataFrame]:
    """Append what is new to the daily bronze table and log it; also gives the new rows, a staged frame."""
    contract = CONTRACTS[DAILY]
    rows = bronze.records_to_bronze(records, manifests, plan, at)
    target = read_if_exists(spark, contract.path(root), fmt, contract.schema if fmt == "parquet" else None)
    fresh = staged(bronze.missing_from(rows, target), "new-rows")
    append(fresh, contract.path(root), contract.partition_by, fmt)
    log = daily_run_log(manifests, fresh, at, root)
    runs_path = write_contract(log, "bronze.daily_ingestion_runs", root, "append", fmt, refuse_empty=False)
    out = {
        "comments_records_written": fresh.count(),
        "comments_table_path": contract.path(root),
        "runs_table_path": runs_path,
    }
    return out, fresh


def bronze_daily(
    spark: SparkSession,
    root: str,
    records: DataFrame,
    manifests: DataFrame,
    plan: DataFrame | None = None,
    at: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, Any]:
    """Run records to the bronze table, plus a run row per manifest.

    Rows whose key is in the table already are left out, so repeating a manifest adds nothing, and the run rows say so.
    What is new is a table before it is appended: the run rows count the same rows, and the input is evaluated once.
    """
    out, fresh = _load_daily(spark, root, records, manifests, plan, at or now_iso(), fmt)
    discard(fresh)
    return out


def bronze_collection(
    spark: SparkSession,
    root: str,
    documents: DataFrame,
    source: str,
    collection_date: str | None = None,
    limit: int | None = None,
    dry_run: bool = False,
    at: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, Any]:
    """Stored documents to the bronze table: scan, prepare, keep what is new, append, log."""
    at = at or now_iso()
    run_id = f"mongo-to-bronze-{at[:19].replace('-', '').replace(':', '')}Z"
    contract = CONTRACTS[DAILY]
    scanned = scan_collection(documents, collection_date, limit)
    prepared = staged(bronze.documents_to_bronze(scanned, at), "collection-rows")
    target = read_if_exists(spark, contract.path(root), fmt, contract.schema if fmt == "parquet" else None)
    fresh, seen = _observed(bronze.missing_from(prepared, target))
    read, kept = scanned.count(), prepared.count()
    if dry_run:
        new = fresh.count()
    else:
        append(fresh, contract.path(root), contract.partition_by, fmt)
        new = _rows(seen)
        log = collection_run_log(scanned.sparkSession, read, new, run_id, at, source, dry_run, collection_date, limit, root)
        write_contract(log, "bronze.daily_ingestion_runs", root, "append", fmt, refuse_empty=False)
    return {
        "run_id": run_id,
        "dry_run": dry_run,
        "collection_date_filter": collection_date or "all",
        "limit": limit or "none",
        "documents_read": read,
        "documents_prepared": kept,
        "existing_bronze_matches": kept - new,
        "comments_records_to_write": new,
        "comments_records_written": 0 if dry_run else new,
    }


def historical_load(
    spark: SparkSession, root: str, threads: DataFrame, at: str | None = None, fmt: str = DEFAULT_FORMAT
) -> dict[str, Any]:
    """Nested threads to the raw comment table (replaced), plus the run row."""
    at = at or now_iso()
    run_id = f"hist-{uuid.uuid4().hex[:12]}"
    rows, seen = _observed(bronze.flatten_threads(threads, run_id))
    key = "bronze.youtube_comments_raw"
    path = write_contract(rows, key, root, "overwrite", fmt, refuse_empty=False)
    log = historical_run_log(read_contract(spark, root, key, fmt), run_id, at)
    runs_path = write_contract(log, "bronze.ingestion_runs", root, "overwrite", fmt, refuse_empty=False)
    return {"run_id": run_id, "records_count": _rows(seen), "comments_table_path": path, "runs_table_path": runs_path}


def backfill(
    spark: SparkSession,
    sources: Sequence[DataFrame],
    store_path: str,
    new_store_path: str | None = None,
    limit_records: int | None = None,
    dry_run: bool = False,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, Any]:
    """Documents of all sources into the store by one keyed upsert over their union.

    Each source has ``source_type``, ``source_path`` and ``position``. The store is one of hash buckets
    (``voxlake.sinks.buckets``), of which those with a changed document are rewritten. With ``new_store_path`` it is a
    plain table instead, and the merged whole goes to that path; the caller points readers there. Returns the per-source
    summary and, unless ``dry_run``, the upsert counts.
    """
    limited = [limit_per_source(df, limit_records) for df in sources]
    marked = [df.withColumn(PRESENT, F.array(*map(F.lit, df.columns))) for df in limited]
    documents = silver.union_bronze({f"s{i}": df for i, df in enumerate(marked)}).drop("source_table")
    out = {"sources": source_summary(documents)}
    if dry_run:
        return out
    tags = ["source_type", "source_path", "position"]
    given, read = _observed(documents)
    if len({tuple(sorted(df.columns)) for df in limited}) > 1:
        incoming = field_by_field(given, F.struct("mongo_loaded_at", "position", F.xxhash64("source_path")))
    else:
        order: list[Column] = [F.col("mongo_loaded_at").desc_nulls_last(), F.col("position").desc_nulls_last()]
        incoming = upsertable(given.drop(PRESENT), order)
    incoming = incoming.drop(*[c for c in tags if c in documents.columns])
    if new_store_path is None:
        counts = buckets.upsert(spark, store_path, incoming)
        out["counts"] = {"input_documents": _rows(read), **counts}
        return out
    existing = read_if_exists(spark, store_path, fmt)
    if existing is None:
        existing = spark.createDataFrame([], incoming.drop(PRESENT).schema)
    action = F.col("_action")
    merged, seen = _observed(
        merge_rows(existing, incoming),
        matched=F.count_if(action.isin("matched", "modified")),
        modified=F.count_if(action == "modified"),
        upserted=F.count_if(action == "upserted"),
    )
    merged.drop("_action").write.format(fmt).mode("error").save(new_store_path)
    out["counts"] = {
        "input_documents": _rows(read),
        "matched_documents": _rows(seen, "matched"),
        "modified_documents": _rows(seen, "modified"),
        "upserted_documents": _rows(seen, "upserted"),
    }
    return out


def build_silver(
    spark: SparkSession,
    root: str,
    source: DataFrame | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, Any]:
    """Daily and streamed bronze comments to the silver table; both counts are taken during the one write."""
    changes.drop_index(spark, root)
    if source is None:
        inputs = {
            CONTRACTS[key].name: read_if_exists(
                spark, CONTRACTS[key].path(root), fmt, CONTRACTS[key].schema if fmt == "parquet" else None
            )
            for key in (DAILY, STREAMED)
        }
        source = silver.union_bronze(inputs)
    counted, read = _observed(source)
    rows, written = _observed(silver.build_silver(counted, F.current_timestamp()))
    path = write_contract(rows, SILVER, root, "overwrite", fmt, refuse_empty=False)
    return {"silver_path": path, "source_rows": _rows(read), "rows_written": _rows(written)}


def score_silver(
    spark: SparkSession,
    root: str,
    at: str | None = None,
    factory: scoring.ScorerFactory | None = None,
    model_name: str = "lexicon",
    dates: Sequence[str | None] | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> str:
    """Score the silver table, whole or for some collection dates (``None`` among them: comments without a date); it is
    keyed by comment, so nothing shuffles."""
    comments = read_contract(spark, root, SILVER, fmt)
    if dates is not None:
        comments = comments.filter(changes.on_days(as_date(comments, "collection_date"), dates))
    scored = scoring.enrich_sentiment(
        comments, factory, model_name, processed_at=at or now_iso(), deduplicated=True
    )
    if dates is not None:
        return changes.replace_days(spark, scored, SCORED, root, dates, fmt)
    return write_contract(scored, SCORED, root, "overwrite", fmt, refuse_empty=False)


def _build_marts(
    spark: SparkSession, root: str, builders: dict, at: str | None, dates: Sequence[str | None] | None, fmt: str
) -> dict[str, str]:
    """Marts by date from the scored comments, whole or for some dates."""
    scored = read_contract(spark, root, SCORED, fmt)
    if scored.isEmpty():
        raise ValueError(f"{SCORED} is empty")
    at = at or now_iso()
    out = {}
    for key, build in builders.items():
        if dates is not None:
            out[key] = changes.apply_to_mart(spark, root, key, build, dates, at, fmt)
        else:
            out[key] = write_contract(build(scored, unique_ids=True, built_at=at), key, root, "overwrite", fmt, refuse_empty=False)
    return out


def sentiment_gold(
    spark: SparkSession, root: str, at: str | None = None, dates: Sequence[str] | None = None, fmt: str = DEFAULT_FORMAT
) -> dict[str, str]:
    """Daily and video summary; with ``dates`` only those partitions are read and replaced."""
    return _build_marts(spark, root, SENTIMENT_MARTS, at, dates, fmt)


def descriptive_gold(
    spark: SparkSession, root: str, at: str | None = None, dates: Sequence[str] | None = None, fmt: str = DEFAULT_FORMAT
) -> dict[str, str]:
    """States of days, hours and keywords from the comments; trend, overview and topics from the states.

    With ``dates``, tables by date are read and replaced for these alone; the topics follow from all states of days.
    """
    if dates is not None and read_if_exists(spark, CONTRACTS[STATES].path(root), fmt) is None:
        dates = None
    at = at or now_iso()
    out = _build_marts(spark, root, DESCRIPTIVE_MARTS, at, dates, fmt)
    states = read_contract(spark, root, STATES, fmt)
    for key, mart in MARTS_FROM_STATES.items():
        if dates is not None and "collection_date" in CONTRACTS[key].partition_by:
            near = states.filter(changes.on_days(F.col("collection_date"), dates))
            out[key] = changes.replace_days(spark, marts.from_states(near, mart, at), key, root, dates, fmt)
        else:
            out[key] = write_contract(marts.from_states(states, mart, at), key, root, "overwrite", fmt, refuse_empty=False)
    return out


def predictive_gold(
    spark: SparkSession,
    root: str,
    min_history_days: int = forecast.MIN_HISTORY_DAYS,
    periods: int = forecast.PERIODS,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, str]:
    """Daily topic metrics, then summary and forecast from the written metrics."""
    scored = read_contract(spark, root, SCORED, fmt)
    now = F.current_timestamp()
    metrics_key = "gold.youtube_comments_daily_topic_metrics"
    metrics = marts.daily_topic_metrics(scored, unique_ids=True, built_at=now)
    out = {metrics_key: write_contract(metrics, metrics_key, root, "overwrite", fmt, refuse_empty=False)}
    daily = read_contract(spark, root, metrics_key, fmt)
    for key, frame in {
        "gold.youtube_comments_forecast_summary": forecast.forecast_summary(daily, min_history_days, now),
        "gold.youtube_comments_forecast_7d": forecast.topic_forecast(daily, min_history_days, periods, now),
    }.items():
        out[key] = write_contract(frame, key, root, "overwrite", fmt, refuse_empty=False)
    return out


def overview_gold(spark: SparkSession, root: str, fmt: str = DEFAULT_FORMAT) -> dict[str, str]:
    """Run overview; skipped when one of its inputs has no rows."""
    collection = read_contract(spark, root, "gold.collection_daily_summary", fmt)
    performance = read_contract(spark, root, "gold.query_performance_summary", fmt)
    key = "gold.dashboard_overview_daily"
    if collection.isEmpty() or performance.isEmpty():
        return {"status": "skipped_missing_inputs", "table_path": CONTRACTS[key].path(root)}
    overview = runs.run_overview(collection, performance)
    path = write_contract(overview, key, root, "overwrite", fmt, refuse_empty=False)
    return {"status": "success", "table_path": path}


def collection_metrics(
    spark: SparkSession, root: str, summaries: DataFrame, errors: DataFrame, fmt: str = DEFAULT_FORMAT
) -> dict[str, str]:
    """Query performance, ingestion runs and daily summary appended, then the overview rebuilt.

    Queries meet their errors once, whatever the number of tables that follow from it.
    """
    collected = staged(runs.with_messages(summaries, errors), "collected")
    performance = runs.performance_rows(collected)
    out = {}
    for key, frame in {
        "bronze.ingestion_runs": runs.ingestion_rows(collected),
        "gold.query_performance_summary": performance,
        "gold.collection_daily_summary": runs.collection_daily_summary(performance),
    }.items():
        out[key] = write_contract(frame, key, root, "append", fmt, refuse_empty=False)
    discard(collected)
    out["gold.dashboard_overview_daily"] = overview_gold(spark, root, fmt)["status"]
    return out


def daily_run(
    spark: SparkSession,
    root: str,
    registry: DataFrame,
    records: DataFrame,
    manifests: DataFrame,
    summaries: DataFrame,
    errors: DataFrame,
    total_budget: int = planning.TOTAL_BUDGET,
    at: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, Any]:
    """The whole day in order, from collected records: plan, metrics, bronze, silver, scores, marts, forecast."""
    at = at or now_iso()
    plan = planning.plan_within_budget(planning.active_queries(registry), total_budget)
    out: dict[str, Any] = {"plan": planning.plan_summary(plan, total_budget)}
    out["collection"] = collection_metrics(spark, root, summaries, errors, fmt)
    out["bronze"] = bronze_daily(spark, root, records, manifests, plan.filter("status = 'selected'"), at, fmt)
    out["silver"] = build_silver(spark, root, fmt=fmt)
    out["scored"] = score_silver(spark, root, at, fmt=fmt)
    out["sentiment"] = sentiment_gold(spark, root, at, fmt=fmt)
    out["descriptive"] = descriptive_gold(spark, root, at, fmt=fmt)
    out["predictive"] = predictive_gold(spark, root, fmt=fmt)
    out["overview"] = overview_gold(spark, root, fmt)
    return out


def custom_query_refresh(
    spark: SparkSession,
    root: str,
    registry: DataFrame,
    query: DataFrame,
    aliases: planning.Aliases,
    records: DataFrame,
    manifests: DataFrame,
    at: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, Any]:
    """Add or update a custom query, load its records, and refresh only what they touch.

    New rows that change silver name the dates that lose or gain a comment; silver, scores and the tables by date are
    read and written for these dates alone, topics and forecasts follow from tables of days. Where silver or the scores
    are not there yet, or the tables by date are not, everything is built.
    """
    at = at or now_iso()
    upserted = planning.upsert_queries(registry, query, aliases)
    plan = upserted.filter(F.col("action").isNotNull())
    there = all(read_if_exists(spark, CONTRACTS[key].path(root), fmt) is not None for key in (SILVER, SCORED, STATES))
    loaded, fresh = _load_daily(spark, root, records, manifests, plan, at, fmt)
    if there:
        done = changes.apply_to_silver(spark, root, silver.union_bronze({CONTRACTS[DAILY].name: fresh}), fmt=fmt)
        days = done.pop("days")
        silver_out = {**done, "source_rows": loaded["comments_records_written"]}
    else:
        silver_out = build_silver(spark, root, fmt=fmt)
        found = read_contract(spark, root, SILVER, fmt).select(F.col("collection_date").cast("string")).distinct().collect()
        days = changes.in_order(r[0] for r in found)  # days, not comments
    discard(fresh)
    out = {"registry": upserted, "bronze": loaded, "silver": silver_out, "dates": days}
    if days:
        part = days if there else None
        score_silver(spark, root, at, dates=part, fmt=fmt)
        out["sentiment"] = sentiment_gold(spark, root, at, part, fmt)
        out["descriptive"] = descriptive_gold(spark, root, at, part, fmt)
        out["predictive"] = changes.apply_to_metrics(spark, root, days, fmt) if there else predictive_gold(spark, root, fmt=fmt)
    out["overview"] = overview_gold(spark, root, fmt)
    return out
