"""Raw records, documents, threads and message envelopes as bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS
from voxlake.functions.columns import (
    col_or_null,
    date_part,
    extended_date,
    language_parts,
    pick,
    present,
    safe_int,
    safe_text,
    strict_int,
    text_of,
    watch_url,
)
from voxlake.operators.silver import newest_per_key
from voxlake.sinks.runlogs import HISTORICAL
from voxlake.sinks.upsert import DOCUMENT_KEY, key_columns

# Plan fields that fill gaps of a record, with the default when both are blank.
_PLAN_TEXT = {"query_text": "", "topic": "unknown", "genre": "unknown", "cadence": "unknown", "language_target": ""}
_PLAN_COUNTS = ("priority", "expected_units")


def with_plan(records: DataFrame, plan: DataFrame | None) -> DataFrame:
    """Plan columns as ``plan_*`` beside each record of the same query id (at most one plan row per id)."""
    names = [*_PLAN_TEXT, *_PLAN_COUNTS]
    keyed = records.withColumn("query_id", safe_text(col_or_null(records, "query_id")))
    if plan is None:
        return keyed.withColumns({f"plan_{name}": F.lit(None).cast("string") for name in names})
    side = plan.select("query_id", *[col_or_null(plan, name).cast("string").alias(f"plan_{name}") for name in names])
    return keyed.join(side, "query_id", "left")


def _plan_text(df: DataFrame, name: str) -> Column:
    return safe_text(_picked(df, name), safe_text(F.col(f"plan_{name}"), _PLAN_TEXT[name])).alias(name)


def _plan_count(df: DataFrame, name: str) -> Column:
    return safe_int(_picked(df, name), safe_int(F.col(f"plan_{name}"))).alias(name)


def _picked(df: DataFrame, *names: str) -> Column:
    """``pick``, without the blank check where only one of the names exists (blanks are trimmed away later)."""
    found = present(df, names)
    return text_of(df, found[0]) if len(found) == 1 else pick(df, names)


def _text(df: DataFrame, *names: str, default: str = "") -> Column:
    return safe_text(_picked(df, *names), default).alias(names[0])


def _count(df: DataFrame, name: str, *others: str) -> Column:
    return safe_int(_picked(df, name, *others)).alias(name)


def raw_copy(records: DataFrame) -> Column:
    """The whole record as JSON: the copy taken while reading, else all columns."""
    if "raw_record_json" in records.columns:
        return F.col("raw_record_json")
    return F.to_json(F.struct(*sorted(records.columns)))


def _contract_order(df: DataFrame, key: str) -> DataFrame:
    return df.select([field.name for field in CONTRACTS[key].schema])


def records_to_bronze(
    records: DataFrame, manifests: DataFrame, plan: DataFrame | None, ingested_at: str, join_on: str = "run_folder"
) -> DataFrame:
    """Daily run records with their manifest's lineage and their plan row's attributes."""
    lineage = manifests.select(
        join_on,
        safe_text(F.col("run_id")).alias("_run_id"),
        date_part(safe_text(F.col("generated_at"), ingested_at)).alias("_collection_date"),
        safe_text(F.col("manifest_path")).alias("_manifest_path"),
        safe_text(F.col("normalized_comments_path")).alias("_comments_path"),
        safe_text(F.col("plan_path")).alias("_plan_path"),
    )
    source = records.withColumn("_raw", raw_copy(records)).join(lineage, join_on)
    df = with_plan(source, plan)
    rows = df.select(
        F.col("_run_id").alias("run_id"),
        F.col("_collection_date").alias("collection_date"),
        F.lit(ingested_at).alias("ingested_at"),
        F.lit("youtube").alias("platform"),
        F.lit("youtube_daily_api").alias("ingestion_type"),
        F.col("_manifest_path").alias("manifest_path"),
        F.col("_comments_path").alias("normalized_comments_path"),
        F.col("_plan_path").alias("plan_path"),
        "query_id",
        *[_plan_text(df, name) for name in _PLAN_TEXT],
        *[_plan_count(df, name) for name in _PLAN_COUNTS],
        *_comment_columns(df, "like_count", "comment_like_count"),
        _text(df, "comment_id"),
        _text(df, "author_display_name", "author_name"),
        F.col("_raw").alias("raw_record_json"),
    )
    return _contract_order(rows, "bronze.youtube_comments_daily_raw")


def _comment_columns(df: DataFrame, *likes: str) -> list[Column]:
    """Columns that records and documents share."""
    return [
        _text(df, "video_id"),
        _text(df, "video_title", "title"),
        _text(df, "channel_title", "video_channel_title"),
        _text(df, "video_published_at"),
        watch_url(_picked(df, "video_id"), _picked(df, "video_url")).alias("video_url"),
        _text(df, "thread_id", "comment_thread_id"),
        _text(df, "comment_text", "text"),
        safe_int(pick(df, likes)).alias("comment_like_count"),
        _text(df, "comment_published_at", "published_at"),
        _text(df, "comment_updated_at", "updated_at"),
        _count(df, "reply_count", "total_reply_count"),
        _text(df, "author_channel_id"),
    ]


def documents_to_bronze(documents: DataFrame, loaded_at: str) -> DataFrame:
    """Stored documents as bronze rows, the newest of each four-part key.

    Newest by collection date, then by update and load time; documents equal in these differ by their raw copy.
    """
    if "_id" in documents.columns:
        documents = documents.drop("_id")
    whole = F.to_json(F.struct(*sorted(documents.columns)))
    df = documents.withColumn("_raw", safe_text(col_or_null(documents, "raw_record_json"), whole))
    rows = df.select(
        _text(df, "run_id"),
        _text(df, "collection_date", default=loaded_at[:10]),
        F.lit(loaded_at).alias("ingested_at"),
        F.lit("youtube").alias("platform"),
        F.lit("youtube_mongo_raw_to_bronze").alias("ingestion_type"),
        _text(df, "manifest_path"),
        _text(df, "normalized_comments_path", "source_file_path"),
        _text(df, "plan_path"),
        _text(df, "query_id"),
        *[_text(df, name, default=default) for name, default in _PLAN_TEXT.items()],
        *[_count(df, name) for name in _PLAN_COUNTS],
        *_comment_columns(df, "comment_like_count", "like_count"),
        _text(df, "comment_id"),
        _text(df, "author_display_name"),
        F.col("_raw").alias("raw_record_json"),
        col_or_null(df, "mongo_loaded_at").cast("string").alias("_loaded"),
    )
    times = ("collection_date", "comment_updated_at", "_loaded", "raw_record_json")
    newest = newest_per_key(rows, DOCUMENT_KEY, [F.col(name).desc_nulls_last() for name in times])
    return _contract_order(newest, "bronze.youtube_comments_daily_raw")


def missing_from(rows: DataFrame, target: DataFrame | None, keys: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
    """Rows whose key is not in the target yet (anti join on the key parts, of which the target scan reads no more)."""
    if target is None:
        return rows
    known = target.select([part.alias(f"known_{key}") for key, part in zip(keys, key_columns(target, keys))]).distinct()
    condition = [part == F.col(f"known_{key}") for key, part in zip(keys, key_columns(rows, keys))]
    return rows.join(known, condition, "left_anti")


def records_to_documents(
    records: DataFrame, manifests: DataFrame, plan: DataFrame | None, loaded_at: str, join_on: str = "run_folder"
) -> DataFrame:
    """Daily run records as documents for the store; blank comment ids are left out."""
    bronze_like = manifests.select(
        join_on,
        safe_text(F.col("run_id"), F.col(join_on)).alias("_run_id"),
        date_part(safe_text(F.col("generated_at"), loaded_at)).alias("_collection_date"),
        F.col("manifest_path").alias("_manifest_path"),
        safe_text(F.col("normalized_comments_path")).alias("_comments_path"),
        safe_text(F.col("plan_path")).alias("_plan_path"),
    )
    df = with_plan(records.withColumn("_raw", raw_copy(records)).join(bronze_like, join_on), plan)
    shared = [c for c in _comment_columns(df, "comment_like_count", "like_count")]
    out = df.select(
        F.col("_run_id").alias("run_id"),
        F.col("_collection_date").alias("collection_date"),
        F.lit(loaded_at).alias("mongo_loaded_at"),
        F.lit("local_daily_normalized_comments").alias("backfill_source"),
        F.col("_comments_path").alias("source_file_path"),
        F.col("_manifest_path").alias("manifest_path"),
        F.col("_plan_path").alias("plan_path"),
        F.lit("youtube").alias("platform"),
        F.lit("youtube_daily_api").alias("ingestion_type"),
        "query_id",
        *[_plan_text(df, name) for name in _PLAN_TEXT],
        *[_plan_count(df, name) for name in _PLAN_COUNTS],
        *shared,
        _text(df, "video_description"),
        _text(df, "channel_id"),
        _text(df, "comment_id"),
        _text(df, "author_name", "author_display_name"),
        _text(df, "author_display_name", "author_name"),
        safe_int(pick(df, ["like_count", "comment_like_count"])).alias("like_count"),
        *([F.col("position")] if "position" in df.columns else []),
        F.col("_raw").alias("raw_record_json"),
    ).withColumn("video_url", watch_url(F.col("video_id")))
    return out.filter(F.col("comment_id") != "")


def thread_comments(threads: DataFrame, comments: str = "comment") -> DataFrame:
    """One row per comment of a thread: the top-level one, then its replies, in one narrow explode.

    ``level`` is 0 for the top-level comment; threads without one contribute their replies only.
    """
    top = F.when(F.col("top_level_comment").isNotNull(), F.array("top_level_comment"))
    empty = F.array().cast(threads.schema["replies"].dataType)
    members = F.concat(
        F.transform(F.coalesce(top, empty), lambda c: F.struct(F.lit(0).alias("level"), c.alias("c"))),
        F.transform(F.coalesce("replies", empty), lambda c: F.struct(F.lit(1).alias("level"), c.alias("c"))),
    )
    return threads.withColumn("_m", F.explode(members)).select(
        *threads.columns, F.col("_m.level").alias("level"), F.col("_m.c").alias(comments)
    )


def flatten_threads(threads: DataFrame, source_run_id: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Historical threads as raw comment rows; replies point to their thread and have no author name."""
    tags = {**HISTORICAL, **(labels or {})}
    df = thread_comments(threads)
    top = F.col("level") == 0
    label, code = language_parts(F.col("comment.detected_language"))
    rows = df.select(
        F.lit(source_run_id).alias("source_run_id"),
        F.lit("historical_bootstrap").alias("ingestion_type"),
        *[F.lit(value).alias(name) for name, value in tags.items()],
        "thread_id",
        F.when(top, "top_level").otherwise("reply").alias("record_type"),
        "video_id",
        F.col("raw_snippet.snippet.channelId").alias("channel_id"),
        F.col("comment.comment_id").alias("comment_id"),
        F.when(~top, F.col("thread_id")).alias("parent_comment_id"),
        F.when(top, F.col("raw_snippet.snippet.topLevelComment.snippet.authorDisplayName")).alias("author_name"),
        F.col("comment.author_channel_id").alias("author_channel_id"),
        F.coalesce("comment.text", F.lit("")).alias("text"),
        safe_int(F.col("comment.like_count")).alias("like_count"),
        F.when(top, F.coalesce(F.size("replies"), F.lit(0))).otherwise(0).cast("bigint").alias("reply_count"),
        F.col("comment.published_at").alias("published_at"),
        extended_date(F.col("fetched_at")).alias("fetched_at"),
        "language_target",
        label.alias("detected_language_label"),
        code.alias("detected_language_code"),
    )
    return _contract_order(rows, "bronze.youtube_comments_raw")


# Labels of a backfilled dump.
_LEGACY = {name: "legacy_youtube_dump" for name in ("query_id", "query_text", "topic")}


def threads_to_documents(threads: DataFrame, loaded_at: str, source_path: str = "source_path") -> DataFrame:
    """Dump threads as documents for the store; the raw copy is the whole thread."""
    kept = [name for name in threads.columns if name not in ("_id", source_path)]
    source = threads.withColumn("_raw", F.to_json(F.struct(*sorted(kept))))
    df = thread_comments(source)
    c = lambda *names: safe_text(
        F.coalesce(*[F.nullif(F.col(f"comment.{name}"), F.lit("")) for name in names])
    )
    file_stem = F.regexp_replace(F.element_at(F.split(F.col(source_path), "/"), -1), r"\.[^.]+$", "")
    out = df.select(
        F.concat(F.lit("backfill-"), file_stem).alias("run_id"),
        date_part(safe_text(extended_date(F.col("fetched_at")), loaded_at)).alias("collection_date"),
        F.lit(loaded_at).alias("mongo_loaded_at"),
        F.lit("local_youtube_dump").alias("backfill_source"),
        F.col(source_path).alias("source_file_path"),
        F.lit("").alias("manifest_path"),
        F.lit("").alias("plan_path"),
        F.lit("youtube").alias("platform"),
        F.lit("youtube_dump_backfill").alias("ingestion_type"),
        *[F.lit(value).alias(name) for name, value in _LEGACY.items()],
        F.lit("unknown").alias("genre"),
        F.lit("unknown").alias("cadence"),
        F.lit(0).cast("bigint").alias("priority"),
        F.lit(0).cast("bigint").alias("expected_units"),
        safe_text(F.col("video_id")).alias("video_id"),
        *[
            F.lit("").alias(name)
            for name in ("video_title", "video_description", "channel_id", "channel_title", "video_published_at")
        ],
        watch_url(F.col("video_id")).alias("video_url"),
        safe_text(F.col("thread_id")).alias("thread_id"),
        c("comment_id").alias("comment_id"),
        c("author_name", "author_display_name").alias("author_name"),
        c("author_display_name", "author_name").alias("author_display_name"),
        c("author_channel_id").alias("author_channel_id"),
        c("text", "comment_text", "textOriginal", "textDisplay").alias("comment_text"),
        safe_int(F.col("comment.like_count")).alias("like_count"),
        safe_int(F.col("comment.like_count")).alias("comment_like_count"),
        c("published_at", "comment_published_at").alias("comment_published_at"),
        c("updated_at", "comment_updated_at").alias("comment_updated_at"),
        safe_int(F.col("total_reply_count")).alias("reply_count"),
        safe_text(F.col("language_target")).alias("language_target"),
        F.when(F.col("level") == 0, "top_level").otherwise("reply").alias("comment_level"),
        F.col("_raw").alias("raw_record_json"),
    )
    return out.filter(F.col("comment_id") != "")


def flatten_collected(queries: DataFrame, run_id: str, collected_at: str) -> DataFrame:
    """Query rows with nested ``videos[].comments[]`` as one row per comment, attributes repeated."""
    run_date = F.lit(collected_at[:10])
    videos = queries.withColumn("v", F.explode("videos"))
    rows = videos.withColumn("c", F.explode("v.comments"))
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.lit(collected_at).alias("collected_at"),
        F.lit("youtube").alias("platform"),
        "query_id",
        "topic",
        "genre",
        "query_text",
        F.coalesce(col_or_null(queries, "plan_date"), run_date).alias("plan_date"),
        *[
            F.col(f"v.{name}").alias(name)
            for name in (
                "video_id video_title video_description channel_id channel_title video_published_at".split()
            )
        ],
        *[
            F.col(f"c.{name}").alias(name)
            for name in "comment_id author_name comment_text like_count comment_published_at comment_updated_at".split()
        ],
        F.lit("daily_api").alias("ingestion_type"),
    )


# Payload fields of a comment event.
EVENT_TEXT = (
    "run_id collected_at platform query_id topic genre query_text plan_date cadence video_id video_title "
    "video_description channel_id channel_title video_published_at video_url thread_id comment_id comment_text "
    "comment_published_at comment_updated_at author_display_name author_channel_id"
).split()
EVENT_COUNTS = "priority expected_units comment_like_count reply_count".split()
EVENT_LINEAGE = "manifest_path normalized_comments_path plan_path".split()
EVENT_TYPE = "youtube.comment.raw.v1"


def build_events(
    records: DataFrame, manifests: DataFrame | None, producer_run_id: str, produced_at: str, join_on: str = "run_folder"
) -> DataFrame:
    """Comment events as (key, value): the key is the event id, the value the JSON envelope.

    ``records`` carries ``position``, its place in the run's list, from which a record without an id gets its
    substitute; no global numbering is needed.
    """
    source = records.withColumn("_raw", raw_copy(records.drop("position", join_on)))
    if manifests is None:
        source = source.withColumns({f"_m_{name}": F.lit("") for name in ["run_id", *EVENT_LINEAGE]})
    else:
        source = source.join(
            manifests.select(
                join_on,
                *[F.coalesce(name, F.lit("")).alias(f"_m_{name}") for name in ["run_id", *EVENT_LINEAGE]],
            ),
            join_on,
        )
    text = lambda name: F.coalesce(
        text_of(source, name) if name in source.columns else F.lit(None).cast("string"), F.lit("")
    )
    payload = F.struct(
        *[text(name).alias(name) for name in EVENT_TEXT],
        *[strict_int(col_or_null(source, name)).alias(name) for name in EVENT_COUNTS],
        F.col("_raw").alias("raw_record_json"),
        *[F.col(f"_m_{name}").alias(name) for name in EVENT_LINEAGE],
    )
    substitute = F.concat(F.lit("unknown-comment-"), F.col("position").cast("string"))
    event_id = F.concat_ws(":", F.lit(producer_run_id), F.coalesce(F.nullif(text("comment_id"), F.lit("")), substitute))
    envelope = F.struct(
        event_id.alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.lit(produced_at).alias("produced_at"),
        F.lit(producer_run_id).alias("producer_run_id"),
        F.col("_m_run_id").alias("source_run_id"),
        payload.alias("payload"),
    )
    return source.select(event_id.alias("key"), F.to_json(envelope).alias("value"))


EVENT_SCHEMA = (
    "event_id string, event_type string, produced_at string, producer_run_id string, source_run_id string, "
    "payload struct<"
    + ", ".join(f"{name}: string" for name in [*EVENT_TEXT, *EVENT_COUNTS, "raw_record_json", *EVENT_LINEAGE])
    + ">"
)


def envelopes_to_bronze(messages: DataFrame, ingested_at: Column | str, load_id: str = "") -> DataFrame:
    """Log messages (topic, partition, offset, value) as bronze rows; missing payload values become blank.

    ``load_id`` names the delivery (consumer and micro-batch) the rows came with.
    """
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    df = messages.withColumn("e", F.from_json("value", EVENT_SCHEMA))
    blank = lambda column: F.coalesce(column.cast("string"), F.lit(""))
    texts = [name for name in EVENT_TEXT if name not in ("collected_at", "plan_date")]
    rows = df.select(
        date_part(blank(F.col("e.payload.plan_date"))).alias("collection_date"),
        stamp.alias("ingested_at"),
        F.lit("youtube_kafka_to_bronze").alias("ingestion_type"),
        blank(F.col("topic")).alias("kafka_topic"),
        strict_int(F.col("partition")).alias("kafka_partition"),
        strict_int(F.col("offset")).alias("kafka_offset"),
        blank(F.col("e.producer_run_id")).alias("producer_run_id"),
        blank(F.col("e.event_id")).alias("event_id"),
        *[blank(F.col(f"e.payload.{name}")).alias(name) for name in [*texts, *EVENT_LINEAGE]],
        *[strict_int(F.col(f"e.payload.{name}")).alias(name) for name in EVENT_COUNTS],
        F.coalesce("e.payload.raw_record_json", F.to_json("e.payload")).alias("raw_record_json"),
        F.lit(load_id).alias("load_id"),
    )
    return _contract_order(rows, "bronze.youtube_comments_kafka_raw")
