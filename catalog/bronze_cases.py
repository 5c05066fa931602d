"""Raw records, documents, threads, events: sources, bronze rows, silver, sinks and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    WS,
    case,
    engagement,
    errors,
    int_sql,
    manifests,
    plan_rows,
    registry,
    scratch,
    sql,
    summaries,
    table,
    text_sql,
    threads,
    untidy,
    view,
)
from voxlake.operators import bronze, silver
from voxlake.plans import jobs
from voxlake.sinks import runlogs, upsert
from voxlake.sinks.tables import append, overwrite, write_contract
from voxlake.sources import docstore, documents
from voxlake.sources.tables import read_contract
from voxlake.streaming import events as streaming

AT = "2024-06-01T00:00:00"
URL = "https://www.youtube.com/watch?v="


def _pick(*names: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({name}, '')" for name in names) + ")"


_BRONZE_COLUMNS = (
    "run_id collection_date ingested_at platform ingestion_type manifest_path normalized_comments_path plan_path "
    "query_id query_text topic genre cadence priority expected_units video_id video_title channel_title video_url "
    "thread_id comment_id comment_text comment_like_count comment_published_at comment_updated_at reply_count "
    "author_display_name author_channel_id language_target"
).split()
_SHARED = f"""{text_sql(_pick('u.video_id'))} AS video_id, {text_sql(_pick('video_title', 'title'))} AS video_title,
    {text_sql(_pick('channel_title'))} AS channel_title,
    CASE WHEN {text_sql(_pick('u.video_id'))} <> '' THEN '{URL}' || {text_sql(_pick('u.video_id'))} ELSE '' END AS video_url,
    '' AS thread_id, {text_sql(_pick('comment_id'))} AS comment_id, {text_sql(_pick('comment_text'))} AS comment_text,
    {text_sql(_pick('comment_published_at'))} AS comment_published_at,
    {text_sql(_pick('comment_updated_at'))} AS comment_updated_at, {int_sql(_pick('reply_count'))} AS reply_count,
    '' AS author_channel_id"""
view(
    "daily_bronze",
    f"""SELECT m.run_id, substr(m.generated_at, 1, 10) AS collection_date, '{AT}' AS ingested_at, 'youtube' AS platform,
    'youtube_daily_api' AS ingestion_type, m.manifest_path, m.normalized_comments_path, m.plan_path,
    {text_sql('u.query_id')} AS query_id,
    {text_sql(_pick('u.query_text'), text_sql('p.query_text'))} AS query_text,
    {text_sql(_pick('u.topic'), text_sql('p.topic', "'unknown'"))} AS topic,
    {text_sql(_pick('u.genre'), text_sql('p.genre', "'unknown'"))} AS genre,
    {text_sql('p.cadence', "'unknown'")} AS cadence, {int_sql('p.priority')} AS priority,
    {int_sql('p.expected_units')} AS expected_units, {_SHARED},
    {int_sql(_pick('like_count', 'comment_like_count'))} AS comment_like_count,
    {text_sql(_pick('author_display_name', 'author_name'))} AS author_display_name,
    {text_sql('p.language_target')} AS language_target, u.position
  FROM unt u JOIN man m USING (run_folder) LEFT JOIN plan p ON p.query_id = trim(u.query_id)""",
    "unt",
    "man",
    "plan",
)
_COLUMNS = ", ".join(_BRONZE_COLUMNS)


def records(spark, d):
    return untidy(spark, d).drop("run_id", "collection_date", "ingested_at", "plan_date")


def daily_bronze(spark, d):
    return bronze.records_to_bronze(records(spark, d), manifests(spark, d), plan_rows(spark, d), AT)


@case("bronze_rows_from_manifest", sql(f"SELECT {_COLUMNS} FROM daily_bronze", "daily_bronze"))
def _daily(spark, d):
    return daily_bronze(spark, d).select(*_BRONZE_COLUMNS)


@case(
    "plan_lookup_enrichment",
    sql(
        f"""SELECT position, {text_sql('u.query_id')} AS query_id, p.query_text AS plan_query_text,
    p.cadence AS plan_cadence, p.priority AS plan_priority FROM unt u LEFT JOIN plan p ON p.query_id = trim(u.query_id)""",
        "unt",
        "plan",
    ),
)
def _plan(spark, d):
    out = bronze.with_plan(untidy(spark, d), documents.plan_lookup(plan_rows(spark, d)))
    return out.select("position", "query_id", "plan_query_text", "plan_cadence", "plan_priority")


@case(
    "derived_watch_url",
    sql(
        f"""SELECT position, CASE WHEN position % 3 = 0 THEN 'http://given/' || position
    WHEN coalesce(video_id, '') <> '' THEN '{URL}' || video_id ELSE '' END AS video_url FROM unt""",
        "unt",
    ),
)
def _url(spark, d):
    from voxlake.functions.columns import watch_url

    given = F.when(F.col("position") % 3 == 0, F.concat(F.lit("http://given/"), F.col("position")))
    return untidy(spark, d).select("position", watch_url(F.col("video_id"), given).alias("video_url"))


view(
    "doc_bronze",
    f"""SELECT {text_sql('run_id')} AS run_id, {text_sql('collection_date', "'2024-06-01'")} AS collection_date,
    '{AT}' AS ingested_at, 'youtube' AS platform, 'youtube_mongo_raw_to_bronze' AS ingestion_type,
    '' AS manifest_path, '' AS normalized_comments_path, '' AS plan_path, {text_sql('query_id')} AS query_id,
    {text_sql('query_text')} AS query_text, {text_sql('topic', "'unknown'")} AS topic,
    {text_sql('genre', "'unknown'")} AS genre, 'unknown' AS cadence, CAST(0 AS BIGINT) AS priority,
    CAST(0 AS BIGINT) AS expected_units, {_SHARED},
    {int_sql(_pick('comment_like_count', 'like_count'))} AS comment_like_count,
    {text_sql('author_display_name')} AS author_display_name, '' AS language_target, position
  FROM unt u""",
    "unt",
)
_KEY = "run_id, query_id, video_id, comment_id"
view(
    "doc_newest",
    f"""SELECT *, '' AS video_published_at FROM doc_bronze QUALIFY row_number() OVER (PARTITION BY {_KEY}
    ORDER BY collection_date DESC, comment_updated_at DESC) = 1""",
    "doc_bronze",
)
_DOC_BRONZE = ["video_published_at", *_BRONZE_COLUMNS]


def doc_bronze(spark, d):
    return bronze.documents_to_bronze(untidy(spark, d), AT)


@case("bronze_rows_from_documents", sql(f"SELECT {', '.join(_DOC_BRONZE)} FROM doc_newest", "doc_newest"))
def _documents(spark, d):
    return doc_bronze(spark, d).select(*_DOC_BRONZE)


@case(
    "incremental_anti_join",
    sql(
        f"""SELECT {', '.join(_DOC_BRONZE)} FROM doc_newest WHERE ({_KEY}) NOT IN (
    SELECT ({_KEY}) FROM doc_bronze WHERE collection_date < '2024-01-12')""",
        "doc_newest",
    ),
)
def _anti(spark, d):
    known = bronze.documents_to_bronze(untidy(spark, d).filter("collection_date < '2024-01-12'"), AT)
    return bronze.missing_from(doc_bronze(spark, d), known).select(*_DOC_BRONZE)


# The columns an event and a daily document show.
_DOC_COLUMNS = (
    "run_id collection_date source_file_path manifest_path query_id topic genre priority video_id video_title "
    "comment_id comment_text author_name author_display_name like_count comment_like_count reply_count "
    "language_target position"
).split()


@case(
    "daily_documents",
    sql(
        f"""SELECT run_id, collection_date, normalized_comments_path AS source_file_path, manifest_path, d.query_id,
    d.topic, d.genre, priority, d.video_id, d.video_title, d.comment_id, d.comment_text,
    {text_sql(_pick('author_name', 'u.author_display_name'))} AS author_name, d.author_display_name,
    d.comment_like_count AS like_count, {int_sql(_pick('u.comment_like_count', 'like_count'))} AS comment_like_count,
    d.reply_count, language_target, d.position
  FROM daily_bronze d JOIN (SELECT position, author_name, author_display_name, comment_like_count, like_count FROM unt) u
    USING (position) WHERE d.comment_id <> ''""",
        "daily_bronze",
    ),
)
def _daily_documents(spark, d):
    out = bronze.records_to_documents(records(spark, d), manifests(spark, d), plan_rows(spark, d), AT)
    return out.select(*_DOC_COLUMNS)


# ------------------------------------------------------------------ threads

_THREAD_FLAT = """SELECT 'run-1' AS source_run_id, 'historical_bootstrap' AS ingestion_type,
    'historical_archive' AS topic, 'mixed' AS genre, thread_id,
    CASE WHEN place = 0 THEN 'top_level' ELSE 'reply' END AS record_type, 'v' || conv_id AS video_id,
    'ch' || conv_id AS channel_id, comment_id, CASE WHEN place > 0 THEN thread_id END AS parent_comment_id,
    CASE WHEN place = 0 THEN role END AS author_name, 'author-' || role AS author_channel_id, line AS text,
    CAST(likes AS BIGINT) AS like_count, CASE WHEN place = 0 THEN n_replies ELSE 0 END AS reply_count,
    '2024-02-03T04:05:06Z' AS fetched_at, CASE WHEN turn % 2 = 0 THEN 'Other' END AS detected_language_label,
    CASE WHEN turn % 2 = 0 THEN 'en' END AS detected_language_code FROM thc"""
_FLAT_COLUMNS = (
    "source_run_id ingestion_type topic genre thread_id record_type video_id channel_id comment_id parent_comment_id "
    "author_name author_channel_id text like_count reply_count fetched_at detected_language_label "
    "detected_language_code"
).split()


@case("historical_thread_flatten", sql(_THREAD_FLAT, "thc"))
def _flatten(spark, d):
    return bronze.flatten_threads(documents.parse_threads(threads(spark, d)), "run-1").select(*_FLAT_COLUMNS)


def thread_files(spark, d):
    folder = scratch(spark, "dump")
    threads(spark, d).select(F.col("document").alias("value")).write.text(folder)
    return folder


@case("historical_dump_source", sql("SELECT thread_id, 'v' || conv_id AS video_id, n_replies AS replies FROM thr", "thr"))
def _dump(spark, d):
    read = documents.read_threads(spark, thread_files(spark, d), lines=True)
    return read.select("thread_id", "video_id", F.size("replies").cast("bigint").alias("replies"))


@case(
    "historical_load_job",
    sql(
        "SELECT thread_id, comment_id, line AS text, CAST(likes AS BIGINT) AS like_count FROM thc",
        "thc",
    ),
)
def _historical_job(spark, d):
    root = scratch(spark, "lakehouse")
    jobs.historical_load(spark, root, documents.parse_threads(threads(spark, d)), AT)
    return read_contract(spark, root, "bronze.youtube_comments_raw").select(
        "thread_id", "comment_id", "text", "like_count"
    )


view(
    "thread_docs",
    f"""SELECT 'backfill-dump' AS run_id, '2024-02-03' AS collection_date, 'legacy_youtube_dump' AS query_id,
    'v' || conv_id AS video_id, '{URL}v' || conv_id AS video_url, thread_id, comment_id, role AS author_name,
    trim(line, {WS}) AS comment_text, CAST(likes AS BIGINT) AS like_count, turn AS reply_count,
    CASE WHEN place = 0 THEN 'top_level' ELSE 'reply' END AS comment_level FROM thc WHERE comment_id <> ''""",
    "thc",
)
_THREAD_DOC_COLUMNS = (
    "run_id collection_date query_id video_id video_url thread_id comment_id author_name comment_text like_count "
    "reply_count comment_level"
).split()


def thread_documents(spark, d):
    parsed = documents.parse_threads(threads(spark, d)).withColumn("source_path", F.lit("raw/dump.json"))
    return bronze.threads_to_documents(parsed, AT)


@case("legacy_dump_documents", sql("SELECT * FROM thread_docs", "thread_docs"))
def _legacy(spark, d):
    return thread_documents(spark, d).select(*_THREAD_DOC_COLUMNS)


@case(
    "collected_query_flatten",
    sql(
        """SELECT 'run-9' AS run_id, 'q' || conv_id AS query_id, '2024-06-01' AS plan_date, 'v' || conv_id AS video_id,
    'c' || conv_id || '-' || turn || '-' || i.idx AS comment_id, lines[i.idx] AS comment_text
  FROM thr, unnest(range(1, n_replies + 2)) AS i(idx)""",
        "thr",
    ),
)
def _collected(spark, d):
    c = table(spark, d, "conversations")
    lines = F.split("text", "\n")
    fixed = lambda value: F.lit(value)
    comment = lambda text, i: F.struct(
        F.concat_ws("-", F.concat(F.lit("c"), "conv_id"), "turn", i + 1).alias("comment_id"),
        F.col("role").alias("author_name"),
        text.alias("comment_text"),
        i.alias("like_count"),
        fixed(AT).alias("comment_published_at"),
        fixed(AT).alias("comment_updated_at"),
    )
    video = F.struct(
        F.concat(F.lit("v"), "conv_id").alias("video_id"),
        *[
            fixed("").alias(n)
            for n in "video_title video_description channel_id channel_title video_published_at".split()
        ],
        F.transform(lines, comment).alias("comments"),
    )
    queries = c.select(
        F.concat(F.lit("q"), "conv_id").alias("query_id"),
        F.col("role").alias("topic"),
        fixed("g").alias("genre"),
        fixed("t").alias("query_text"),
        F.array(video).alias("videos"),
    )
    out = bronze.flatten_collected(queries, "run-9", AT)
    return out.select("run_id", "query_id", "plan_date", "video_id", "comment_id", "comment_text")


# ------------------------------------------------------------------- events

_EVENT_IDS = """SELECT position, 'p1:' || coalesce(nullif(comment_id, ''), 'unknown-comment-' || position) AS event_id,
    coalesce(topic, '') AS topic, coalesce(comment_text, '') AS comment_text, coalesce(plan_date, '') AS plan_date,
    CASE WHEN regexp_full_match(trim(comment_like_count), '[0-9]+') THEN CAST(trim(comment_like_count) AS BIGINT)
      ELSE 0 END AS comment_like_count, CAST(reply_count AS BIGINT) AS reply_count, run_id FROM unt"""
view("event_rows", _EVENT_IDS, "unt")


def event_messages(spark, d):
    return bronze.build_events(untidy(spark, d), None, "p1", AT)


@case(
    "event_envelopes",
    sql(
        """SELECT event_id AS key, 'youtube.comment.raw.v1' AS event_type, topic, comment_text, comment_like_count,
    reply_count FROM event_rows""",
        "event_rows",
    ),
)
def _envelopes(spark, d):
    events = event_messages(spark, d)
    number = "$.payload."
    return events.select(
        "key",
        F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", number + "topic").alias("topic"),
        F.get_json_object("value", number + "comment_text").alias("comment_text"),
        F.get_json_object("value", number + "comment_like_count").cast("bigint").alias("comment_like_count"),
        F.get_json_object("value", number + "reply_count").cast("bigint").alias("reply_count"),
    )


_STREAM_ROWS = """SELECT 'comments' AS kafka_topic, position % 4 AS kafka_partition, position AS kafka_offset,
    'youtube_kafka_to_bronze' AS ingestion_type, 'p1' AS producer_run_id, event_id, run_id,
    substr(plan_date, 1, 10) AS collection_date, topic, comment_text, comment_like_count, reply_count FROM event_rows"""
_STREAM_COLUMNS = (
    "kafka_topic kafka_partition kafka_offset ingestion_type producer_run_id event_id run_id collection_date topic "
    "comment_text comment_like_count reply_count"
).split()


def log_messages(spark, d):
    """Events as a log holds them, with partition and offset."""
    rows = untidy(spark, d)
    events = bronze.build_events(rows.withColumn("_offset", F.col("position")), None, "p1", AT)
    offset = F.get_json_object(F.get_json_object("value", "$.payload.raw_record_json"), "$._offset").cast("bigint")
    return events.select(
        F.lit("comments").alias("topic"), (offset % 4).alias("partition"), offset.alias("offset"), "key", "value"
    )


@case("envelopes_to_bronze", sql(_STREAM_ROWS, "event_rows"))
def _stream_rows(spark, d):
    return bronze.envelopes_to_bronze(log_messages(spark, d), AT).select(*_STREAM_COLUMNS)


#: Messages in a file of a log. A compressed file is read by one task, so this bounds what that task reads.
_FILE_MESSAGES = 200_000


def write_log(messages, folder: str) -> None:
    """Messages as JSON files, compressed as logs are: a value holds its record twice."""
    messages.write.option("compression", "lz4").option("maxRecordsPerFile", _FILE_MESSAGES).json(folder)


def drained(spark, d) -> str:
    """A lakehouse root into which the log has been drained, twice from the same checkpoint."""
    root, log = scratch(spark, "lakehouse"), scratch(spark, "log")
    checkpoint = scratch(spark, "checkpoint")
    write_log(log_messages(spark, d), log)
    for _ in range(2):
        streaming.consume_to_bronze(
            docstore.read_message_files(spark, log), root, checkpoint, executed_at=AT
        ).awaitTermination()
    return root


@case("stream_consumed_to_bronze", sql(_STREAM_ROWS.replace(" topic,", " coalesce(nullif(topic, ''), '') AS topic,"), "event_rows"))
def _consumed(spark, d):
    rows = read_contract(spark, drained(spark, d), streaming.COMMENTS)
    return rows.withColumn("topic", F.coalesce("topic", F.lit(""))).select(*_STREAM_COLUMNS)


@case(
    "stream_run_log",
    sql(
        """SELECT substr(plan_date, 1, 10) AS collection_date, 'comments' AS topic, count(*) AS messages_consumed,
    'success' AS status FROM event_rows GROUP BY 1""",
        "event_rows",
    ),
)
def _stream_log(spark, d):
    log = read_contract(spark, drained(spark, d), streaming.RUNS)
    return log.groupBy("collection_date", "topic", "status").agg(
        F.sum("messages_consumed").alias("messages_consumed")
    )


@case("published_events", sql("SELECT event_id AS key, count(*) AS messages FROM event_rows GROUP BY 1", "event_rows"))
def _published(spark, d):
    log, out, checkpoint = scratch(spark, "in"), scratch(spark, "out"), scratch(spark, "checkpoint")
    write_log(event_messages(spark, d), log)
    stream = spark.readStream.schema("key string, value string").json(log)
    streaming.publish_stream(stream, checkpoint, "parquet", path=out).awaitTermination()
    return spark.read.parquet(out).groupBy("key").agg(F.count(F.lit(1)).alias("messages"))


def _event_stream(spark, d, copies: int = 1):
    """Engagement rows as a stream of files, each row delivered ``copies`` times."""
    folder = scratch(spark, "events")
    rows = engagement(spark, d).withColumn("event_id", F.col("comment_id"))
    parts = rows.repartitionByRange(3, F.col("comment_published_at").desc())
    for _ in range(copies):
        parts.write.mode("append").parquet(folder)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "2")
    return streaming.event_time(reader.parquet(folder))


@case("stream_without_repeats", sql("SELECT topic, count(*) AS rows FROM eng GROUP BY topic", "eng"))
def _no_repeats(spark, d):
    """Files with the latest publications come first, in several micro-batches, and every row comes twice."""
    out, checkpoint = scratch(spark, "out"), scratch(spark, "checkpoint")
    stream = streaming.without_repeats(_event_stream(spark, d, 2)).select("event_id", "topic")
    streaming.drain(stream, out, checkpoint)
    return spark.read.parquet(out).groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))


_WINDOW = """SELECT strftime(date_trunc('day', comment_published_at), '%Y-%m-%d %H:%M:%S') AS window_start, topic, genre,
    count(*) AS comments_count, count(*) FILTER (sentiment_label = 'positive') AS positive_comments,
    count(*) FILTER (sentiment_label = 'neutral') AS neutral_comments,
    count(*) FILTER (sentiment_label = 'negative') AS negative_comments,
    round(avg(sentiment_score), 4) AS avg_sentiment_score, CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes
  FROM eng GROUP BY 1, 2, 3"""


@case("stream_daily_windows", sql(_WINDOW, "eng"))
def _windows(spark, d):
    """Several micro-batches out of order; a window that grows is replaced, the last day's included."""
    out, checkpoint = scratch(spark, "out"), scratch(spark, "checkpoint")
    streaming.drain_windows(streaming.windowed_mart(_event_stream(spark, d)), out, checkpoint)
    return streaming.read_windows(spark, out)


# ------------------------------------------------------------------- silver

_TYPED = f"""SELECT trim(run_id) AS run_id, TRY_CAST(collection_date AS DATE) AS collection_date,
    trim(topic, ' ') AS topic, trim(query_id, ' ') AS query_id, trim(comment_id, ' ') AS comment_id,
    trim(comment_text, ' ') AS comment_text,
    CASE WHEN regexp_full_match(trim(comment_like_count, {WS}), '[0-9]+')
      THEN CAST(trim(comment_like_count) AS DOUBLE) END AS comment_like_count, CAST(reply_count AS BIGINT) AS reply_count,
    TRY_CAST(comment_published_at AS TIMESTAMP) AS comment_published_at,
    TRY_CAST(comment_updated_at AS TIMESTAMP) AS comment_updated_at,
    TRY_CAST(ingested_at AS TIMESTAMP) AS ingested_at, CAST(NULL AS VARCHAR) AS video_description, position
  FROM unt"""
view("typed", _TYPED, "unt")
view("complete", "SELECT * FROM typed WHERE comment_id <> '' AND comment_text <> ''", "typed")
view(
    "silver_rows",
    """SELECT * FROM complete QUALIFY row_number() OVER (PARTITION BY comment_id
    ORDER BY comment_updated_at DESC NULLS LAST, comment_published_at DESC NULLS LAST, ingested_at DESC NULLS LAST) = 1""",
    "complete",
)
_SILVER_COLUMNS = (
    "run_id collection_date topic query_id comment_id comment_text comment_like_count reply_count "
    "comment_published_at comment_updated_at ingested_at video_description"
).split()
_SILVER_SQL = ", ".join(_SILVER_COLUMNS)


def _silver_view(df):
    return df.withColumn("comment_like_count", F.col("comment_like_count").cast("double")).select(*_SILVER_COLUMNS)


@case("curated_projection", sql(f"SELECT {_SILVER_SQL} FROM typed", "typed"))
def _curated(spark, d):
    return _silver_view(silver.curate(untidy(spark, d)))


@case("required_fields", sql(f"SELECT {_SILVER_SQL} FROM complete", "complete"))
def _required(spark, d):
    return _silver_view(silver.has_required_fields(silver.curate(untidy(spark, d))))


@case("latest_comment_versions", sql(f"SELECT {_SILVER_SQL} FROM silver_rows", "silver_rows"))
def _latest(spark, d):
    return _silver_view(silver.build_silver(untidy(spark, d)))


@case(
    "keep_last_by_key",
    sql(
        """SELECT video_id, max(ingested_at) AS ingested_at, count(*) AS one FROM (
    SELECT video_id, ingested_at FROM unt
    QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ingested_at DESC) = 1) GROUP BY video_id""",
        "unt",
    ),
)
def _keep_last(spark, d):
    last = silver.keep_last(untidy(spark, d), ["video_id"])
    return last.groupBy("video_id").agg(F.max("ingested_at").alias("ingested_at"), F.count(F.lit(1)).alias("one"))


@case(
    "bronze_union_by_name",
    sql(
        """SELECT 'daily' AS source_table, run_id, comment_id, CAST(NULL AS VARCHAR) AS event_id, count(*) AS n
  FROM unt WHERE position % 2 = 0 GROUP BY ALL
  UNION ALL SELECT 'kafka', run_id, comment_id, 'e' || position, count(*) FROM unt WHERE position % 2 = 1 GROUP BY ALL""",
        "unt",
    ),
)
def _union(spark, d):
    u = untidy(spark, d)
    daily = u.filter("position % 2 = 0").drop("position")
    streamed = u.filter("position % 2 = 1").withColumn("event_id", F.concat(F.lit("e"), "position")).drop("position")
    out = silver.union_bronze({"daily": daily, "kafka": streamed, "absent": None})
    return out.groupBy("source_table", "run_id", "comment_id", "event_id").agg(F.count(F.lit(1)).alias("n"))


@case("silver_job", sql(f"SELECT {_SILVER_SQL} FROM silver_rows", "silver_rows"))
def _silver_job(spark, d):
    root = scratch(spark, "lakehouse")
    jobs.build_silver(spark, root, untidy(spark, d))
    return _silver_view(read_contract(spark, root, jobs.SILVER))


# -------------------------------------------------------------------- sinks


@case(
    "partitioned_append",
    sql(
        "SELECT collection_date, topic, genre, 2 * count(*) AS rows FROM eng GROUP BY ALL",
        "eng",
    ),
)
def _append(spark, d):
    path = scratch(spark, "table")
    for _ in range(2):
        append(engagement(spark, d), path, ["collection_date", "topic", "genre"])
    read = spark.read.option("basePath", path).schema(engagement(spark, d).schema).parquet(path)
    return read.groupBy("collection_date", "topic", "genre").agg(F.count(F.lit(1)).alias("rows"))


@case(
    "overwrite_touched_partitions",
    sql(
        """SELECT collection_date, count(*) AS rows, CAST(sum(comment_like_count) AS BIGINT) AS likes FROM eng
  WHERE collection_date < '2024-01-20' OR topic = 'click' GROUP BY collection_date""",
        "eng",
    ),
)
def _overwrite(spark, d):
    path = scratch(spark, "table")
    rows = engagement(spark, d)
    overwrite(rows, path, ["collection_date"])
    later = rows.filter("collection_date >= '2024-01-20' AND topic = 'click'")
    overwrite(later, path, ["collection_date"], only_touched_partitions=True)
    read = spark.read.schema(rows.schema).parquet(path)
    return read.groupBy("collection_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("comment_like_count").alias("likes")
    )


@case(
    "contract_checked_write",
    sql("SELECT comment_id, topic, CAST(collection_date AS VARCHAR) AS collection_date, sentiment_score FROM eng", "eng"),
)
def _contract(spark, d):
    root = scratch(spark, "lakehouse")
    write_contract(engagement(spark, d), jobs.SCORED, root, "overwrite")
    return read_contract(spark, root, jobs.SCORED).select("comment_id", "topic", "collection_date", "sentiment_score")


_UPSERT_SQL = """SELECT coalesce(s.comment_id, f.comment_id) AS comment_id,
    CASE WHEN f.comment_id IS NOT NULL THEN f.topic ELSE s.topic END AS topic,
    coalesce(f.likes, s.likes) AS likes, s.note, CASE WHEN s.comment_id IS NULL THEN 'upserted'
      WHEN f.comment_id IS NULL THEN NULL WHEN s.likes <> f.likes OR s.topic <> f.topic THEN 'modified'
      ELSE 'matched' END AS action
  FROM (SELECT comment_id, topic, comment_like_count AS likes, 'kept' AS note FROM eng WHERE reply_count < 60) s
  FULL JOIN (SELECT comment_id, topic, CASE WHEN reply_count % 2 = 0 THEN 7 ELSE comment_like_count END AS likes
    FROM eng WHERE reply_count > 30) f ON s.comment_id = f.comment_id"""
view("upserted", _UPSERT_SQL, "eng")


def upsert_sides(spark, d):
    """Stored rows, fresh rows, and what the upsert takes of these with blanks and older copies among them."""
    rows = engagement(spark, d).withColumns(
        {"run_id": F.lit("r"), "query_id": F.col("genre"), "likes": F.col("comment_like_count")}
    )
    keys = list(upsert.DOCUMENT_KEY)
    stored = rows.filter("reply_count < 60").select(*keys, "topic", "likes", F.lit("kept").alias("note"))
    changed = F.when(F.col("reply_count") % 2 == 0, F.lit(7).cast("bigint")).otherwise(F.col("likes"))
    fresh = rows.filter("reply_count > 30").select(*keys, "topic", changed.alias("likes"), "comment_published_at")
    blanks = fresh.withColumn("comment_id", F.lit(""))
    twice = fresh.withColumns({"comment_published_at": F.lit(None).cast("timestamp_ntz"), "likes": F.lit(-1).cast("bigint")})
    order = [F.col("comment_published_at").desc_nulls_last()]
    incoming = upsert.upsertable(fresh.union(blanks).union(twice), order).drop("comment_published_at")
    return stored, fresh, incoming


def _merged(spark, d):
    stored, fresh, incoming = upsert_sides(spark, d)
    return stored, fresh, upsert.merge_rows(stored, incoming)


@case("keyed_upsert", sql("SELECT * FROM upserted", "upserted"))
def _upsert(spark, d):
    return _merged(spark, d)[2].select("comment_id", "topic", "likes", "note", F.col("_action").alias("action"))


@case(
    "upsert_counts",
    sql(
        """SELECT (SELECT count(*) FROM eng WHERE reply_count > 30) AS input_documents,
    count(*) FILTER (action IN ('matched', 'modified')) AS matched_documents,
    count(*) FILTER (action = 'modified') AS modified_documents,
    count(*) FILTER (action = 'upserted') AS upserted_documents FROM upserted""",
        "upserted",
    ),
)
def _counts(spark, d):
    _, fresh, merged = _merged(spark, d)
    return upsert.merge_counts(merged, fresh.agg(F.count(F.lit(1)).alias("n")).scalar())


@case("batched_writes", sql("SELECT count(*) AS documents FROM eng", "eng"))
def _batches(spark, d):
    def deliver(batch: list[dict]) -> int:
        return len(batch)

    written = upsert.write_in_batches(engagement(spark, d).select("comment_id", "topic"), deliver, 1000)
    return written.agg(F.sum("documents").alias("documents"))


@case(
    "daily_run_log",
    sql(
        f"""SELECT m.run_id, substr(generated_at, 1, 10) AS collection_date, '{AT}' AS executed_at,
    'youtube_daily_api_to_bronze' AS ingestion_type, m.manifest_path, CAST(40 AS BIGINT) AS queries_executed,
    total_comments_collected, n AS ingested_records, CAST(0 AS BIGINT) AS error_count, 'success' AS status
  FROM man m JOIN (SELECT manifest_path, count(*) AS n FROM daily_bronze GROUP BY 1) USING (manifest_path)""",
        "daily_bronze",
    ),
)
def _run_log(spark, d):
    log = runlogs.daily_run_log(manifests(spark, d), daily_bronze(spark, d), AT)
    return log.select(
        "run_id", "collection_date", "executed_at", "ingestion_type", "manifest_path", "queries_executed",
        "total_comments_collected", "ingested_records", "error_count", "status",
    )


@case(
    "document_store_run_log",
    sql(
        f"""SELECT 'm1' AS run_id, '2024-06-01' AS collection_date, 'youtube_mongo_raw_to_bronze_dry_run' AS ingestion_type,
    'mongo_collection_date=all;limit=none' AS normalized_comments_path, (SELECT count(*) FROM unt) AS
    total_comments_collected, (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM doc_bronze)) AS ingested_records,
    'dry_run' AS status""",
        "doc_bronze",
    ),
)
def _store_log(spark, d):
    u = untidy(spark, d)
    written = bronze.documents_to_bronze(u, AT)
    log = runlogs.collection_run_log(spark, u.count(), written.count(), "m1", AT, "store", dry_run=True)
    return log.select(
        "run_id", "collection_date", "ingestion_type", "normalized_comments_path", "total_comments_collected",
        "ingested_records", "status",
    )


@case(
    "historical_run_log",
    sql(
        f"""SELECT 'h1' AS run_id, '2024-06-01' AS run_date, 'historical_bootstrap' AS ingestion_mode,
    count(*) AS records_fetched, count(*) AS records_written, 'success' AS status, '{AT}' AS created_at FROM thc""",
        "thc",
    ),
)
def _historical_log(spark, d):
    rows = bronze.flatten_threads(documents.parse_threads(threads(spark, d)), "h1")
    log = runlogs.historical_run_log(rows, "h1", AT)
    return log.select("run_id", "run_date", "ingestion_mode", "records_fetched", "records_written", "status", "created_at")


# ------------------------------------------------------------------ sources


def document_files(spark, d) -> str:
    """One JSON document per day of records, in each of the three accepted shapes, one folder per run."""
    folder = scratch(spark, "runs")
    rows = records(spark, d).withColumn("record", F.to_json(F.struct("position", "topic", "comment_id", "like_count")))
    grouped = rows.groupBy("run_folder").agg(F.array_sort(F.collect_list("record")).alias("r"))
    listed = F.concat(F.lit("["), F.array_join("r", ","), F.lit(", 5, null]"))
    shape = F.pmod(F.substring("run_folder", -2, 2).cast("int"), F.lit(3))
    document = (
        F.when(shape == 0, listed)
        .when(shape == 1, F.concat(F.lit('{"comments": '), listed, F.lit("}")))
        .otherwise(F.concat(F.lit('{"records": '), listed, F.lit("}")))
    )
    grouped.select(document.alias("value"), "run_folder").write.partitionBy("run_folder").text(folder)
    return folder


@case(
    "json_document_shapes",
    sql("SELECT 'run_folder=' || run_folder AS run_folder, topic, like_count, count(*) AS rows FROM unt GROUP BY ALL", "unt"),
)
def _shapes(spark, d):
    found = documents.read_run_records(spark, f"{document_files(spark, d)}/*/*.txt")
    return found.groupBy("run_folder", "topic", "like_count").agg(F.count(F.lit(1)).alias("rows"))


def manifest_files(spark, d):
    """A manifest file in each run folder, with a list that is no field."""
    folder = scratch(spark, "runs")
    fields = F.struct("run_id", "generated_at", "plan_path", "normalized_comments_path", "queries_executed", "total_comments_collected", F.array("run_id").alias("comments"))
    manifests(spark, d).select(F.to_json(fields).alias("value"), "run_folder").write.partitionBy("run_folder").text(folder)
    return f"{folder}/*/*.txt"


@case(
    "manifest_reader",
    sql(
        """SELECT 'run_folder=' || run_folder AS run_folder, run_id, generated_at, plan_path, normalized_comments_path,
    '40' AS queries_executed, CAST(total_comments_collected AS VARCHAR) AS total_comments_collected FROM man""",
        "man",
    ),
)
def _manifests(spark, d):
    return documents.read_manifests(spark, manifest_files(spark, d)).select(
        "run_folder", "run_id", "generated_at", "plan_path", "normalized_comments_path", "queries_executed", "total_comments_collected"
    )


@case("plan_reader", sql("SELECT query_id, query_text, topic, genre, cadence, priority, expected_units, language_target FROM plan", "plan"))
def _plan_reader(spark, d):
    folder = scratch(spark, "plan")
    rows = plan_rows(spark, d)
    listed = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("selected_queries"))
    listed.select(F.to_json(F.struct("selected_queries")).alias("value")).write.text(folder)
    return documents.read_plan(spark, f"{folder}/*.txt").select(*rows.columns)


@case(
    "latest_run",
    sql("SELECT run_id, manifest_path, total_comments_collected FROM man ORDER BY manifest_path DESC LIMIT 1", "man"),
)
def _latest_run(spark, d):
    out = documents.latest_run(manifests(spark, d))
    return out.select("run_id", "manifest_path", F.col("total_comments_collected").cast("bigint").alias(
        "total_comments_collected"))


@case(
    "collection_scan",
    sql(
        f"""SELECT collection_date, {_KEY}, position FROM unt WHERE collection_date = '2024-01-09'
  ORDER BY collection_date NULLS FIRST, run_id NULLS FIRST, query_id NULLS FIRST, video_id NULLS FIRST,
    comment_id NULLS FIRST, position LIMIT 40""",
        "unt",
    ),
)
def _scan(spark, d):
    unique = untidy(spark, d)
    tied = unique.withColumn("comment_id", F.concat_ws("~", F.coalesce("comment_id", F.lit("\x01")), F.lpad(
        F.col("position").cast("string"), 9, "0")))
    found = docstore.scan_collection(tied, "2024-01-09", 40)
    original = F.substring_index("comment_id", "~", 1)
    restored = F.when(original == "\x01", F.lit(None).cast("string")).otherwise(original)
    return found.select(
        "collection_date", "run_id", "query_id", "video_id", restored.alias("comment_id"), "position"
    )


@case(
    "backfill_limits",
    sql(
        """SELECT source_type, source_path, count(*) AS documents_prepared FROM (
    SELECT 'daily_manifest' AS source_type, normalized_comments_path AS source_path FROM daily_bronze
    WHERE comment_id <> '' AND run_id IN (SELECT run_id FROM man ORDER BY manifest_path LIMIT 5)
    QUALIFY row_number() OVER (PARTITION BY normalized_comments_path ORDER BY position) <= 100) GROUP BY ALL""",
        "daily_bronze",
    ),
)
def _backfill_limits(spark, d):
    first = documents.first_runs(manifests(spark, d), 5)
    docs = bronze.records_to_documents(records(spark, d), first, plan_rows(spark, d), AT)
    tagged = docs.withColumns({"source_type": F.lit("daily_manifest"), "source_path": F.col("source_file_path")})
    return documents.source_summary(documents.limit_per_source(tagged, 100))


# --------------------------------------------------------------------- jobs


@case(
    "bronze_daily_job",
    sql(f"SELECT {_COLUMNS} FROM daily_bronze", "daily_bronze"),
)
def _bronze_job(spark, d):
    """Run twice: the second run adds nothing."""
    root = scratch(spark, "lakehouse")
    for _ in range(2):
        jobs.bronze_daily(spark, root, records(spark, d), manifests(spark, d), plan_rows(spark, d), AT)
    return read_contract(spark, root, jobs.DAILY).select(*_BRONZE_COLUMNS)


@case("document_store_job", sql(f"""SELECT {', '.join(_DOC_BRONZE)} FROM (
    SELECT * FROM doc_newest WHERE ({_KEY}) NOT IN (SELECT ({_KEY}) FROM doc_day) UNION ALL BY NAME SELECT * FROM doc_day)""",
    "doc_newest",
    view("doc_day", f"""SELECT *, '' AS video_published_at FROM doc_bronze WHERE collection_date = '2024-01-07'
    QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY comment_updated_at DESC) = 1""", "doc_bronze")))
def _store_job(spark, d):
    """One day first, then all: rows whose key the first run wrote stay as they are."""
    root = scratch(spark, "lakehouse")
    found = untidy(spark, d)
    jobs.bronze_collection(spark, root, found, "store", collection_date="2024-01-07", at=AT)
    jobs.bronze_collection(spark, root, found, "store", at=AT)
    return read_contract(spark, root, jobs.DAILY).select(*_DOC_BRONZE)


@case(
    "backfill_job",
    sql(
        """SELECT run_id, query_id, video_id, thread_id, comment_id, comment_text, like_count, comment_level FROM thread_docs
  QUALIFY row_number() OVER (PARTITION BY query_id, video_id, comment_id) = 1""",
        "thread_docs",
    ),
)
def _backfill(spark, d):
    source = thread_documents(spark, d).withColumns(
        {
            "source_type": F.lit("legacy_dump"),
            "source_path": F.col("source_file_path"),
            "position": F.xxhash64("comment_id"),
        }
    )
    first, second = scratch(spark, "store"), scratch(spark, "store")
    jobs.backfill(spark, [source], f"{first}/absent", first)
    jobs.backfill(spark, [source], first, second)
    return spark.read.parquet(second).select(
        "run_id", "query_id", "video_id", "thread_id", "comment_id", "comment_text", "like_count", "comment_level"
    )


view(
    "day_silver",
    """SELECT * FROM daily_bronze WHERE comment_id <> '' AND comment_text <> ''
  QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY TRY_CAST(comment_updated_at AS TIMESTAMP) DESC NULLS LAST,
    TRY_CAST(comment_published_at AS TIMESTAMP) DESC NULLS LAST) = 1""",
    "daily_bronze",
)


@case(
    "daily_run_job",
    sql("SELECT collection_date, platform, count(*) AS comments_count FROM day_silver GROUP BY ALL", "day_silver"),
)
def _daily_run(spark, d):
    root = scratch(spark, "lakehouse")
    plan = registry(spark, d).withColumn("platform", F.lit("youtube"))
    jobs.daily_run(
        spark, root, plan, records(spark, d), manifests(spark, d), summaries(spark, d), errors(spark, d), at=AT,
    )
    kpis = read_contract(spark, root, "gold.youtube_sentiment_overview_kpis")
    return kpis.select("collection_date", "platform", "comments_count")


@case(
    "custom_query_refresh",
    sql("SELECT collection_date, platform, count(*) AS comments_count FROM day_silver GROUP BY ALL", "day_silver"),
)
def _refresh(spark, d):
    """The day with two thirds of its records, then a custom query that brings the rest: the marts are those of all."""
    root = scratch(spark, "lakehouse")
    plan = registry(spark, d).withColumn("platform", F.lit("youtube"))
    all_records, rest = records(spark, d), F.col("position") % 3 == 0
    jobs.daily_run(spark, root, plan, all_records.filter(~rest), manifests(spark, d), summaries(spark, d), errors(spark, d), at=AT)
    query = table(spark, d, "nation").limit(1).select(
        F.lit("youtube").alias("platform"), F.lower("n_name").alias("query_text"), F.lit(5).alias("priority"), F.lit(50).cast("bigint").alias("expected_units")
    )
    jobs.custom_query_refresh(spark, root, plan, query, {}, all_records.filter(rest), manifests(spark, d), AT)
    kpis = read_contract(spark, root, "gold.youtube_sentiment_overview_kpis")
    return kpis.select("collection_date", "platform", "comments_count")
