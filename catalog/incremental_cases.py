"""Tables that change in parts, and jobs compared over all the tables they write."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import METRICS, RATIOS, VIEWS, case, engagement, manifests, plan_rows, registry, scratch, sql, table, threads, untidy, view
from catalog.bronze_cases import (
    _SILVER_SQL,
    _STREAM_COLUMNS,
    _STREAM_ROWS,
    AT,
    _silver_view,
    log_messages,
    records,
    thread_documents,
    upsert_sides,
    write_log,
)
from catalog.mart_cases import scored_table
from voxlake.operators import filters, marts
from voxlake.plans import jobs
from voxlake.sinks import buckets
from voxlake.sources import connector, documents
from voxlake.sources.tables import load_marts, read_contract
from voxlake.streaming import events as streaming
from voxlake.streaming import latest, offsets

# ------------------------------------------------------------------ one long table of many


def long_form(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """``table_name, row_key, measure, value``: every number of a table, beside its keys as text."""
    numbers = [c for c, kind in df.dtypes if c not in keys and kind in ("bigint", "int", "double")]
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in numbers]))
    return df.select(F.lit(name).alias("table_name"), key.alias("row_key"), each)


def long_sql(name: str, source: str, keys: list[str], numbers: list[str]) -> str:
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
    names, values = ", ".join(f"'{n}'" for n in numbers), ", ".join(f"CAST({n} AS DOUBLE)" for n in numbers)
    return f"SELECT '{name}' AS table_name, {key} AS row_key, unnest([{names}]) AS measure, unnest([{values}]) AS value FROM {source}"


_COUNTED = (
    "comments_count positive_comments neutral_comments negative_comments avg_sentiment_score avg_sentiment_confidence "
    "avg_negative_probability avg_neutral_probability avg_positive_probability total_comment_likes avg_comment_likes"
).split()
_SHARES = ["positive_ratio", "negative_ratio"]
_DAY = ["collection_date", "topic", "genre"]
#: Gold tables by the SQL view that has the same rows: table, keys, numbers.
GOLD = {
    "daily_summary": ("gold.youtube_sentiment_daily_summary", _DAY, [*_COUNTED, *_SHARES]),
    "video_summary": ("gold.youtube_sentiment_video_summary", [*_DAY, "video_id", "video_title", "channel_title"], [*_COUNTED, *_SHARES]),
    "topic_summary": ("gold.youtube_sentiment_topic_summary", ["topic", "genre"], ["collection_dates_seen", "videos_covered", *_COUNTED, *_SHARES]),
    "daily_trend": ("gold.youtube_sentiment_daily_trend", _DAY, ["videos_covered", *_COUNTED, *_SHARES]),
    "weekday_hour": ("gold.youtube_sentiment_weekday_hour_engagement", [*_DAY, "weekday_name", "comment_hour_24"], ["videos_covered", *_COUNTED]),
    "keywords": ("gold.youtube_sentiment_keyword_frequency", [*_DAY, "keyword"], ["keyword_count", "distinct_comments", "avg_sentiment_score"]),
    "overview_kpis": (
        "gold.youtube_sentiment_overview_kpis",
        ["collection_date", "platform"],
        ["topics_covered", "genres_covered", "videos_covered", *_COUNTED, *_SHARES],
    ),
    "dtm": (
        "gold.youtube_comments_daily_topic_metrics",
        ["metric_date", "topic", "genre"],
        "comment_count distinct_videos avg_sentiment_score positive_comments neutral_comments negative_comments "
        "avg_sentiment_confidence avg_negative_probability avg_neutral_probability avg_positive_probability "
        "total_like_count total_reply_count avg_like_count".split(),
    ),
}
_SENTIMENT, _DESCRIPTIVE = ["daily_summary", "video_summary"], ["topic_summary", "daily_trend", "weekday_hour", "overview_kpis"]


def all_tables(spark, root: str, names: list[str]) -> DataFrame:
    out = None
    for name in names:
        key, keys, numbers = GOLD[name]
        one = long_form(read_contract(spark, root, key).select(*keys, *numbers), name, keys)
        out = one if out is None else out.unionByName(one)
    return out


def all_tables_sql(names: list[str], prefix: str = "") -> str:
    return sql("\nUNION ALL ".join(long_sql(n, prefix + n, *GOLD[n][1:]) for n in names), *[prefix + n for n in names])


@case("sentiment_gold_job_tables", all_tables_sql(_SENTIMENT))
def _sentiment_tables(spark, d):
    root = scored_table(spark, d)
    jobs.sentiment_gold(spark, root, at=AT)
    return all_tables(spark, root, _SENTIMENT)


@case("descriptive_gold_job_tables", all_tables_sql(_DESCRIPTIVE))
def _descriptive_tables(spark, d):
    root = scored_table(spark, d)
    jobs.descriptive_gold(spark, root, at=AT)
    return all_tables(spark, root, _DESCRIPTIVE)


# ------------------------------------------------------------------ states of days


@case("topic_summary_from_day_states", sql("SELECT * FROM topic_summary", "topic_summary"))
def _topic_states(spark, d):
    return marts.from_states(marts.day_states(engagement(spark, d)), "topic_summary")


for _unit in ("week", "month"):
    case(
        f"{_unit}_from_day_states",
        sql(
            f"""SELECT strftime(date_trunc('{_unit}', CAST(collection_date AS DATE)), '%Y-%m-%d') AS period_start, topic, genre,
    count(DISTINCT collection_date) AS collection_dates_seen, count(DISTINCT video_id) AS videos_covered, {METRICS}, {RATIOS}
  FROM eng GROUP BY 1, 2, 3""",
            "eng",
        ),
    )(lambda spark, d, unit=_unit: marts.period_summary(marts.day_states(engagement(spark, d)), unit))


# ------------------------------------------------------------------ buckets


@case("bucketed_upsert", sql("SELECT comment_id, topic, likes, note FROM upserted", "upserted"))
def _bucketed(spark, d):
    """Stored rows first, then the incoming ones twice: the second time no bucket is written."""
    path = scratch(spark, "store")
    stored, _, incoming = upsert_sides(spark, d)
    buckets.upsert(spark, path, stored, buckets=8)
    buckets.upsert(spark, path, incoming)
    if buckets.upsert(spark, path, incoming)["buckets_written"]:
        raise ValueError("a repeated upsert has written")
    return buckets.read(spark, path).select("comment_id", "topic", "likes", "note")


@case(
    "bucketed_backfill_job",
    sql(
        """SELECT run_id, query_id, video_id, thread_id, comment_id, comment_text, like_count, comment_level FROM thread_docs
  QUALIFY row_number() OVER (PARTITION BY query_id, video_id, comment_id) = 1""",
        "thread_docs",
    ),
)
def _bucketed_backfill(spark, d):
    tags = {"source_type": F.lit("legacy_dump"), "source_path": F.col("source_file_path"), "position": F.xxhash64("comment_id")}
    source, path = thread_documents(spark, d).withColumns(tags), scratch(spark, "store")
    for _ in range(2):
        jobs.backfill(spark, [source], path)
    return buckets.read(spark, path).select(
        "run_id", "query_id", "video_id", "thread_id", "comment_id", "comment_text", "like_count", "comment_level"
    )


# ------------------------------------------------------------------ logs and streams

_TAKEN = " + ".join(f"({n} // 4 + CASE WHEN kafka_partition < {n} % 4 THEN 1 ELSE 0 END)" for n in ("n1", "n2"))


@case(
    "exact_drain",
    sql(
        f"""SELECT * EXCLUDE (n1, n2) REPLACE (coalesce(nullif(topic, ''), '') AS topic) FROM (
    SELECT r.*, count(*) OVER () // 5 AS n1, count(*) OVER () // 7 AS n2 FROM ({_STREAM_ROWS}) r)
  QUALIFY row_number() OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) <= {_TAKEN}""",
        "event_rows",
    ),
)
def _exact_drain(spark, d):
    """A fifth of the log, then a seventh: exactly so many messages, shared out evenly over its four partitions."""
    root, folder = scratch(spark, "lakehouse"), scratch(spark, "log")
    write_log(log_messages(spark, d), folder)
    log = spark.read.schema("topic string, partition bigint, offset bigint, key string, value string").json(folder)
    n = log.count()
    for part in (n // 5, n // 7):
        taken = offsets.drain_log(spark, log, root, "checked", part, AT)["messages_consumed"]
        if taken != part:
            raise ValueError(f"{taken} messages instead of {part}")
    rows = read_contract(spark, root, streaming.COMMENTS)
    return rows.withColumn("topic", F.coalesce("topic", F.lit(""))).select(*_STREAM_COLUMNS)


@case("latest_versions_stream", sql(f"SELECT {_SILVER_SQL} FROM silver_rows", "silver_rows"))
def _latest_stream(spark, d):
    """Files with the newest versions come first; the stream is stopped and started again between the files."""
    folder, path, checkpoint = scratch(spark, "in"), scratch(spark, "latest"), scratch(spark, "checkpoint")
    rows = untidy(spark, d).withColumn("source_table", F.lit("daily"))
    for part in (1, 0):
        rows.filter(F.col("position") % 2 == part).write.mode("append").parquet(folder)
        latest.drain_latest(spark.readStream.schema(rows.schema).parquet(folder), path, checkpoint, dealt=8)
    return _silver_view(latest.read_latest(spark, path))


# ------------------------------------------------------------------ days refreshed in place


def opinions(spark, d) -> DataFrame:
    """Records whose texts have an opinion; topic and genre are told by the record, whatever plan it is loaded with.

    Every text has four tokens, so that scores are exact; updates differ in their microseconds, so that none tie.
    """
    said = F.when(F.col("position") % 4 == 0, "great").when(F.col("position") % 4 == 1, "terrible").otherwise("plain")
    text = F.concat(F.lit("this is "), said, F.lit(" fine"))
    return records(spark, d).withColumns(
        {
            "comment_text": F.when(F.trim("comment_text") == "", "").otherwise(text),
            "topic": F.concat(F.lit("t"), F.col("position") % 3),
            "genre": F.concat(F.lit("g"), F.col("position") % 2),
            "comment_updated_at": F.concat("comment_updated_at", F.lit("."), F.lpad(F.col("position").cast("string"), 6, "0")),
        }
    )


view(
    "opin_silver",
    """SELECT * FROM daily_bronze WHERE comment_id <> '' AND comment_text <> ''
  QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY
    TRY_CAST(nullif(comment_updated_at, '') || '.' || lpad(CAST(position AS VARCHAR), 6, '0') AS TIMESTAMP) DESC NULLS LAST,
    TRY_CAST(comment_published_at AS TIMESTAMP) DESC NULLS LAST) = 1""",
    "daily_bronze",
)
view(
    "opin_eng",
    """SELECT *, greatest(sentiment_score, -sentiment_score, 1 - abs(sentiment_score)) AS sentiment_confidence,
    greatest(-sentiment_score, 0.0::DOUBLE) AS negative_probability, 1 - abs(sentiment_score) AS neutral_probability,
    greatest(sentiment_score, 0.0::DOUBLE) AS positive_probability
  FROM (SELECT * REPLACE (TRY_CAST(comment_published_at AS TIMESTAMP) AS comment_published_at,
      CASE said WHEN 0 THEN 'this is great fine' WHEN 1 THEN 'this is terrible fine' ELSE 'this is plain fine' END AS comment_text,
      't' || position % 3 AS topic, 'g' || position % 2 AS genre),
      CASE said WHEN 0 THEN 0.25::DOUBLE WHEN 1 THEN -0.25::DOUBLE ELSE 0.0::DOUBLE END AS sentiment_score,
      CASE said WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS sentiment_label
    FROM (SELECT *, position % 4 AS said FROM opin_silver))""",
    "opin_silver",
)
for _name in GOLD:
    _body = VIEWS[_name]
    if _name == "keywords":
        view("opin_words", VIEWS["words"].replace("FROM com ", "FROM opin_eng "), "opin_eng")
        view("opin_keywords", _body.replace("FROM words", "FROM opin_words"), "opin_words")
    else:
        view(f"opin_{_name}", _body.replace("FROM eng", "FROM opin_eng"), "opin_eng")
# Hours exist only where a publication time does.
VIEWS["opin_weekday_hour"] = VIEWS["opin_weekday_hour"].replace("FROM opin_eng", "FROM opin_eng WHERE comment_published_at IS NOT NULL")


def built(spark, d, given: DataFrame) -> str:
    """A lakehouse root with everything built from these records."""
    root = scratch(spark, "lakehouse")
    jobs.bronze_daily(spark, root, given, manifests(spark, d), plan_rows(spark, d), AT)
    jobs.build_silver(spark, root)
    jobs.score_silver(spark, root, AT)
    jobs.sentiment_gold(spark, root, AT)
    jobs.descriptive_gold(spark, root, AT)
    jobs.predictive_gold(spark, root)
    return root


@case("daily_chain_tables", all_tables_sql(list(GOLD), "opin_"))
def _chain_tables(spark, d):
    """All gold tables of comments, from records to marts."""
    return all_tables(spark, built(spark, d, opinions(spark, d)), list(GOLD))


@case("custom_query_refresh_tables", all_tables_sql(list(GOLD), "opin_"))
def _refresh_tables(spark, d):
    """Two thirds of the queries first, the rest by a refresh that reads and writes the touched dates: the tables of all."""
    given = opinions(spark, d)
    rest = F.regexp_extract("query_id", "([0-9]+)", 1).cast("int") % 3 == 0
    root = built(spark, d, given.filter(~rest))
    plan = registry(spark, d).withColumn("platform", F.lit("youtube"))
    query = table(spark, d, "nation").filter("n_nationkey = 0").select(
        F.lit("youtube").alias("platform"), F.lower("n_name").alias("query_text"), F.lit(5).alias("priority"), F.lit(50).cast("bigint").alias("expected_units")
    )
    jobs.custom_query_refresh(spark, root, plan, query, {}, given.filter(rest), manifests(spark, d), AT)
    return all_tables(spark, root, list(GOLD))


@case(
    "score_job_values",
    sql(
        """SELECT comment_id, sentiment_score, sentiment_label, sentiment_confidence, negative_probability,
    neutral_probability, positive_probability, CAST(4 AS BIGINT) AS token_count FROM opin_eng""",
        "opin_eng",
    ),
)
def _score_values(spark, d):
    """Every score column of the scored table, with the default lexicon."""
    root = scratch(spark, "lakehouse")
    jobs.bronze_daily(spark, root, opinions(spark, d), manifests(spark, d), plan_rows(spark, d), AT)
    jobs.build_silver(spark, root)
    jobs.score_silver(spark, root, AT)
    return read_contract(spark, root, jobs.SCORED).select(
        "comment_id", "sentiment_score", "sentiment_label", "sentiment_confidence", "negative_probability",
        "neutral_probability", "positive_probability", "token_count",
    )


#: Frames of the mart bundle and the SQL views of their rows.
_BUNDLE = {
    "sentiment_daily_summary": "daily_summary",
    "sentiment_video_summary": "video_summary",
    "sentiment_topic_summary": "topic_summary",
    "sentiment_daily_trend": "daily_trend",
    "sentiment_weekday_hour_engagement": "weekday_hour",
    "sentiment_overview_kpis": "overview_kpis",
}


@case("mart_bundle_values", all_tables_sql(list(_BUNDLE.values())))
def _bundle_values(spark, d):
    """Every number of the marts that pages read, as the bundle gives them."""
    root = scored_table(spark, d)
    jobs.sentiment_gold(spark, root, at=AT)
    jobs.descriptive_gold(spark, root, at=AT)
    bundle, out = load_marts(spark, root), None
    for frame, name in _BUNDLE.items():
        _, keys, numbers = GOLD[name]
        part = long_form(bundle[frame].select(*keys, *numbers), name, keys)
        out = part if out is None else out.unionByName(part)
    return out


@case(
    "day_bounds_of_a_range",
    sql(
        """SELECT strftime(comment_published_at, '%Y-%m-%d') AS day, count(*) AS zoned, count(*) AS unzoned FROM eng
  WHERE comment_published_at >= TIMESTAMP '2024-01-05' AND comment_published_at < TIMESTAMP '2024-01-11' GROUP BY 1""",
        "eng",
    ),
)
def _day_bounds(spark, d):
    """An inclusive range of days against times with and without a zone: the same rows."""
    low, high = filters.day_bounds("2024-01-05", "2024-01-10")
    rows = engagement(spark, d).select(F.col("comment_published_at").cast("timestamp").alias("z"), F.col("comment_published_at").cast("timestamp_ntz").alias("n"))
    inside = lambda c, kind: (F.col(c) >= low.cast(kind)) & (F.col(c) < high.cast(kind))
    found = rows.select(F.date_format("n", "yyyy-MM-dd").alias("day"), inside("z", "timestamp").alias("in_z"), inside("n", "timestamp_ntz").alias("in_n"))
    counts = found.groupBy("day").agg(F.count_if("in_z").alias("zoned"), F.count_if("in_n").alias("unzoned"))
    return counts.filter("zoned > 0 OR unzoned > 0")


def _as_lists(batches):
    """The documents of a partition as a JSON list, an element a line."""
    yield pa.RecordBatch.from_pydict({"value": ["[{}"]})
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"value": ["," + document for document in batch.column(0).to_pylist()]})
    yield pa.RecordBatch.from_pydict({"value": ["]"]})


@case("historical_dump_list", sql("SELECT thread_id, 'v' || conv_id AS video_id, n_replies AS replies FROM thr", "thr"))
def _dump_list(spark, d):
    """The dump as JSON lists, a file for each task that writes, written line by line and read element by element."""
    folder = scratch(spark, "dump")
    threads(spark, d).mapInArrow(_as_lists, "value string").write.text(folder)
    read = documents.read_threads(spark, folder).filter("thread_id is not null")
    return read.select("thread_id", "video_id", F.size("replies").cast("bigint").alias("replies"))


@case("document_connector", sql("SELECT comment_id, topic, 2 AS versions FROM eng WHERE collection_date = '2024-01-07'", "eng"))
def _connector(spark, d):
    """Documents written in two commits through the connector; one day read back, segments of other days skipped."""
    path = scratch(spark, "store")
    rows = engagement(spark, d).select("comment_id", "topic", "collection_date", "video_id", "comment_like_count")
    for _ in range(2):
        connector.write_documents(rows, path)
    day = connector.read_documents(spark, path, only="2024-01-07")
    return day.groupBy("comment_id", "topic").agg(F.count_distinct("_sequence").cast("int").alias("versions"))
