"""Gold marts."""

from __future__ import annotations

from catalog.base import METRICS, RATIOS, case, comments, engagement, scratch, sql, view
from voxlake.functions.text import MART_STOP_WORDS
from voxlake.operators import marts
from voxlake.plans import jobs
from voxlake.sinks.tables import write_contract
from voxlake.sources.tables import read_contract

_DAY = "collection_date, topic, genre"
_VIDEOS = "count(DISTINCT video_id) AS videos_covered"
view("daily_summary", f"SELECT {_DAY}, {METRICS}, {RATIOS} FROM eng GROUP BY ALL", "eng")
view(
    "video_summary",
    f"SELECT {_DAY}, video_id, video_title, channel_title, {METRICS}, {RATIOS} FROM eng GROUP BY ALL",
    "eng",
)
view(
    "topic_summary",
    f"SELECT topic, genre, count(DISTINCT collection_date) AS collection_dates_seen, {_VIDEOS}, {METRICS}, {RATIOS} "
    "FROM eng GROUP BY ALL",
    "eng",
)
view("daily_trend", f"SELECT {_DAY}, {_VIDEOS}, {METRICS}, {RATIOS} FROM eng GROUP BY ALL", "eng")
view(
    "weekday_hour",
    f"SELECT {_DAY}, strftime(comment_published_at, '%A') AS weekday_name, "
    f"CAST(hour(comment_published_at) AS BIGINT) AS comment_hour_24, {_VIDEOS}, {METRICS} FROM eng GROUP BY ALL",
    "eng",
)
view(
    "overview_kpis",
    "SELECT collection_date, platform, count(DISTINCT topic) AS topics_covered, count(DISTINCT genre) AS "
    f"genres_covered, {_VIDEOS}, {METRICS}, {RATIOS} FROM eng GROUP BY ALL",
    "eng",
)


def words_sql(stop_words: list[str], where: str = "true", columns: str = "collection_date, topic, genre") -> str:
    stops = ", ".join("'" + word.replace("'", "''") + "'" for word in stop_words)
    return f"""
  SELECT * FROM (
    SELECT {columns}, comment_id, sentiment_score,
      unnest(list_distinct(regexp_extract_all(lower(comment_text), '[a-z0-9]{{3,}}'))) AS keyword
    FROM com WHERE {where})
  WHERE NOT regexp_matches(keyword, '^[0-9]+$') AND keyword NOT IN ({stops})"""


view("words", words_sql(MART_STOP_WORDS), "com")
view(
    "keywords",
    """SELECT collection_date, topic, genre, keyword, count(*) AS keyword_count,
    count(DISTINCT comment_id) AS distinct_comments, round(avg(sentiment_score), 4) AS avg_sentiment_score
  FROM words GROUP BY collection_date, topic, genre, keyword
  QUALIFY row_number() OVER (PARTITION BY collection_date, topic, genre ORDER BY count(*) DESC, keyword) <= 25""",
    "words",
)
view(
    "dtm",
    """SELECT CAST(collection_date AS DATE) AS metric_date, topic, genre,
    count(DISTINCT comment_id) AS comment_count, count(DISTINCT video_id) AS distinct_videos,
    round(avg(sentiment_score), 4) AS avg_sentiment_score,
    count(*) FILTER (sentiment_label = 'positive') AS positive_comments,
    count(*) FILTER (sentiment_label = 'neutral') AS neutral_comments,
    count(*) FILTER (sentiment_label = 'negative') AS negative_comments,
    round(avg(sentiment_confidence), 4) AS avg_sentiment_confidence,
    round(avg(negative_probability), 4) AS avg_negative_probability,
    round(avg(neutral_probability), 4) AS avg_neutral_probability,
    round(avg(positive_probability), 4) AS avg_positive_probability,
    CAST(sum(comment_like_count) AS BIGINT) AS total_like_count,
    CAST(sum(reply_count) AS BIGINT) AS total_reply_count, round(avg(comment_like_count), 4) AS avg_like_count
  FROM eng GROUP BY ALL""",
    "eng",
)

_BUILDERS = {
    "daily_summary": marts.daily_summary,
    "video_summary": marts.video_summary,
    "topic_summary": marts.topic_summary,
    "daily_trend": marts.daily_trend,
    "weekday_hour": marts.weekday_hour,
    "overview_kpis": marts.overview_kpis,
}
for _name, _build in _BUILDERS.items():
    case(f"sentiment_{_name}", sql(f"SELECT * FROM {_name}", _name))(
        lambda spark, d, build=_build: build(engagement(spark, d))
    )


@case(
    "mart_presentation_order",
    sql("SELECT * FROM weekday_hour ORDER BY collection_date, topic, genre, "
        "list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'], weekday_name), "
        "comment_hour_24", "weekday_hour"),
)
def _ordered(spark, d):
    return marts.in_order(marts.weekday_hour(engagement(spark, d)), "weekday_hour")


@case(
    "mart_presentation_order_all",
    sql("SELECT * FROM weekday_hour ORDER BY collection_date, topic, genre, "
        "list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'], weekday_name), "
        "comment_hour_24", "weekday_hour"),
)
def _ordered_all(spark, d):
    return marts.in_order(marts.weekday_hour(engagement(spark, d)), "weekday_hour")


@case("keyword_frequency_top25", sql("SELECT * FROM keywords", "keywords"))
def _keywords(spark, d):
    return marts.keyword_frequency(comments(spark, d))


@case("daily_topic_metrics", sql("SELECT * FROM dtm", "dtm"))
def _metrics(spark, d):
    return marts.daily_topic_metrics(engagement(spark, d))


@case(
    "mart_input_preparation",
    sql(
        """SELECT comment_id, topic, comment_like_count,
    reply_count, CAST(0 AS BIGINT) AS positive_hits, sentiment_score, CAST(0 AS DOUBLE) AS sentiment_confidence,
    CAST(hour(comment_published_at) AS BIGINT) AS comment_hour_24,
    strftime(comment_published_at, '%A') AS weekday_name FROM com""",
        "com",
    ),
)
def _prepared(spark, d):
    names = "comment_id topic comment_like_count reply_count positive_hits sentiment_score sentiment_confidence"
    return marts.prepare_scored(comments(spark, d)).select(*names.split(), "comment_hour_24", "weekday_name")


def scored_table(spark, d) -> str:
    """A lakehouse root whose scored table holds the engagement rows."""
    root = scratch(spark, "lakehouse")
    write_contract(engagement(spark, d), jobs.SCORED, root, "overwrite", refuse_empty=False)
    return root


@case("sentiment_gold_job", sql("SELECT * FROM video_summary", "video_summary"))
def _sentiment_job(spark, d):
    root = scored_table(spark, d)
    jobs.sentiment_gold(spark, root, at="2024-01-01T00:00:00")
    return read_contract(spark, root, "gold.youtube_sentiment_video_summary").drop("built_at")


@case("descriptive_gold_job", sql("SELECT * FROM overview_kpis", "overview_kpis"))
def _descriptive_job(spark, d):
    root = scored_table(spark, d)
    jobs.descriptive_gold(spark, root, at="2024-01-01T00:00:00")
    return read_contract(spark, root, "gold.youtube_sentiment_overview_kpis").drop("built_at")


@case("predictive_gold_job", sql("SELECT * FROM dtm", "dtm"))
def _predictive_job(spark, d):
    root = scored_table(spark, d)
    jobs.predictive_gold(spark, root)
    return read_contract(spark, root, "gold.youtube_comments_daily_topic_metrics").drop("built_at")
