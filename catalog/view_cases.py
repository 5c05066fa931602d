"""Filters and the tables behind the pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RATIOS, case, comments, display_sql, engagement, errors, rounded, sql, summaries, view
from catalog.forecast_cases import daily, forecasts
from catalog.mart_cases import scored_table, words_sql
from catalog.run_cases import collection, performance
from voxlake.functions.text import DRIVER_STOP_WORDS
from voxlake.operators import descriptive, diagnostic, filters, marts, prescriptive, runs
from voxlake.plans import jobs
from voxlake.sinks.tables import write_contract
from voxlake.sources.tables import comment_level_source, load_marts, read_if_exists

FACETS = filters.Facets(("click", "view"), ("sports", "music"), (), "2024-01-05", "2024-01-20")
RUN_FACETS = filters.Facets(("BUILDING", "MACHINERY"), (), ("failed", "partial_success"), "1996-01-01", "1997-06-30")
_TEXT_ROWS = "comment_id, topic, genre, comment_like_count"

# ------------------------------------------------------------------ filters


@case(
    "facet_filter_runs",
    sql(
        """SELECT run_date, query_id, topic, genre, collection_status, expected_units FROM perf
  WHERE topic IN ('BUILDING', 'MACHINERY') AND collection_status IN ('failed', 'partial_success')
    AND run_date BETWEEN '1996-01-01' AND '1997-06-30'""",
        "perf",
    ),
)
def _facet_runs(spark, d):
    out = filters.filter_runs(performance(spark, d), RUN_FACETS)
    return out.select("run_date", "query_id", "topic", "genre", "collection_status", "expected_units")


view(
    "sel",
    """SELECT * FROM eng WHERE topic IN ('click', 'view') AND genre IN ('sports', 'music')
  AND comment_published_at >= TIMESTAMP '2024-01-05' AND comment_published_at < TIMESTAMP '2024-01-21'""",
    "eng",
)


def selection(spark, d):
    return filters.filter_comments(engagement(spark, d), FACETS)


@case("facet_filter_comments", sql(f"SELECT {_TEXT_ROWS} FROM sel", "sel"))
def _facet_comments(spark, d):
    return selection(spark, d).select("comment_id", "topic", "genre", "comment_like_count")


@case(
    "topic_or_genre_equals",
    sql(f"SELECT {_TEXT_ROWS} FROM eng WHERE lower(topic) = 'music' OR lower(genre) = 'music'", "eng"),
)
def _exact(spark, d):
    e = engagement(spark, d)
    return e.filter(filters.exact_mask(e, "music")).select("comment_id", "topic", "genre", "comment_like_count")


@case("query_text_contains", sql("SELECT comment_id, query_text FROM com WHERE contains(lower(query_text), 'out cl')", "com"))
def _contains(spark, d):
    c = comments(spark, d)
    return c.filter(filters.query_text_mask(c, "out cl")).select("comment_id", "query_text")


@case("alias_context_mask", sql(f"SELECT {_TEXT_ROWS} FROM eng WHERE topic = 'error' OR genre = 'sports'", "eng"))
def _alias(spark, d):
    e = engagement(spark, d)
    return e.filter(filters.alias_mask(e, "Error", "sports")).select("comment_id", "topic", "genre", "comment_like_count")


_SCOPES = {
    "exact": ("music", None, None, "lower(topic) = 'music' OR lower(genre) = 'music'"),
    "text": ("out purch", None, None, "contains(lower(query_text), 'out purch')"),
    "alias": ("nothing like it", "src3", "de", "topic = 'src3' OR genre = 'de'"),
    "none": ("nothing like it", None, None, "true"),
}


def _scope_query(name):
    query, topic, genre, _ = _SCOPES[name]

    def run(spark, d):
        c = comments(spark, d)
        if name == "exact":
            c = c.withColumn("genre", F.when(F.col("genre") == "en", "Music").otherwise(F.col("genre")))
        frames = filters.apply_filters(
            collection(spark, d), performance(spark, d).drop("query_text"), filters.Facets(), c, query, topic, genre
        )
        counts = [
            frames[part].agg(F.lit(part).alias("frame"), F.count(F.lit(1)).alias("rows")) for part in sorted(frames)
        ]
        return counts[0].union(counts[1]).union(counts[2])

    return run


for _name, (_, _topic, _genre, _where) in _SCOPES.items():
    _others = "count(*)" if _name == "none" else "count(*) FILTER (false)"
    case(
        f"query_scope_{_name}",
        sql(
            f"""SELECT 'comments' AS frame, count(*) AS rows FROM scoped WHERE {_where}
  UNION ALL SELECT 'collection', {_others} FROM cds UNION ALL SELECT 'queries', {_others} FROM perf""",
            view(
                f"scoped_{_name}",
                "SELECT * REPLACE (CASE genre WHEN 'en' THEN 'Music' ELSE genre END AS genre) FROM com"
                if _name == "exact"
                else "SELECT * FROM com",
                "com",
            ),
            "cds",
        ).replace("FROM scoped ", f"FROM scoped_{_name} "),
    )(_scope_query(_name))


@case(
    "mart_filter_follows_comments",
    sql(
        """SELECT collection_date, topic, genre, comments_count, positive_ratio FROM daily_summary
  WHERE collection_date BETWEEN '2024-01-05' AND '2024-01-20' AND topic IN ('click', 'view')
    AND genre IN ('sports', 'music') AND topic IN (SELECT topic FROM sel WHERE comment_like_count > 200)
    AND genre IN (SELECT genre FROM sel WHERE comment_like_count > 200)""",
        "daily_summary",
        "sel",
    ),
)
def _follow(spark, d):
    chosen = selection(spark, d).filter("comment_like_count > 200")
    out = filters.filter_mart(marts.daily_summary(engagement(spark, d)), FACETS, chosen)
    return out.select("collection_date", "topic", "genre", "comments_count", "positive_ratio")


@case(
    "video_mart_follows_comments",
    sql(
        """SELECT collection_date, topic, genre, video_id, comments_count FROM video_summary
  WHERE topic IN (SELECT topic FROM sel WHERE comment_like_count > 200)
    AND genre IN (SELECT genre FROM sel WHERE comment_like_count > 200)
    AND video_id IN (SELECT video_id FROM sel WHERE comment_like_count > 200)""",
        "video_summary",
        "sel",
    ),
)
def _follow_videos(spark, d):
    chosen = selection(spark, d).filter("comment_like_count > 200")
    out = filters.filter_mart(marts.video_summary(engagement(spark, d)), filters.Facets(), chosen)
    return out.select("collection_date", "topic", "genre", "video_id", "comments_count")


@case(
    "forecast_filter_follows_comments",
    sql(
        """SELECT topic, genre, horizon_day, forecast_comment_count FROM f7
  WHERE topic IN (SELECT topic FROM sel) AND genre IN (SELECT genre FROM sel)""",
        "f7",
        "sel",
        recursive=True,
    ),
)
def _follow_forecast(spark, d):
    _, ahead = filters.filter_forecasts(daily(spark, d), forecasts(spark, d), selection(spark, d))
    return ahead.select("topic", "genre", "horizon_day", "forecast_comment_count")


@case(
    "topic_value_pool",
    sql("SELECT topic FROM topic_summary UNION SELECT topic FROM com WHERE topic IS NOT NULL", "topic_summary", "com"),
)
def _pool(spark, d):
    return filters.value_pool([marts.topic_summary(engagement(spark, d)), comments(spark, d)], "topic")


@case(
    "date_span",
    sql("SELECT min(CAST(collection_date AS DATE)) AS min_date, max(CAST(collection_date AS DATE)) AS max_date FROM eng",
        "eng"),
)
def _span(spark, d):
    return filters.date_span(marts.daily_trend(engagement(spark, d)), "collection_date")


# -------------------------------------------------------------- descriptive

view(
    "rollup",
    """SELECT collection_date, CAST(sum(comments_count) AS DOUBLE) AS comments_count,
    CAST(sum(videos_covered) AS DOUBLE) AS videos_covered,
    sum(avg_sentiment_score * comments_count) / sum(comments_count) AS avg_sentiment_score,
    sum(positive_ratio * comments_count) / sum(comments_count) AS positive_ratio,
    sum(negative_ratio * comments_count) / sum(comments_count) AS negative_ratio
  FROM daily_trend GROUP BY collection_date""",
    "daily_trend",
)


@case(
    "daily_rollup",
    sql(
        """SELECT CAST(collection_date AS DATE) AS collection_date, comments_count, videos_covered,
    round(avg_sentiment_score, 6) AS avg_sentiment_score, round(positive_ratio, 6) AS positive_ratio,
    round(negative_ratio, 6) AS negative_ratio, collection_date AS collection_date_label FROM rollup""",
        "rollup",
    ),
)
def _rollup(spark, d):
    return rounded(descriptive.daily_rollup(marts.daily_trend(engagement(spark, d))))


@case(
    "daily_engagement",
    sql(
        """SELECT CAST(comment_published_at AS DATE) AS comment_date, count(*) AS matched_comments,
    CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes,
    round(avg(comment_like_count), 6) AS avg_likes_per_comment,
    strftime(CAST(comment_published_at AS DATE), '%Y-%m-%d') AS comment_date_label FROM eng GROUP BY 1, 5""",
        "eng",
    ),
)
def _engagement(spark, d):
    return rounded(descriptive.daily_engagement(engagement(spark, d)))


view(
    "teng",
    """SELECT topic, genre, count(*) AS matched_comments, CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes,
    avg(comment_like_count) AS avg_likes_per_comment, count(DISTINCT video_id) AS unique_videos
  FROM eng GROUP BY topic, genre""",
    "eng",
)
view("part_topics", "SELECT * FROM topic_summary WHERE genre <> 'music'", "topic_summary")
view("part_comments", "SELECT * FROM teng WHERE topic <> 'error'", "teng")
view(
    "tview",
    f"""SELECT topic, genre, coalesce(comments_count, 0) AS comments_count,
    CASE WHEN coalesce(c.matched_comments, 0) > 0 THEN c.matched_comments ELSE coalesce(comments_count, 0) END
      AS matched_comments, coalesce(avg_sentiment_score, 0) AS avg_sentiment_score,
    coalesce(positive_ratio, 0) AS positive_ratio, coalesce(negative_ratio, 0) AS negative_ratio,
    coalesce(c.total_comment_likes, 0) AS total_comment_likes, coalesce(avg_comment_likes, 0) AS avg_likes_per_comment,
    coalesce(unique_videos, 0) AS unique_videos, {display_sql('topic')} AS topic_display,
    {display_sql('genre')} AS genre_display
  FROM part_topics FULL JOIN part_comments c USING (topic, genre)""",
    "part_topics",
    "part_comments",
)


@case(
    "topic_engagement",
    sql("SELECT * REPLACE (round(avg_likes_per_comment, 6) AS avg_likes_per_comment) FROM teng", "teng"),
)
def _topic_engagement(spark, d):
    return rounded(descriptive.topic_engagement(engagement(spark, d)))


def topic_view(spark, d):
    events = engagement(spark, d)
    topics = marts.topic_summary(events).filter("genre <> 'music'")
    return descriptive.topic_engagement_view(topics, events.filter("topic <> 'error'"))


@case("topic_engagement_full_join", sql("SELECT * FROM tview", "tview"))
def _topic_view(spark, d):
    return rounded(topic_view(spark, d))


view(
    "vcom",
    """SELECT video_id, video_title, channel_title, topic, genre, count(*) AS matched_comments,
    CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes, avg(comment_like_count) AS avg_likes_per_comment
  FROM com WHERE video_id IS NOT NULL GROUP BY ALL""",
    "com",
)
view(
    "vmart",
    f"""SELECT collection_date, topic, genre, video_id, video_title, channel_title,
    count(DISTINCT comment_id) AS comments_count, round(avg(sentiment_score), 4) AS avg_sentiment_score, {RATIOS}
  FROM com WHERE video_id IS NOT NULL GROUP BY ALL""",
    "com",
)
view(
    "vview",
    f"""SELECT m.collection_date, coalesce(m.topic, c.topic) AS topic, coalesce(m.genre, c.genre) AS genre, m.video_id,
    m.video_title, coalesce(m.channel_title, c.channel_title) AS channel_title, m.comments_count,
    m.avg_sentiment_score, coalesce(c.matched_comments, m.comments_count) AS matched_comments,
    coalesce(c.total_comment_likes, 0) AS total_comment_likes,
    round(coalesce(c.avg_likes_per_comment, 0), 6) AS avg_likes_per_comment,
    CASE WHEN length(m.video_title) > 38 THEN rtrim(substr(m.video_title, 1, 38)) || '...' ELSE m.video_title END
      AS video_title_short, {display_sql('m.topic')} AS topic_display, {display_sql('m.genre')} AS genre_display
  FROM vmart m LEFT JOIN vcom c ON m.video_id = c.video_id""",
    "vmart",
    "vcom",
)
_VCOLS = (
    "collection_date topic genre video_id video_title channel_title comments_count avg_sentiment_score "
    "matched_comments total_comment_likes avg_likes_per_comment video_title_short topic_display genre_display"
).split()


def evidence(spark, d):
    rows = comments(spark, d)
    mart = marts.video_summary(rows).drop("total_comment_likes", "avg_comment_likes")
    return descriptive.video_evidence(rows, mart).select(*_VCOLS)


@case(
    "video_engagement",
    sql("SELECT * REPLACE (round(avg_likes_per_comment, 6) AS avg_likes_per_comment) FROM vcom", "vcom"),
)
def _video_engagement(spark, d):
    return rounded(descriptive.video_engagement(comments(spark, d)))


@case("video_evidence_left_join", sql("SELECT * FROM vview", "vview"))
def _evidence(spark, d):
    return rounded(evidence(spark, d))


@case(
    "video_evidence_per_video",
    sql(
        """SELECT m.collection_date, m.topic, m.genre, m.video_id, m.comments_count, c.matched_comments, c.total_comment_likes,
    round(c.total_comment_likes / c.matched_comments, 6) AS avg_likes_per_comment
  FROM vmart m JOIN (SELECT video_id, count(*) AS matched_comments, CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes
    FROM com WHERE video_id IS NOT NULL GROUP BY video_id) c ON m.video_id = c.video_id""",
        "vmart",
        "com",
    ),
)
def _evidence_per_video(spark, d):
    """As many rows as the mart has, however many groups the comments of a video fall into."""
    rows = comments(spark, d)
    mart = marts.video_summary(rows).drop("total_comment_likes", "avg_comment_likes")
    out = descriptive.video_evidence(rows, mart, per_video=True)
    names = "collection_date topic genre video_id comments_count matched_comments total_comment_likes avg_likes_per_comment"
    return rounded(out.select(*names.split()))


_EVIDENCE_TIES = "total_comment_likes DESC, matched_comments DESC, video_id, collection_date, topic, genre"
for _positive, _order in ((True, "DESC"), (False, "ASC")):
    case(
        f"engaging_{'positive' if _positive else 'risk'}_videos",
        sql(
            f"""SELECT video_id, collection_date, avg_sentiment_score, total_comment_likes, matched_comments FROM vview
  ORDER BY avg_sentiment_score {_order}, {_EVIDENCE_TIES} LIMIT 10""",
            "vview",
        ),
    )(
        lambda spark, d, positive=_positive: descriptive.engaging_videos(evidence(spark, d), positive).select(
            "video_id", "collection_date", "avg_sentiment_score", "total_comment_likes", "matched_comments"
        )
    )
    _sign = ">" if _positive else "<"
    case(
        f"representative_{'positive' if _positive else 'negative'}_comments",
        sql(
            f"""SELECT comment_id, {display_sql('topic')} AS topic_display, {display_sql('genre')} AS genre_display,
    sentiment_score, comment_like_count AS likes, substr(comment_text, 1, 220) AS comment_excerpt,
    CASE WHEN length(video_title) > 55 THEN rtrim(substr(video_title, 1, 55)) || '...' ELSE video_title END
      AS video_title_short
  FROM com WHERE sentiment_score {_sign} 0
  ORDER BY comment_like_count DESC, sentiment_score {_order}, comment_id LIMIT 4""",
            "com",
        ),
    )(lambda spark, d, positive=_positive: descriptive.representative_comments(comments(spark, d), positive))
    case(
        f"{'positive' if _positive else 'negative'}_words",
        sql(
            f"""SELECT keyword, collection_date, topic, genre, keyword_count, avg_sentiment_score FROM keywords
  WHERE avg_sentiment_score {_sign} 0
  ORDER BY keyword_count DESC, avg_sentiment_score {_order}, keyword, collection_date, topic, genre LIMIT 12""",
            "keywords",
        ),
    )(
        lambda spark, d, positive=_positive: descriptive.driver_words(
            marts.keyword_frequency(comments(spark, d)), positive
        ).select("keyword", "collection_date", "topic", "genre", "keyword_count", "avg_sentiment_score")
    )
    case(
        f"mart_{'positive' if _positive else 'negative'}_drivers",
        sql(
            f"""SELECT topic, genre, keyword, CAST(sum(keyword_count) AS DOUBLE) AS keyword_count,
    CAST(sum(distinct_comments) AS DOUBLE) AS distinct_comments,
    round(sum(avg_sentiment_score * distinct_comments) / sum(distinct_comments), 6) AS avg_sentiment_score,
    {display_sql('topic')} AS topic_display, {display_sql('genre')} AS genre_display
  FROM keywords WHERE avg_sentiment_score {_sign} 0 GROUP BY topic, genre, keyword
  ORDER BY sum(keyword_count) DESC, sum(distinct_comments) DESC, keyword, topic, genre LIMIT 15""",
            "keywords",
        ),
    )(
        lambda spark, d, positive=_positive: rounded(
            diagnostic.mart_drivers(marts.keyword_frequency(comments(spark, d)), positive)
        )
    )
    case(
        f"comment_{'positive' if _positive else 'negative'}_drivers",
        sql(
            f"""SELECT min_by(topic, comment_id) AS topic, min_by(genre, comment_id) AS genre, keyword,
    count(*) AS keyword_count, count(DISTINCT comment_id) AS distinct_comments,
    round(avg(sentiment_score), 4) AS avg_sentiment_score,
    {display_sql('min_by(topic, comment_id)')} AS topic_display,
    {display_sql('min_by(genre, comment_id)')} AS genre_display
  FROM dwords_{'p' if _positive else 'n'} GROUP BY keyword ORDER BY count(*) DESC, keyword LIMIT 15""",
            view(f"dwords_{'p' if _positive else 'n'}", words_sql(DRIVER_STOP_WORDS, f"sentiment_score {_sign} 0"), "com"),
        ),
    )(lambda spark, d, positive=_positive: diagnostic.comment_drivers(comments(spark, d), positive))
    case(
        f"{'positive' if _positive else 'negative'}_words_per_topic",
        sql(
            f"""SELECT topic, keyword, CAST(row_number() OVER (PARTITION BY topic ORDER BY keyword_count DESC,
      avg_sentiment_score {_order}, keyword, collection_date, genre) AS INTEGER) AS word_rank, keyword_count,
    avg_sentiment_score FROM keywords WHERE avg_sentiment_score {_sign} 0
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY keyword_count DESC,
      avg_sentiment_score {_order}, keyword, collection_date, genre) <= 3""",
            "keywords",
        ),
    )(
        lambda spark, d, positive=_positive: prescriptive.topic_words(
            marts.keyword_frequency(comments(spark, d)), positive
        )
    )


@case(
    "driver_words_with_fallback",
    sql(
        f"""SELECT keyword, count(*) AS keyword_count, count(DISTINCT comment_id) AS distinct_comments
  FROM dwords_p GROUP BY keyword ORDER BY count(*) DESC, keyword LIMIT 15""",
        "dwords_p",
    ),
)
def _fallback(spark, d):
    rows = comments(spark, d)
    none = marts.keyword_frequency(rows).filter("avg_sentiment_score < 0")
    return diagnostic.drivers(none, rows, True).select("keyword", "keyword_count", "distinct_comments")


_HOURS = ", ".join(f"count(*) FILTER (hour(comment_published_at) = {h}) AS hour_{h:02d}" for h in range(24))


@case(
    "weekday_hour_pivot",
    sql(f"SELECT strftime(comment_published_at, '%A') AS weekday_name, {_HOURS} FROM eng GROUP BY 1", "eng"),
)
def _heatmap(spark, d):
    return descriptive.hour_heatmap(engagement(spark, d))


@case(
    "descriptive_kpis",
    sql(
        """SELECT matched_comments, unique_videos, round(score, 6) AS avg_sentiment, round(pos, 6) AS positive_share,
    total_comment_likes, round(total_comment_likes / matched_comments, 6) AS avg_likes_per_comment
  FROM (SELECT count(*) AS matched_comments, count(DISTINCT video_id) AS unique_videos,
          CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes FROM eng),
    (SELECT sum(avg_sentiment_score * matched_comments) / sum(matched_comments) AS score,
       sum(positive_ratio * matched_comments) / sum(matched_comments) AS pos FROM tview)""",
        "eng",
        "tview",
    ),
)
def _kpis(spark, d):
    return rounded(descriptive.descriptive_kpis(engagement(spark, d), topic_view(spark, d)))


_HEADER = """SELECT count(DISTINCT comment_id) AS total_comments, round(avg(sentiment_score), 6) AS avg_sentiment,
    round(avg(CASE sentiment_label WHEN 'positive' THEN 1 ELSE 0 END), 6) AS positive_ratio,
    round(avg(CASE sentiment_label WHEN 'negative' THEN 1 ELSE 0 END), 6) AS negative_ratio,
    count(DISTINCT topic) AS topics_covered, count(DISTINCT genre) AS genres_covered,
    count(DISTINCT video_id) AS videos_covered FROM eng"""


@case("header_kpis", sql(_HEADER, "eng"))
def _header(spark, d):
    events = engagement(spark, d)
    return rounded(descriptive.header_kpis(events, marts.topic_summary(events)))


@case(
    "header_kpis_from_mart",
    sql(
        """SELECT CAST(sum(comments_count) AS BIGINT) AS total_comments, round(avg(avg_sentiment_score), 6) AS avg_sentiment,
    round(avg(positive_ratio), 6) AS positive_ratio, round(avg(negative_ratio), 6) AS negative_ratio,
    count(DISTINCT topic) AS topics_covered, count(DISTINCT genre) AS genres_covered,
    CAST(sum(videos_covered) AS BIGINT) AS videos_covered FROM topic_summary""",
        "topic_summary",
    ),
)
def _header_mart(spark, d):
    events = engagement(spark, d)
    nothing = filters.filter_comments(events, filters.Facets(topics=("no such topic",)))
    return rounded(descriptive.header_kpis(nothing, marts.topic_summary(events)))


@case(
    "genre_volume_and_mood",
    sql(
        f"""SELECT genre, CAST(sum(comments_count) AS BIGINT) AS comments_count,
    round(avg(avg_sentiment_score), 6) AS avg_sentiment_score, {display_sql('genre')} AS genre_display
  FROM topic_summary GROUP BY genre""",
        "topic_summary",
    ),
)
def _genres(spark, d):
    return rounded(descriptive.genre_overview(marts.topic_summary(engagement(spark, d))))


# --------------------------------------------------------------- diagnostic

_RISK = """count(DISTINCT comment_id) AS comments_count, avg(sentiment_score) AS avg_sentiment_score,
    count(*) FILTER (sentiment_label = 'negative') AS negative_comments,
    count(*) FILTER (sentiment_label = 'positive') AS positive_comments,
    count(*) FILTER (sentiment_label = 'negative') / greatest(count(DISTINCT comment_id), 1) AS negative_ratio,
    count(*) FILTER (sentiment_label = 'positive') / greatest(count(DISTINCT comment_id), 1) AS positive_ratio"""
_RISK_LIKES = "CAST(sum(comment_like_count) AS DOUBLE) AS total_comment_likes, avg(comment_like_count) AS avg_comment_likes"
_SHOWN = f"{display_sql('topic')} AS topic_display, {display_sql('genre')} AS genre_display"
view(
    "trisk",
    f"""SELECT *, comments_count * negative_ratio AS risk_load, {_SHOWN} FROM (
    SELECT topic, genre, {_RISK}, {_RISK_LIKES}, count(DISTINCT video_id) AS videos_covered,
      count(*) FILTER (sentiment_label = 'neutral') AS neutral_comments FROM eng GROUP BY topic, genre)""",
    "eng",
)
view(
    "vrisk",
    f"""SELECT *, CASE WHEN length(video_title) > 58 THEN substr(video_title, 1, 55) || '...' ELSE video_title END
      AS video_display, {_SHOWN} FROM (
    SELECT video_id, video_title, channel_title, topic, genre, {_RISK}, {_RISK_LIKES} FROM eng GROUP BY ALL)""",
    "eng",
)
view(
    "dtopics",
    f"""SELECT *, {_SHOWN} FROM (
    SELECT CAST(collection_date AS DATE) AS collection_date, topic, genre, {_RISK} FROM eng GROUP BY 1, 2, 3)""",
    "eng",
)
_ROUND_RISK = (
    "round(avg_sentiment_score, 6) AS avg_sentiment_score, round(negative_ratio, 6) AS negative_ratio, "
    "round(positive_ratio, 6) AS positive_ratio"
)
_ROUND_LIKES = "round(avg_comment_likes, 6) AS avg_comment_likes"


@case(
    "topic_risk_summary",
    sql(f"SELECT * REPLACE ({_ROUND_RISK}, {_ROUND_LIKES}, round(risk_load, 6) AS risk_load) FROM trisk", "trisk"),
)
def _topic_risk(spark, d):
    return rounded(diagnostic.topic_risk(engagement(spark, d)))


@case("video_risk_summary", sql(f"SELECT * REPLACE ({_ROUND_RISK}, {_ROUND_LIKES}) FROM vrisk", "vrisk"))
def _video_risk(spark, d):
    return rounded(diagnostic.video_risk(engagement(spark, d)))


@case("daily_topic_breakdown", sql(f"SELECT * REPLACE ({_ROUND_RISK}) FROM dtopics", "dtopics"))
def _daily_topics(spark, d):
    return rounded(diagnostic.daily_topics(engagement(spark, d)))


@case(
    "at_risk_and_strongest_topic",
    sql(
        """SELECT r.topic AS at_risk_topic, r.genre AS at_risk_genre, round(r.negative_ratio, 6) AS at_risk_negative_ratio,
    s.topic AS strongest_topic, s.genre AS strongest_genre, round(s.avg_sentiment_score, 6) AS strongest_score
  FROM (SELECT * FROM trisk ORDER BY negative_ratio DESC, comments_count DESC, topic DESC, genre DESC LIMIT 1) r,
    (SELECT * FROM trisk ORDER BY avg_sentiment_score DESC, comments_count DESC, topic DESC, genre DESC LIMIT 1) s""",
        "trisk",
    ),
)
def _extremes(spark, d):
    return rounded(diagnostic.topic_extremes(diagnostic.topic_risk(engagement(spark, d))))


@case(
    "top_negative_load",
    sql(
        """SELECT topic, genre, negative_comments, comments_count FROM trisk
  ORDER BY negative_comments DESC, comments_count DESC, topic, genre LIMIT 10""",
        "trisk",
    ),
)
def _load(spark, d):
    out = diagnostic.negative_load(diagnostic.topic_risk(engagement(spark, d)))
    return out.select("topic", "genre", "negative_comments", "comments_count")


for _weak in (True, False):
    case(
        f"{'weak' if _weak else 'strong'}_videos",
        sql(
            f"""SELECT video_id, topic, genre, round(avg_sentiment_score, 6) AS avg_sentiment_score, comments_count
  FROM vrisk ORDER BY vrisk.avg_sentiment_score {'ASC' if _weak else 'DESC'}, comments_count DESC,
    total_comment_likes DESC, video_id, topic, genre LIMIT 10""",
            "vrisk",
        ),
    )(
        lambda spark, d, weak=_weak: rounded(
            diagnostic.ranked_videos(diagnostic.video_risk(engagement(spark, d)), weak).select(
                "video_id", "topic", "genre", "avg_sentiment_score", "comments_count"
            )
        )
    )

view(
    "change",
    """SELECT collection_date, s AS avg_sentiment_score, s - lag(s) OVER (ORDER BY collection_date) AS delta
  FROM (SELECT CAST(collection_date AS DATE) AS collection_date, avg(avg_sentiment_score) AS s
        FROM daily_trend GROUP BY 1)""",
    "daily_trend",
)
view("worst", "SELECT * FROM change WHERE delta IS NOT NULL ORDER BY delta, collection_date LIMIT 1", "change")


@case(
    "day_over_day_change",
    sql(
        """SELECT collection_date, round(avg_sentiment_score, 6) AS avg_sentiment_score,
    round(coalesce(delta, 0), 6) AS delta FROM change""",
        "change",
    ),
)
def _change(spark, d):
    out = diagnostic.daily_change(marts.daily_trend(engagement(spark, d)))
    return rounded(out.fillna(0.0, ["delta"]))


@case(
    "sharpest_drop",
    sql(
        "SELECT collection_date, round(avg_sentiment_score, 6) AS avg_sentiment_score, round(delta, 6) AS delta FROM worst",
        "worst",
    ),
)
def _drop(spark, d):
    return rounded(diagnostic.sharpest_drop(marts.daily_trend(engagement(spark, d))))


@case(
    "sharpest_drop_drivers",
    sql(
        """SELECT topic, genre, negative_comments, comments_count FROM dtopics
  WHERE collection_date IN (SELECT collection_date FROM worst)
  ORDER BY negative_comments DESC, comments_count DESC, topic, genre LIMIT 10""",
        "dtopics",
        "worst",
    ),
)
def _drop_drivers(spark, d):
    events = engagement(spark, d)
    drop = diagnostic.sharpest_drop(marts.daily_trend(events))
    out = diagnostic.drop_drivers(diagnostic.daily_topics(events), drop)
    return out.select("topic", "genre", "negative_comments", "comments_count")


view(
    "endorse",
    """SELECT label AS sentiment_bucket, CAST(o AS INTEGER) AS sentiment_bucket_order, count(score) AS comments_count,
    CAST(coalesce(sum(likes), 0) AS BIGINT) AS total_comment_likes, avg(likes) AS avg_likes_per_comment,
    avg(score) AS avg_sentiment_score
  FROM (VALUES (0, 'Very Negative'), (1, 'Negative'), (2, 'Neutral'), (3, 'Positive'), (4, 'Very Positive')) b(o, label)
  LEFT JOIN (SELECT sentiment_score AS score, comment_like_count AS likes,
      CASE WHEN sentiment_score <= -0.35 THEN 0 WHEN sentiment_score <= -0.05 THEN 1 WHEN sentiment_score <= 0.05 THEN 2
        WHEN sentiment_score <= 0.35 THEN 3 ELSE 4 END AS bucket FROM eng) ON bucket = o
  GROUP BY label, o""",
    "eng",
)
_ENDORSE = """SELECT * REPLACE (round(avg_likes_per_comment, 6) AS avg_likes_per_comment,
    round(avg_sentiment_score, 6) AS avg_sentiment_score) FROM endorse"""


@case("endorsement_by_score_bucket", sql(_ENDORSE, "endorse"))
def _endorse(spark, d):
    return rounded(diagnostic.endorsement(engagement(spark, d)))


@case(
    "most_endorsed_bucket",
    sql(f"{_ENDORSE} ORDER BY endorse.avg_likes_per_comment DESC, total_comment_likes DESC LIMIT 1", "endorse"),
)
def _most_endorsed(spark, d):
    return rounded(diagnostic.most_endorsed(diagnostic.endorsement(engagement(spark, d))))


@case(
    "like_distribution_by_label",
    sql("SELECT sentiment_label, comment_like_count AS resolved_like_count FROM eng", "eng"),
)
def _likes(spark, d):
    odd = F.concat(F.lit(" "), F.upper("sentiment_label"), F.lit(" "))
    return diagnostic.like_distribution(engagement(spark, d).withColumn("sentiment_label", odd))


@case(
    "like_box_statistics",
    sql(
        """SELECT sentiment_label, comments_count, min_likes, round(q1, 6) AS q1_likes, round(q2, 6) AS median_likes,
    round(q3, 6) AS q3_likes, max_likes,
    (SELECT count(*) FROM eng e WHERE e.sentiment_label = s.sentiment_label
      AND (comment_like_count < q1 - 1.5 * (q3 - q1) OR comment_like_count > q3 + 1.5 * (q3 - q1))) AS outliers
  FROM (SELECT sentiment_label, count(*) AS comments_count, min(comment_like_count) AS min_likes,
      quantile_cont(comment_like_count, 0.25) AS q1, quantile_cont(comment_like_count, 0.5) AS q2,
      quantile_cont(comment_like_count, 0.75) AS q3, max(comment_like_count) AS max_likes
    FROM eng GROUP BY sentiment_label) s""",
        "eng",
    ),
)
def _box(spark, d):
    return rounded(diagnostic.like_box(diagnostic.like_distribution(engagement(spark, d))))


# ------------------------------------------------------------- prescriptive

view(
    "prio",
    """SELECT *, 0.45 * negative_ratio + 0.25 * sentiment_risk + 0.20 * volume_share + 0.10 * (1 - positive_ratio)
      AS monitoring_priority,
    0.40 * positive_ratio + 0.25 * sentiment_strength + 0.20 * volume_share + 0.15 * video_share AS growth_priority
  FROM (SELECT topic, genre, comments_count, videos_covered, avg_sentiment_score, positive_ratio, negative_ratio,
      comments_count / greatest(sum(comments_count) OVER (), 1) AS volume_share,
      videos_covered / greatest(sum(videos_covered) OVER (), 1) AS video_share,
      (1 - least(greatest(avg_sentiment_score, -1), 1)) / 2 AS sentiment_risk,
      (least(greatest(avg_sentiment_score, -1), 1) + 1) / 2 AS sentiment_strength FROM topic_summary)""",
    "topic_summary",
)
_PRIO_COLUMNS = "topic, genre, comments_count, videos_covered"
_PRIO = (
    f"SELECT {_PRIO_COLUMNS}, round(volume_share, 6) AS volume_share, round(video_share, 6) AS video_share, "
    "round(sentiment_risk, 6) AS sentiment_risk, round(sentiment_strength, 6) AS sentiment_strength, "
    "round(monitoring_priority, 6) AS monitoring_priority, round(growth_priority, 6) AS growth_priority FROM prio"
)


def priorities(spark, d):
    return prescriptive.priorities(marts.topic_summary(engagement(spark, d)))


@case("topic_priorities", sql(_PRIO, "prio"))
def _priorities(spark, d):
    names = "volume_share video_share sentiment_risk sentiment_strength monitoring_priority growth_priority".split()
    out = priorities(spark, d).select("topic", "genre", "comments_count", "videos_covered", *names)
    return rounded(out)


for _title, _by, _limit in (
    ("top_risk_topics", "monitoring_priority", 3),
    ("top_growth_topics", "growth_priority", 3),
    ("top_monitoring_priorities", "monitoring_priority", 10),
):
    case(
        _title,
        sql(
            f"""SELECT topic, genre, round({_by}, 6) AS priority, {_SHOWN} FROM prio
  ORDER BY {_by} DESC, comments_count DESC, topic, genre LIMIT {_limit}""",
            "prio",
        ),
    )(
        lambda spark, d, by=_by, limit=_limit: rounded(
            prescriptive.ranked(priorities(spark, d), by, limit).select(
                "topic", "genre", F.col(by).alias("priority"), "topic_display", "genre_display"
            )
        )
    )

_WIN = {
    "highest_negative_share": "negative_ratio DESC, comments_count DESC",
    "largest_volume": "comments_count DESC, videos_covered DESC",
    "strongest_positive": "positive_ratio DESC, comments_count DESC",
    "widest_coverage": "videos_covered DESC, comments_count DESC",
}


@case(
    "four_winners",
    sql(
        " UNION ALL ".join(
            f"(SELECT '{reason}' AS reason, topic, genre, comments_count, videos_covered, positive_ratio, negative_ratio "
            f"FROM prio ORDER BY {order}, topic DESC, genre DESC LIMIT 1)"
            for reason, order in _WIN.items()
        ),
        "prio",
    ),
)
def _winners(spark, d):
    return prescriptive.winners(priorities(spark, d))


# ------------------------------------------------------------------ sources


@case(
    "tiered_comment_source",
    sql("SELECT comment_id, topic, comment_like_count FROM eng", "eng"),
)
def _tiers(spark, d):
    root = scored_table(spark, d)
    return comment_level_source(spark, root).select("comment_id", "topic", "comment_like_count")


@case(
    "absent_table_reads_empty",
    sql("SELECT topic, count(*) AS rows FROM eng GROUP BY topic UNION ALL SELECT 'absent', 0", "eng"),
)
def _absent(spark, d):
    root = scored_table(spark, d)
    found = read_if_exists(spark, f"{root}/silver/youtube_comments_sentiment")
    missing = read_if_exists(spark, f"{root}/silver/no_such_table")
    counts = found.groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))
    gone = found.limit(1).select(F.lit("absent" if missing is None else "present").alias("topic"))
    return counts.union(gone.withColumn("rows", F.lit(0).cast("bigint")))


# Label column and SQL view of each mart of the bundle; without a label its rows are counted.
_BUNDLED = {
    "overview": ("run_date_label", "run_date", "overview"),
    "collection": ("run_date_label", "run_date", "cds"),
    "query": ("run_date_label", "run_date", "perf"),
    "sentiment_daily_summary": ("collection_date_label", "collection_date", "daily_summary"),
    "sentiment_video_summary": ("collection_date_label", "collection_date", "video_summary"),
    "sentiment_topic_summary": ("genre", "genre", "topic_summary"),
    "sentiment_daily_trend": ("collection_date_label", "collection_date", "daily_trend"),
    "sentiment_weekday_hour_engagement": ("collection_date_label", "collection_date", "weekday_hour"),
    "sentiment_overview_kpis": ("collection_date_label", "collection_date", "overview_kpis"),
    "comments": ("weekday_name", "strftime(comment_published_at, '%A')", "eng"),
    "sentiment_comments": ("weekday_name", "strftime(comment_published_at, '%A')", "eng"),
}


@case(
    "mart_bundle",
    sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS mart, {label} AS label, count(*) AS rows FROM {v} GROUP BY 2"
            for name, (_, label, v) in _BUNDLED.items()
        ),
        *dict.fromkeys(v for _, _, v in _BUNDLED.values()),
    ),
)
def _bundle(spark, d):
    root = scored_table(spark, d)
    jobs.sentiment_gold(spark, root)
    jobs.descriptive_gold(spark, root)
    jobs.collection_metrics(spark, root, summaries(spark, d), errors(spark, d))
    bundle = load_marts(spark, root)
    out = None
    for name, (label, _, _) in _BUNDLED.items():
        part = bundle[name].groupBy(F.lit(name).alias("mart"), F.col(label).alias("label")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        out = part if out is None else out.union(part)
    return out


