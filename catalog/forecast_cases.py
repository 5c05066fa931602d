"""Forecast eligibility, forecasts, bands, genre outlook."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import case, display_sql, engagement, rounded, sql, view
from catalog.mart_cases import scored_table
from voxlake.operators import forecast, marts
from voxlake.plans import jobs
from voxlake.sources.tables import read_contract

# Daily scores cut to multiples of 1/1024, so that their mean does not depend on the order of addition.
view("dtx", "SELECT * REPLACE (floor(avg_sentiment_score * 1024) / 1024 AS avg_sentiment_score) FROM dtm", "dtm")
view(
    "fsum",
    """SELECT topic, genre, count(*) AS history_days, CAST(sum(comment_count) AS BIGINT) AS total_comments,
    min(metric_date) AS history_start_date, max(metric_date) AS history_end_date,
    round(avg(comment_count), 3) AS avg_daily_comments, round(avg(avg_sentiment_score), 4) AS avg_daily_sentiment,
    round(coalesce(stddev_samp(comment_count), 0), 3) AS stddev_daily_comments,
    round(coalesce(stddev_samp(avg_sentiment_score), 0), 4) AS stddev_daily_sentiment,
    count(*) >= 5 AS is_forecast_eligible, CASE WHEN count(*) >= 5 THEN 'damped_trend' ELSE 'skip' END AS forecast_method
  FROM dtx GROUP BY topic, genre""",
    "dtx",
)


def fold_views(prefix: str, source: str, keys: str, date: str, volume: str, score: str) -> None:
    """Level and trend of every series by stepping through its days."""
    same = " AND ".join(f"s.{k} = w.{k}" for k in keys.split(", "))
    picked = ", ".join(f"w.{k}" for k in keys.split(", "))
    view(
        f"{prefix}_s",
        f"""SELECT {keys}, {date} AS d, CAST({volume} AS DOUBLE) AS v, {score} AS s,
    row_number() OVER (PARTITION BY {keys} ORDER BY {date}) AS n, count(*) OVER (PARTITION BY {keys}) AS days,
    lead(CAST({volume} AS DOUBLE)) OVER (PARTITION BY {keys} ORDER BY {date}) AS v1,
    lead({score}) OVER (PARTITION BY {keys} ORDER BY {date}) AS s1 FROM {source}""",
        source,
    )
    view(
        f"{prefix}_w",
        f"""SELECT {keys}, n, d, days, v AS vl, coalesce(v1 - v, 0) AS vt, s AS sl, coalesce(s1 - s, 0) AS st
  FROM {prefix}_s WHERE n = 1
  UNION ALL
  SELECT {picked}, z.n, z.d, z.days, z.vl, 0.35 * (z.vl - z.pvl) + 0.65 * 0.75 * z.pvt,
    z.sl, 0.35 * (z.sl - z.psl) + 0.65 * 0.75 * z.pst
  FROM (SELECT {picked}, s.n, s.d, s.days, w.vl AS pvl, w.vt AS pvt, w.sl AS psl, w.st AS pst,
      0.6 * s.v + 0.4 * (w.vl + 0.75 * w.vt) AS vl, 0.6 * s.s + 0.4 * (w.sl + 0.75 * w.st) AS sl
    FROM {prefix}_w w JOIN {prefix}_s s ON {same} AND s.n = w.n + 1) z, (SELECT 1) AS one""".replace(
            "SELECT " + picked + ", z.n", "SELECT " + picked.replace("w.", "z.") + ", z.n"
        ).replace(", (SELECT 1) AS one", ""),
        f"{prefix}_s",
    )
    view(
        f"{prefix}_f",
        f"""SELECT {keys}, CAST(d + CAST(h AS INTEGER) AS DATE) AS forecast_date, CAST(h AS INTEGER) AS horizon_day,
    greatest(vl + vt * (0.75 * (1 - pow(0.75, h)) / 0.25), 0) AS raw_v,
    least(greatest(sl + st * (0.75 * (1 - pow(0.75, h)) / 0.25), -1), 1) AS raw_s,
    CAST(days AS INTEGER) AS history_days_used
  FROM {prefix}_w, unnest(range(1, 8)) AS r(h) WHERE n = days""",
        f"{prefix}_w",
    )


fold_views("tf", "dtm", "topic, genre", "metric_date", "comment_count", "avg_sentiment_score")
view(
    "f7",
    """SELECT topic, genre, forecast_date, horizon_day, round(raw_v, 3) AS forecast_comment_count,
    round(raw_s, 4) AS forecast_sentiment_score, history_days_used, 'damped_trend' AS model_name
  FROM tf_f WHERE history_days_used >= 5""",
    "tf_f",
)
view(
    "hist",
    """SELECT CAST(collection_date AS DATE) AS collection_date, CAST(sum(comments_count) AS BIGINT) AS comments_count,
    sum(avg_sentiment_score * greatest(comments_count, 1)) / sum(greatest(comments_count, 1)) AS avg_sentiment_score,
    1 AS one
  FROM daily_trend GROUP BY collection_date""",
    "daily_trend",
)
fold_views("of", "hist", "one", "collection_date", "comments_count", "avg_sentiment_score")
view(
    "roll",
    """SELECT forecast_date, sum(forecast_comment_count) AS v,
    sum(forecast_sentiment_score * greatest(forecast_comment_count, 1)) / sum(greatest(forecast_comment_count, 1)) AS s
  FROM f7 GROUP BY forecast_date""",
    "f7",
)
_BANDS = """round(greatest(v - sv, 0), 6) AS comments_lower, round(v + sv, 6) AS comments_upper,
    round(greatest(s - ss, -1), 6) AS sentiment_lower, round(least(s + ss, 1), 6) AS sentiment_upper"""


def daily(spark, d):
    return marts.daily_topic_metrics(engagement(spark, d))


def daily_exact(spark, d):
    return daily(spark, d).withColumn("avg_sentiment_score", F.floor(F.col("avg_sentiment_score") * 1024) / 1024)


def forecasts(spark, d):
    return forecast.topic_forecast(daily(spark, d))


@case("forecast_summary", sql("SELECT * FROM fsum", "fsum"))
def _summary(spark, d):
    return forecast.forecast_summary(daily_exact(spark, d))


@case("damped_trend_forecast", sql("SELECT * FROM f7", "f7", recursive=True))
def _forecast(spark, d):
    return forecasts(spark, d)


@case("forecast_table_job", sql("SELECT * FROM f7", "f7", recursive=True))
def _forecast_job(spark, d):
    root = scored_table(spark, d)
    jobs.predictive_gold(spark, root)
    return read_contract(spark, root, "gold.youtube_comments_forecast_7d").drop("built_at")


@case(
    "weighted_daily_sentiment",
    sql(
        "SELECT collection_date, comments_count, round(avg_sentiment_score, 6) AS avg_sentiment_score FROM hist",
        "hist",
    ),
)
def _history(spark, d):
    return rounded(forecast.daily_history(marts.daily_trend(engagement(spark, d))))


@case(
    "overall_fallback_forecast",
    sql(
        f"""SELECT forecast_date, round(v, 6) AS forecast_comment_count, round(s, 6) AS forecast_sentiment_score,
    {_BANDS}, 'local_damped_trend' AS model_name
  FROM (SELECT forecast_date, raw_v AS v, raw_s AS s FROM of_f),
    (SELECT greatest(stddev_pop(comments_count), 1) AS sv, greatest(stddev_pop(avg_sentiment_score), 0.02) AS ss
     FROM hist)""",
        "of_f",
        recursive=True,
    ),
)
def _fallback(spark, d):
    history = forecast.daily_history(marts.daily_trend(engagement(spark, d)))
    return rounded(forecast.fallback_forecast(history))


@case(
    "forecast_rollup_with_bands",
    sql(
        f"""SELECT forecast_date, round(v, 6) AS forecast_comment_count, round(s, 6) AS forecast_sentiment_score, {_BANDS}
  FROM roll, (SELECT greatest(stddev_pop(v), 1) AS sv, greatest(stddev_pop(s), 0.02) AS ss FROM roll)""",
        "roll",
        recursive=True,
    ),
)
def _rollup(spark, d):
    return rounded(forecast.aggregate_forecast(forecasts(spark, d)))


view(
    "ftopic",
    f"""SELECT topic, genre, avg(forecast_comment_count) AS avg_forecast_comments,
    avg(forecast_sentiment_score) AS avg_forecast_sentiment, {display_sql('topic')} AS topic_display,
    {display_sql('genre')} AS genre_display FROM f7 GROUP BY topic, genre""",
    "f7",
)
_FTOPIC = """SELECT topic, genre, round(avg_forecast_comments, 6) AS avg_forecast_comments,
    round(avg_forecast_sentiment, 6) AS avg_forecast_sentiment, topic_display, genre_display FROM ftopic"""


@case("forecast_by_topic", sql(_FTOPIC, "ftopic", recursive=True))
def _by_topic(spark, d):
    return rounded(forecast.forecast_by_topic(forecasts(spark, d)))


@case(
    "rising_forecast_topics",
    sql(
        f"{_FTOPIC} ORDER BY ftopic.avg_forecast_comments DESC, ftopic.avg_forecast_sentiment DESC, topic, genre LIMIT 10",
        "ftopic",
        recursive=True,
    ),
)
def _rising(spark, d):
    return rounded(forecast.rising_topics(forecast.forecast_by_topic(forecasts(spark, d))))


@case(
    "risk_forecast_topics",
    sql(
        f"{_FTOPIC} ORDER BY ftopic.avg_forecast_sentiment, ftopic.avg_forecast_comments DESC, topic, genre LIMIT 10",
        "ftopic",
        recursive=True,
    ),
)
def _risk(spark, d):
    return rounded(forecast.forecast_risk_topics(forecast.forecast_by_topic(forecasts(spark, d))))


def direction_sql(expr: str, threshold: float) -> str:
    return (
        f"CASE WHEN ({expr}) IS NULL THEN 'not enough forecast evidence' WHEN ({expr}) > {threshold} THEN 'rising' "
        f"WHEN ({expr}) < -{threshold} THEN 'falling' ELSE 'stable' END"
    )


@case(
    "forecast_headline",
    sql(
        f"""SELECT latest_comments, round(latest_sentiment, 6) AS latest_sentiment,
    round(fv, 6) AS forecast_comments_mean, round(fs, 6) AS forecast_sentiment_mean, ready AS forecast_ready_topics,
    {direction_sql('fv - latest_comments', 5.0)} AS volume_direction,
    {direction_sql('fs - latest_sentiment', 0.03)} AS sentiment_direction
  FROM (SELECT max_by(comments_count, collection_date) AS latest_comments,
          max_by(avg_sentiment_score, collection_date) AS latest_sentiment FROM hist),
    (SELECT avg(v) AS fv, avg(s) AS fs FROM roll),
    (SELECT count(*) FILTER (is_forecast_eligible) AS ready FROM fsum)""",
        "hist",
        "roll",
        "fsum",
        recursive=True,
    ),
)
def _headline(spark, d):
    events = engagement(spark, d)
    history = forecast.daily_history(marts.daily_trend(events))
    topics = daily(spark, d)
    rollup = forecast.aggregate_forecast(forecast.topic_forecast(topics))
    return rounded(forecast.forecast_headline(history, rollup, forecast.forecast_summary(topics)))


view(
    "gf",
    """SELECT genre, current_comments, current_sentiment, forecast_comments, forecast_sentiment,
    CASE WHEN current_comments > 0 THEN (forecast_comments - current_comments) / current_comments * 100 END
      AS comments_change_pct, forecast_sentiment - current_sentiment AS sentiment_change
  FROM (SELECT genre, count(DISTINCT comment_id) AS current_comments, avg(sentiment_score) AS current_sentiment
        FROM eng GROUP BY genre)
  LEFT JOIN (SELECT genre, avg(forecast_comment_count) AS forecast_comments,
        avg(forecast_sentiment_score) AS forecast_sentiment FROM f7 GROUP BY genre) USING (genre)""",
    "eng",
    "f7",
)
_GF = """SELECT genre, current_comments, round(current_sentiment, 6) AS current_sentiment,
    round(forecast_comments, 6) AS forecast_comments, round(forecast_sentiment, 6) AS forecast_sentiment,
    round(comments_change_pct, 6) AS comments_change_pct, round(sentiment_change, 6) AS sentiment_change"""


@case("genre_current_vs_forecast", sql(f"{_GF} FROM gf", "gf", recursive=True))
def _genres(spark, d):
    return rounded(forecast.genre_forecast(engagement(spark, d), forecasts(spark, d)))


@case(
    "genre_outlook",
    sql(
        f"""{_GF}, {display_sql('genre')} AS genre_display,
    {direction_sql('gf.comments_change_pct', 10.0)} AS volume_direction,
    {direction_sql('gf.sentiment_change', 0.03)} AS sentiment_direction
  FROM gf ORDER BY gf.forecast_comments DESC NULLS LAST, gf.current_comments DESC, genre LIMIT 8""",
        "gf",
        recursive=True,
    ),
)
def _outlook(spark, d):
    return rounded(forecast.genre_outlook(forecast.genre_forecast(engagement(spark, d), forecasts(spark, d))))


@case(
    "genre_direction_labels",
    sql(
        f"""SELECT topic, genre, {direction_sql('avg_daily_comments - 20', 5.0)} AS volume,
    {direction_sql('CASE WHEN history_days > 3 THEN avg_daily_sentiment END', 0.03)} AS mood FROM fsum""",
        "fsum",
    ),
)
def _directions(spark, d):
    from voxlake.functions.numeric import direction

    s = forecast.forecast_summary(daily_exact(spark, d))
    mood = F.when(F.col("history_days") > 3, F.col("avg_daily_sentiment"))
    return s.select(
        "topic",
        "genre",
        direction(F.col("avg_daily_comments") - 20, 5.0).alias("volume"),
        direction(mood, 0.03).alias("mood"),
    )
