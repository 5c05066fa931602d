"""Tables behind the overview and descriptive pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.columns import (
    as_date,
    as_timestamp,
    date_label,
    double_or_zero,
    first_present,
    int_or_zero,
    present,
)
from voxlake.functions.numeric import divide, weighted_avg
from voxlake.functions.text import display_text, truncate_text
from voxlake.operators.counting import counted, row_counts

# Columns in which like and keyword counts may come.
LIKE_NAMES = ("like_count", "comment_like_count")
KEYWORD_COUNT_NAMES = ("keyword_count", "keyword_frequency", "occurrences", "mentions_count", "count")


def likes(df: DataFrame, names: Sequence[str] = LIKE_NAMES) -> Column:
    """Like count from whichever column there is, 0 for none or bad values."""
    found = present(df, names)
    return int_or_zero(df, found[0]) if found else F.lit(0).cast("bigint")


def daily_rollup(trend: DataFrame) -> DataFrame:
    """Per day: sums, and averages weighted by comments (plain mean when no comments are counted)."""
    df = trend.select(
        as_date(trend, "collection_date").alias("collection_date"),
        *[
            double_or_zero(trend, name).alias(name)
            for name in "comments_count videos_covered avg_sentiment_score positive_ratio negative_ratio".split()
        ],
    ).filter(F.col("collection_date").isNotNull())
    weight = F.col("comments_count")
    return (
        df.groupBy("collection_date")
        .agg(
            F.sum("comments_count").alias("comments_count"),
            F.sum("videos_covered").alias("videos_covered"),
            *[
                weighted_avg(F.col(name), weight).alias(name)
                for name in ("avg_sentiment_score", "positive_ratio", "negative_ratio")
            ],
        )
        .withColumn("collection_date_label", date_label(F.col("collection_date")))
    )


def daily_engagement(comments: DataFrame) -> DataFrame:
    """Comments and likes per day of publication."""
    df = comments.select(
        as_timestamp(comments, "comment_published_at").cast("date").alias("comment_date"),
        likes(comments).alias("likes"),
    ).filter(F.col("comment_date").isNotNull())
    return (
        df.groupBy("comment_date")
        .agg(
            F.count(F.lit(1)).alias("matched_comments"),
            F.sum("likes").alias("total_comment_likes"),
            F.avg("likes").alias("avg_likes_per_comment"),
        )
        .withColumn("comment_date_label", date_label(F.col("comment_date")))
    )


def topic_engagement(comments: DataFrame) -> DataFrame:
    """Comments, likes and videos per topic and genre."""
    video = [F.count_distinct(name).alias("unique_videos") for name in present(comments, ("video_id", "video_title"))]
    return (
        comments.withColumn("_likes", likes(comments))
        .filter(F.col("topic").isNotNull() & F.col("genre").isNotNull())
        .groupBy("topic", "genre")
        .agg(
            F.count(F.lit(1)).alias("matched_comments"),
            F.sum("_likes").alias("total_comment_likes"),
            F.avg("_likes").alias("avg_likes_per_comment"),
            *video[:1],
        )
    )


def topic_engagement_view(topics: DataFrame, comments: DataFrame) -> DataFrame:
    """Topic mart and comment aggregates side by side, topics of either side kept.

    The like total comes from the comments, the like average from the mart when it has one, and the matched
    count falls back to the mart's count.
    """
    keys = ["topic", "genre"]
    found = topic_engagement(comments)
    if "unique_videos" not in found.columns:
        found = found.withColumn("unique_videos", F.lit(0).cast("bigint"))
    average = first_present(topics, ("avg_likes_per_comment", "avg_comment_likes"))
    has_average = bool(present(topics, ("avg_likes_per_comment", "avg_comment_likes")))
    mart = topics.select(
        *[F.col(k).alias(f"m_{k}") for k in keys],
        double_or_zero(topics, "comments_count").cast("bigint").alias("comments_count"),
        *[double_or_zero(topics, n).alias(n) for n in ("avg_sentiment_score", "positive_ratio", "negative_ratio")],
        average.alias("mart_likes"),
    )
    joined = mart.join(found, [F.col(f"m_{k}").eqNullSafe(F.col(k)) for k in keys], "full")
    zero = F.lit(0).cast("bigint")
    counted = F.coalesce("comments_count", zero)
    like_average = F.col("mart_likes") if has_average else F.col("avg_likes_per_comment")
    out = joined.select(
        *[F.coalesce(f"m_{k}", k).alias(k) for k in keys],
        counted.alias("comments_count"),
        F.when(F.coalesce("matched_comments", zero) > 0, F.col("matched_comments"))
        .otherwise(counted)
        .alias("matched_comments"),
        *[F.coalesce(n, F.lit(0.0)).alias(n) for n in ("avg_sentiment_score", "positive_ratio", "negative_ratio")],
        F.coalesce("total_comment_likes", zero).alias("total_comment_likes"),
        F.coalesce(like_average, F.lit(0.0)).alias("avg_likes_per_comment"),
        F.coalesce("unique_videos", zero).alias("unique_videos"),
    )
    return out.withColumns({f"{k}_display": display_text(F.col(k)) for k in keys})


_VIDEO_KEYS = ("video_id", "video_title", "channel_title", "topic", "genre")


def video_engagement(comments: DataFrame) -> DataFrame:
    """Comments and likes per video, by whichever of the five attributes the frame has."""
    keys = present(comments, _VIDEO_KEYS)
    df = comments.withColumn("_likes", likes(comments))
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("matched_comments"),
        F.sum("_likes").alias("total_comment_likes"),
        F.avg("_likes").alias("avg_likes_per_comment"),
    )


def _per_video(found: DataFrame, key: str) -> DataFrame:
    """Comment groups of a video as one row: counts and likes added up, names those of its largest group."""
    names = [c for c in present(found, _VIDEO_KEYS) if c != key]
    size = F.struct("matched_comments", *names)
    return (
        found.groupBy(key)
        .agg(
            *[F.max_by(name, size).alias(name) for name in names],
            *[F.sum(name).alias(name) for name in ("matched_comments", "total_comment_likes")],
        )
        .withColumn("avg_likes_per_comment", divide(F.col("total_comment_likes"), F.col("matched_comments")))
    )


def video_evidence(comments: DataFrame, videos: DataFrame, per_video: bool = False) -> DataFrame:
    """Video mart rows with the comment aggregates of the same video; mart values win, gaps are filled.

    A video whose comments fall into several groups (of topic, genre or title) gives one row per group, as the mart's
    reader expects; with ``per_video`` the groups of a video are added up first, and mart rows keep their number. Where
    the mart is empty, the comment groups themselves are the rows.
    """
    found = video_engagement(comments)
    if per_video:
        found = _per_video(found, "video_id" if "video_id" in found.columns else "video_title")
    if videos.isEmpty():
        videos = found.withColumn("comments_count", F.col("matched_comments"))
        scores = [F.lit(0.0).alias(name) for name in ("avg_sentiment_score", "positive_ratio", "negative_ratio")]
        filled = videos.select("*", *scores)
        missing = {"video_title": "Unknown Video", "channel_title": "Unknown Channel", "topic": "unknown", "genre": "unknown"}
        filled = filled.withColumns({n: F.lit(v) for n, v in missing.items() if n not in filled.columns})
        return _video_display(filled)
    key = "video_id" if "video_id" in videos.columns and "video_id" in found.columns else "video_title"
    side = found.select([F.col(c).alias(f"c_{c}") for c in found.columns])
    joined = videos.join(side, F.col(key) == F.col(f"c_{key}"), "left")
    out: dict[str, Column] = {}
    for name in ("channel_title", "topic", "genre"):
        if name in videos.columns and f"c_{name}" in side.columns:
            out[name] = F.coalesce(name, f"c_{name}")
        elif name not in videos.columns:
            out[name] = F.lit("Unknown Channel" if name == "channel_title" else "unknown")
    if "video_title" not in videos.columns:
        out["video_title"] = F.lit("Unknown Video")
    counted = F.coalesce("comments_count", F.lit(0)) if "comments_count" in videos.columns else F.lit(0)
    out["matched_comments"] = F.coalesce("c_matched_comments", counted).cast("bigint")
    for name, kind in (("total_comment_likes", "bigint"), ("avg_likes_per_comment", "double")):
        source = name if name in videos.columns else f"c_{name}"
        out[name] = F.coalesce(F.col(source), F.lit(0)).cast(kind)
    for name in ("avg_sentiment_score", "positive_ratio", "negative_ratio"):
        if name in videos.columns:
            out[name] = double_or_zero(videos, name)
    merged = joined.withColumns(out).drop(*side.columns)
    return _video_display(merged)


def _video_display(videos: DataFrame) -> DataFrame:
    return videos.withColumns(
        {
            "video_title_short": truncate_text(F.col("video_title"), 38),
            "topic_display": display_text(F.col("topic")),
            "genre_display": display_text(F.col("genre")),
        }
    )


_VIDEO_TIES = ("video_id", "collection_date", "topic", "genre", "video_title", "channel_title")


def _tie(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(name) for name in present(df, names)]


def engaging_videos(evidence: DataFrame, positive: bool = True, limit: int = 10) -> DataFrame:
    score = F.col("avg_sentiment_score")
    order = [
        score.desc() if positive else score.asc(),
        F.col("total_comment_likes").desc(),
        F.col("matched_comments").desc(),
        *_tie(evidence, _VIDEO_TIES),
    ]
    return evidence.orderBy(*order).limit(limit)


def representative_comments(comments: DataFrame, positive: bool = True, limit: int = 4) -> DataFrame:
    """The most liked comments of one sign, in card form (the card shows 220 characters)."""
    score = first_present(comments, ["sentiment_score"])
    df = comments.withColumns({"sentiment_score": score, "likes": likes(comments)})
    df = df.filter(F.col("sentiment_score") > 0 if positive else F.col("sentiment_score") < 0)
    second = F.col("sentiment_score").desc() if positive else F.col("sentiment_score").asc()
    top = df.orderBy(F.col("likes").desc(), second, *_tie(df, ("comment_id",))).limit(limit)
    return top.select(
        *present(top, ("comment_id",)),
        display_text(F.col("topic")).alias("topic_display"),
        display_text(F.col("genre")).alias("genre_display"),
        "sentiment_score",
        "likes",
        F.substring("comment_text", 1, 220).alias("comment_excerpt"),
        truncate_text(F.col("video_title"), 55).alias("video_title_short"),
    )


def hour_heatmap(comments: DataFrame) -> DataFrame:
    """Weekday rows by 24 hour columns, 0 where nothing was published."""
    moment = as_timestamp(comments, "comment_published_at")
    df = comments.select(
        F.date_format(moment, "EEEE").alias("weekday_name"), F.hour(moment).alias("hour")
    ).filter(F.col("hour").isNotNull())
    counts = [F.count_if(F.col("hour") == h).alias(f"hour_{h:02d}") for h in range(24)]
    return df.groupBy("weekday_name").agg(*counts)


def driver_words(keywords: DataFrame, positive: bool = True, limit: int = 12) -> DataFrame:
    """Most frequent mart keywords of one sign, over all groups."""
    count = next(name for name in KEYWORD_COUNT_NAMES if name in keywords.columns)
    score = double_or_zero(keywords, "avg_sentiment_score")
    df = keywords.withColumn("avg_sentiment_score", score)
    df = df.filter(F.col("avg_sentiment_score") > 0 if positive else F.col("avg_sentiment_score") < 0)
    second = F.col("avg_sentiment_score").desc() if positive else F.col("avg_sentiment_score").asc()
    ties = _tie(df, ("keyword", "collection_date", "topic", "genre"))
    return df.orderBy(F.col(count).desc(), second, *ties).limit(limit)


def descriptive_kpis(comments: DataFrame, engagement: DataFrame) -> DataFrame:
    """One row: comments, videos, weighted score and positive share, likes."""
    base = comments.select("video_id", likes(comments).alias("_likes")).agg(
        F.count(F.lit(1)).alias("matched_comments"),
        F.count_distinct("video_id").alias("unique_videos"),
        F.coalesce(F.sum("_likes"), F.lit(0)).cast("bigint").alias("total_comment_likes"),
    )
    weight = F.col("matched_comments")
    mood = engagement.agg(
        F.struct(
            weighted_avg(F.col("avg_sentiment_score"), weight).alias("score"),
            weighted_avg(F.col("positive_ratio"), weight).alias("positive"),
        ).alias("mood")
    )
    return base.withColumn("_mood", mood.scalar()).select(
        "matched_comments",
        "unique_videos",
        F.col("_mood.score").alias("avg_sentiment"),
        F.col("_mood.positive").alias("positive_share"),
        "total_comment_likes",
        divide(F.col("total_comment_likes"), F.col("matched_comments")).alias("avg_likes_per_comment"),
    )


def header_kpis(comments: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    """One row of headline numbers; from the topic mart when no comment is selected."""
    is_label = lambda name: F.coalesce(F.col("sentiment_label") == name, F.lit(False))
    sums = row_counts(rows=F.lit(True), scored=F.col("sentiment_score").isNotNull(), positive=is_label("positive"), negative=is_label("negative"))
    distinct = {"total_comments": "comment_id", "videos_covered": "video_id", "topics_covered": "topic", "genres_covered": "genre"}
    share = lambda part, rows: F.coalesce(F.col(part) / F.nullif(F.col(rows), F.lit(0)), F.lit(0.0))
    from_comments = counted(comments, [], distinct, {**sums, "score": F.col("sentiment_score")}).select(
        share("score", "scored").alias("avg_sentiment"),
        share("positive", "rows").alias("positive_ratio"),
        share("negative", "rows").alias("negative_ratio"),
        *("total_comments", "topics_covered", "genres_covered", "videos_covered"),
    )
    if topics is None:
        return from_comments
    zero = lambda column: F.coalesce(column, F.lit(0))
    means = ("avg_sentiment_score", "positive_ratio", "negative_ratio")
    sums = {"comments": F.col("comments_count"), "videos": F.col("videos_covered")}
    sums |= {name: F.col(name).cast("double") for name in means} | row_counts(**{f"{name}_rows": F.col(name).isNotNull() for name in means})
    of_topics = counted(topics, [], {"topics_covered": "topic", "genres_covered": "genre"}, sums)
    from_mart = of_topics.select(
        share("avg_sentiment_score", "avg_sentiment_score_rows").alias("avg_sentiment"),
        share("positive_ratio", "positive_ratio_rows").alias("positive_ratio"),
        share("negative_ratio", "negative_ratio_rows").alias("negative_ratio"),
        zero(F.col("comments")).cast("bigint").alias("total_comments"),
        "topics_covered",
        "genres_covered",
        zero(F.col("videos")).cast("bigint").alias("videos_covered"),
    )
    names = from_comments.columns
    both = from_comments.withColumn("_mart", from_mart.select(F.struct(*names).alias("m")).scalar())
    empty = F.col("total_comments") == 0
    return both.select(*[F.when(empty, F.col(f"_mart.{n}")).otherwise(F.col(n)).alias(n) for n in names])


def ingestion_trend(collection: DataFrame) -> DataFrame:
    """Written records and videos per run day with the running total.

    The running total is a window without partitions, over one row per DAY, after the aggregation.
    """
    df = collection.withColumn("run_date_label", date_label(as_date(collection, "run_date")))
    daily = (
        df.filter(F.col("run_date_label").isNotNull())
        .groupBy("run_date_label")
        .agg(
            F.sum("total_records_written").alias("written_records"),
            F.sum("total_videos_fetched").alias("fetched_videos"),
        )
    )
    running = Window.orderBy("run_date_label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("cumulative_records", F.sum("written_records").over(running))


def ingestion_headline(trend: DataFrame) -> DataFrame:
    return trend.agg(
        F.max("run_date_label").alias("latest_run_date"),
        F.max_by("written_records", "run_date_label").alias("today_written"),
        F.sum("written_records").alias("total_written"),
    )


def genre_overview(topics: DataFrame) -> DataFrame:
    """Volume and the mean of topic means per genre."""
    return (
        topics.filter(F.col("genre").isNotNull())
        .groupBy("genre")
        .agg(
            F.sum("comments_count").alias("comments_count"),
            F.avg("avg_sentiment_score").alias("avg_sentiment_score"),
        )
        .withColumn("genre_display", display_text(F.col("genre")))
    )
