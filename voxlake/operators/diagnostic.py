"""Tables behind the diagnostic page: risk topics, weak videos, driver words, the sharpest drop, endorsement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.columns import as_date, double_or_zero, first_present
from voxlake.functions.numeric import (
    SCORE_EDGES,
    SCORE_LABELS,
    bucket_index,
    label_by_index,
    safe_denominator,
    weighted_avg,
)
from voxlake.functions.text import DRIVER_STOP_WORDS, display_text, normalized, shorten
from voxlake.operators.counting import counted, row_counts
from voxlake.operators.descriptive import likes
from voxlake.operators.marts import comment_keywords, distinct_comments, flag_repeats

# The diagnostic page prefers the other like column first.
_LIKE_NAMES = ("comment_like_count", "like_count")


def _grouped(
    comments: DataFrame,
    keys: Sequence[str],
    distinct: dict[str, str] | None = None,
    extra_labels: Sequence[str] = (),
    with_likes: bool = True,
) -> DataFrame:
    """Comment aggregate per key set with unrounded label shares, from one pass over the comments."""
    df = comments.withColumn("_likes", likes(comments, _LIKE_NAMES).cast("double"))
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    labels = {f"{name}_comments": F.coalesce(F.col("sentiment_label") == name, F.lit(False)) for name in ("negative", "positive", *extra_labels)}
    sums = {**row_counts(**labels, _scored=F.col("sentiment_score").isNotNull(), _liked=F.col("_likes").isNotNull())}
    sums |= {"_score": F.col("sentiment_score"), "total_comment_likes": F.col("_likes")}
    out = counted(df, keys, {"comments_count": "comment_id", **(distinct or {})}, sums)
    mean = lambda total, rows: F.col(total) / F.nullif(F.col(rows), F.lit(0))
    like_columns = ["total_comment_likes", mean("total_comment_likes", "_liked").alias("avg_comment_likes")]
    out = out.select(
        *keys, "comments_count", *(distinct or {}), mean("_score", "_scored").alias("avg_sentiment_score"), *labels,
        *(like_columns if with_likes else []),
    )
    return out.withColumns(
        {
            f"{name}_ratio": F.col(f"{name}_comments") / safe_denominator(F.col("comments_count"))
            for name in ("negative", "positive")
        }
    )


def _display(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{k}_display": display_text(F.col(k)) for k in ("topic", "genre")})


def topic_risk(comments: DataFrame) -> DataFrame:
    """Per topic and genre: counts, mean score, shares, and the load of negative comments."""
    out = _grouped(comments, ["topic", "genre"], {"videos_covered": "video_id"}, ["neutral"])
    return _display(out.withColumn("risk_load", F.col("comments_count") * F.col("negative_ratio")))


def video_risk(comments: DataFrame) -> DataFrame:
    out = _grouped(comments, ["video_id", "video_title", "channel_title", "topic", "genre"])
    return _display(out.withColumn("video_display", shorten(F.col("video_title"))))


def daily_topics(comments: DataFrame) -> DataFrame:
    """Per day, topic and genre; the day is the collection date, else the day of publication."""
    source = "collection_date" if "collection_date" in comments.columns else "comment_published_at"
    dated = comments.withColumn("collection_date", as_date(comments, source))
    return _display(_grouped(dated, ["collection_date", "topic", "genre"], with_likes=False))


def topic_extremes(topics: DataFrame) -> DataFrame:
    """One row: the most at-risk and the strongest topic."""
    tie = F.struct(F.col("topic"), F.col("genre"))
    pick = lambda measure: F.max_by(
        F.struct("topic", "genre", measure, "comments_count"), F.struct(measure, "comments_count", tie)
    )
    chosen = topics.agg(pick("negative_ratio").alias("r"), pick("avg_sentiment_score").alias("s"))
    return chosen.select(
        F.col("r.topic").alias("at_risk_topic"),
        F.col("r.genre").alias("at_risk_genre"),
        F.col("r.negative_ratio").alias("at_risk_negative_ratio"),
        F.col("s.topic").alias("strongest_topic"),
        F.col("s.genre").alias("strongest_genre"),
        F.col("s.avg_sentiment_score").alias("strongest_score"),
    )


def negative_load(topics: DataFrame, limit: int = 10) -> DataFrame:
    order = [F.col("negative_comments").desc(), F.col("comments_count").desc(), "topic", "genre"]
    return topics.orderBy(*order).limit(limit)


def ranked_videos(videos: DataFrame, weak: bool = True, limit: int = 10) -> DataFrame:
    score = F.col("avg_sentiment_score")
    order = [
        score.asc() if weak else score.desc(),
        F.col("comments_count").desc(),
        F.col("total_comment_likes").desc(),
        *[F.col(name) for name in ("video_id", "topic", "genre")],
    ]
    return videos.orderBy(*order).limit(limit)


def _signed(df: DataFrame, positive: bool, name: str) -> DataFrame:
    return df.filter(F.col(name) > 0 if positive else F.col(name) < 0)


def mart_drivers(keywords: DataFrame, positive: bool = True, top_n: int = 15) -> DataFrame:
    """Driver words of one sign from the keyword mart; scores weighted by comments, else by occurrences."""
    df = keywords.select(
        "topic",
        "genre",
        "keyword",
        *[
            double_or_zero(keywords, name).alias(name)
            for name in ("keyword_count", "distinct_comments", "avg_sentiment_score")
        ],
    )
    score, ids, rows = F.col("avg_sentiment_score"), F.col("distinct_comments"), F.col("keyword_count")
    out = (
        _signed(df, positive, "avg_sentiment_score")
        .groupBy("topic", "genre", "keyword")
        .agg(
            F.sum(rows).alias("keyword_count"),
            F.sum(ids).alias("distinct_comments"),
            F.when(F.sum(ids) > 0, weighted_avg(score, ids))
            .otherwise(weighted_avg(score, rows))
            .alias("avg_sentiment_score"),
        )
        .filter(F.col("topic").isNotNull() & F.col("genre").isNotNull())
    )
    order = [F.col("keyword_count").desc(), F.col("distinct_comments").desc(), "keyword", "topic", "genre"]
    return _display(out.orderBy(*order).limit(top_n))


def comment_drivers(
    comments: DataFrame,
    positive: bool = True,
    top_n: int = 15,
    stop_words: Sequence[str] = tuple(DRIVER_STOP_WORDS),
) -> DataFrame:
    """Driver words of one sign from comment texts; topic and genre are those of the first comment id."""
    signed = _signed(comments, positive, "sentiment_score")
    columns = ["comment_id", "topic", "genre", "sentiment_score", "comment_text"]
    flagged = flag_repeats(signed.select(*columns), [])
    words = comment_keywords(flagged, [*columns[:4], "_again"], stop_words)
    text = lambda name: F.coalesce(F.col(name), F.lit("unknown"))
    first = F.min_by(F.struct(text("topic").alias("topic"), text("genre").alias("genre")),
                     F.struct("comment_id", text("topic"), text("genre")))
    out = words.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"),
        distinct_comments(False).alias("distinct_comments"),
        F.round(F.avg("sentiment_score"), 4).alias("avg_sentiment_score"),
        first.alias("_first"),
    )
    top = out.orderBy(F.col("keyword_count").desc(), "keyword").limit(top_n)
    return _display(
        top.select(
            F.col("_first.topic").alias("topic"),
            F.col("_first.genre").alias("genre"),
            "keyword",
            "keyword_count",
            "distinct_comments",
            "avg_sentiment_score",
        )
    )


def drivers(keywords: DataFrame | None, comments: DataFrame, positive: bool = True, top_n: int = 15) -> DataFrame:
    """Driver words from the mart, or from the comments where the mart has none of that sign."""
    if keywords is not None:
        found = mart_drivers(keywords, positive, top_n)
        if not _signed(keywords, positive, "avg_sentiment_score").isEmpty():
            return found
    return comment_drivers(comments, positive, top_n)


def daily_change(trend: DataFrame) -> DataFrame:
    """Plain mean of the topic averages per day and its change from the day before.

    The change is a window without partitions over one row per DAY, after the aggregation.
    """
    day = as_date(trend, "collection_date")
    daily = (
        trend.withColumn("collection_date", day)
        .filter(F.col("collection_date").isNotNull())
        .groupBy("collection_date")
        .agg(F.avg("avg_sentiment_score").alias("avg_sentiment_score"))
    )
    before = F.lag("avg_sentiment_score").over(Window.orderBy("collection_date"))
    return daily.withColumn("delta", F.col("avg_sentiment_score") - before)


def sharpest_drop(trend: DataFrame) -> DataFrame:
    """The day with the smallest change (no row with fewer than two days)."""
    changes = daily_change(trend).filter(F.col("delta").isNotNull())
    return changes.orderBy("delta", "collection_date").limit(1)


def drop_drivers(daily: DataFrame, drop: DataFrame, limit: int = 10) -> DataFrame:
    """Topics of the sharpest drop's day by negative comments."""
    on_day = daily.join(drop.select("collection_date"), "collection_date", "left_semi")
    order = [F.col("negative_comments").desc(), F.col("comments_count").desc(), "topic", "genre"]
    return on_day.orderBy(*order).limit(limit)


def endorsement(
    comments: DataFrame,
    edges: Sequence[float] = SCORE_EDGES,
    labels: Sequence[str] = SCORE_LABELS,
) -> DataFrame:
    """Comments and likes per score bucket; buckets without comments stay with 0."""
    df = comments.select(
        bucket_index(first_present(comments, ["sentiment_score"]), edges).alias("sentiment_bucket_order"),
        first_present(comments, ["sentiment_score"]).alias("score"),
        likes(comments, _LIKE_NAMES).alias("likes"),
    ).filter(F.col("sentiment_bucket_order").isNotNull())
    counted = df.groupBy("sentiment_bucket_order").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("likes").alias("likes"),
        F.avg("likes").alias("avg_likes_per_comment"),
        F.avg("score").alias("avg_sentiment_score"),
    )
    buckets = comments.sparkSession.range(len(labels)).select(F.col("id").cast("int").alias("sentiment_bucket_order"))
    joined = buckets.join(counted, "sentiment_bucket_order", "left")
    return joined.select(
        label_by_index(F.col("sentiment_bucket_order"), labels).alias("sentiment_bucket"),
        "sentiment_bucket_order",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("comments_count"),
        F.coalesce("likes", F.lit(0)).cast("bigint").alias("total_comment_likes"),
        "avg_likes_per_comment",
        "avg_sentiment_score",
    )


def most_endorsed(buckets: DataFrame) -> DataFrame:
    order = [F.col("avg_likes_per_comment").desc_nulls_last(), F.col("total_comment_likes").desc()]
    return buckets.orderBy(*order, "sentiment_bucket_order").limit(1)


def like_distribution(comments: DataFrame) -> DataFrame:
    """Likes per comment with a cleaned label, for the three known labels."""
    label = normalized(F.coalesce("sentiment_label", F.lit("neutral")))
    df = comments.select(label.alias("sentiment_label"), likes(comments, _LIKE_NAMES).alias("resolved_like_count"))
    return df.filter(F.col("sentiment_label").isin("positive", "neutral", "negative"))


_QUARTILES = (0.25, 0.5, 0.75)
#: Like counts are dealt out by their logarithm, so that no task holds all values of a label.
_RANGES = 32


def like_box(distribution: DataFrame) -> DataFrame:
    """Box statistics of likes per label, with quartiles between the two nearest values.

    Likes are counted per value, the counts are added up in value order within ranges of values and the sums of the
    ranges before are added, so each quartile is the value at which the running count passes its place.
    """
    value = F.col("resolved_like_count")
    counts = distribution.groupBy("sentiment_label", "resolved_like_count").agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.withColumn("_range", F.least(F.lit(_RANGES), F.floor(F.log2(F.greatest(value, F.lit(0)) + 1))))
    sums = ranged.groupBy("sentiment_label", "_range").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("sentiment_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("sentiment_label").alias("_label"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("sentiment_label")).alias("_all"),
    )
    inside = Window.partitionBy("sentiment_label", "_range").orderBy(value)
    placed = ranged.withColumn("_run", F.sum("n").over(inside)).join(
        sums, (F.col("sentiment_label") == F.col("_label")) & (F.col("_range") == F.col("_of"))
    )
    run = F.col("_before") + F.col("_run")

    def at(place: Column) -> Column:
        """The value that holds a place, counted from 0."""
        return F.min(F.when(run > place, value))

    found = []
    for i, share in enumerate(_QUARTILES):
        place = share * (F.col("_all") - 1)
        found += [at(F.floor(place)).alias(f"_l{i}"), at(F.ceil(place)).alias(f"_h{i}"), F.max(place - F.floor(place)).alias(f"_f{i}")]
    stats = placed.groupBy("sentiment_label").agg(
        F.sum("n").alias("comments_count"),
        F.min("resolved_like_count").alias("min_likes"),
        F.max("resolved_like_count").alias("max_likes"),
        *found,
    )
    q = [F.col(f"_l{i}") + F.col(f"_f{i}") * (F.col(f"_h{i}") - F.col(f"_l{i}")) for i in range(3)]
    spread = q[2] - q[0]
    box = stats.select(
        "sentiment_label",
        "comments_count",
        "min_likes",
        q[0].alias("q1_likes"),
        q[1].alias("median_likes"),
        q[2].alias("q3_likes"),
        "max_likes",
        (q[0] - 1.5 * spread).alias("_low"),
        (q[2] + 1.5 * spread).alias("_high"),
    )
    outside = (F.col("resolved_like_count") < F.col("_low")) | (F.col("resolved_like_count") > F.col("_high"))
    fences = box.select(F.col("sentiment_label").alias("_label"), "_low", "_high")
    outliers = (
        counts.join(fences, F.col("sentiment_label") == F.col("_label"))
        .groupBy("sentiment_label")
        .agg(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).cast("bigint").alias("outliers"))
    )
    return box.drop("_low", "_high").join(outliers, "sentiment_label")
