"""Priorities, winners, driver words per topic, and collection efficiency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.columns import col_or_null, double_or_zero
from voxlake.functions.numeric import clip
from voxlake.functions.text import display_text
from voxlake.operators.descriptive import KEYWORD_COUNT_NAMES

# Priority weights.
MONITORING_WEIGHTS = (0.45, 0.25, 0.20, 0.10)
GROWTH_WEIGHTS = (0.40, 0.25, 0.20, 0.15)


def priorities(
    topics: DataFrame,
    monitoring: Sequence[float] = MONITORING_WEIGHTS,
    growth: Sequence[float] = GROWTH_WEIGHTS,
) -> DataFrame:
    """Monitoring and growth priority per topic; shares refer to the whole table."""
    base = topics.withColumns(
        {
            name: double_or_zero(topics, name)
            for name in "comments_count videos_covered avg_sentiment_score positive_ratio negative_ratio".split()
        }
    )
    total = base.agg(
        F.struct(
            F.greatest(F.coalesce(F.sum("comments_count"), F.lit(0.0)), F.lit(1.0)).alias("comments"),
            F.greatest(F.coalesce(F.sum("videos_covered"), F.lit(0.0)), F.lit(1.0)).alias("videos"),
        ).alias("total")
    )
    wide = base.withColumn("_total", total.scalar())
    score = clip(F.col("avg_sentiment_score"), -1.0, 1.0)
    shares = wide.withColumns(
        {
            "volume_share": F.col("comments_count") / F.col("_total.comments"),
            "video_share": F.col("videos_covered") / F.col("_total.videos"),
            "sentiment_risk": (1 - score) / 2,
            "sentiment_strength": (score + 1) / 2,
        }
    ).drop("_total")
    watch, grow = monitoring, growth
    return shares.withColumns(
        {
            "comments_count": F.col("comments_count").cast("bigint"),
            "videos_covered": F.col("videos_covered").cast("bigint"),
            "monitoring_priority": watch[0] * F.col("negative_ratio")
            + watch[1] * F.col("sentiment_risk")
            + watch[2] * F.col("volume_share")
            + watch[3] * (1 - F.col("positive_ratio")),
            "growth_priority": grow[0] * F.col("positive_ratio")
            + grow[1] * F.col("sentiment_strength")
            + grow[2] * F.col("volume_share")
            + grow[3] * F.col("video_share"),
        }
    )


def ranked(scored: DataFrame, by: str = "monitoring_priority", limit: int = 3) -> DataFrame:
    """Topics by one of the priorities, with display names."""
    order = [F.col(by).desc(), F.col("comments_count").desc(), "topic", "genre"]
    top = scored.orderBy(*order).limit(limit)
    return top.withColumns({f"{k}_display": display_text(F.col(k)) for k in ("topic", "genre")})


# The four winners and the measures that decide them.
_WINNERS = {
    "highest_negative_share": ("negative_ratio", "comments_count"),
    "largest_volume": ("comments_count", "videos_covered"),
    "strongest_positive": ("positive_ratio", "comments_count"),
    "widest_coverage": ("videos_covered", "comments_count"),
}


def winners(scored: DataFrame) -> DataFrame:
    """Four rows, one per reason, from a single aggregate."""
    details = ["topic", "genre", "comments_count", "videos_covered", "positive_ratio", "negative_ratio"]
    pick = lambda first, second: F.max_by(
        F.struct(*details), F.struct(first, second, "topic", "genre")
    )
    one = scored.agg(*[pick(*measures).alias(reason) for reason, measures in _WINNERS.items()])
    rows = F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("t")) for r in _WINNERS])
    exploded = one.select(F.explode(rows).alias("w")).filter(F.col("w.t").isNotNull())
    return exploded.select(F.col("w.reason").alias("reason"), "w.t.*")


def topic_words(keywords: DataFrame, positive: bool, limit: int = 3) -> DataFrame:
    """The most frequent words of one sign for every topic at once."""
    count = next(name for name in KEYWORD_COUNT_NAMES if name in keywords.columns)
    score = F.col("avg_sentiment_score")
    df = keywords.filter((score > 0 if positive else score < 0) & F.col("topic").isNotNull())
    ties: list[Column] = [F.col(n) for n in ("keyword", "collection_date", "genre") if n in df.columns]
    order = [F.col(count).desc(), score.desc() if positive else score.asc(), *ties]
    window = Window.partitionBy("topic").orderBy(*order)
    top = df.withColumn("word_rank", F.row_number().over(window)).filter(F.col("word_rank") <= limit)
    return top.select("topic", "keyword", "word_rank", F.col(count).alias("keyword_count"), "avg_sentiment_score")


def efficiency(queries: DataFrame) -> DataFrame:
    """Records written per expected unit; 0 without units."""
    df = queries.withColumns(
        {
            "expected_units": double_or_zero(queries, "expected_units"),
            "records_written": double_or_zero(queries, "records_written"),
            "topic": F.coalesce(col_or_null(queries, "topic"), F.lit("unknown")),
            "query_id": F.coalesce(col_or_null(queries, "query_id").cast("string"), F.lit("unknown")),
        }
    )
    units, written = F.col("expected_units"), F.col("records_written")
    return df.withColumn("efficiency_ratio", F.when(units > 0, written / units).otherwise(F.lit(0.0)))


# Message texts.
_WEAK = "Query '%s' is underperforming for topic '%s'. Rewrite or deprioritize it."
_NO_DATA = "No query performance data is available yet, so no recommendations can be generated."


def recommendations(queries: DataFrame, limit: int = 3) -> DataFrame:
    """The least efficient queries as messages; one fixed message when there are no queries."""
    order = [F.col("efficiency_ratio").asc(), F.col("records_written").asc(), "query_id", "topic"]
    ties = [name for name in ("run_date", "genre") if name in queries.columns]
    weak = efficiency(queries).orderBy(*order, *ties).limit(limit)
    messages = weak.select(F.format_string(_WEAK, "query_id", "topic").alias("recommendation"))
    fallback = queries.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(_NO_DATA).alias("recommendation"))
    return messages.unionByName(fallback)
