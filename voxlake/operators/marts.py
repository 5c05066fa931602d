"""Gold marts over scored comments.

Every mart reads its input once: narrow projection, partial aggregation before the shuffle, so a topic with a third of
all comments costs no more than its share of the scan. Distinct counts stay exact (see ``operators.counting``). ``unique_ids=True``
declares that ``comment_id`` is a key of the input (the silver contract guarantees it); counting ids then needs no
distinct step and most marts shuffle only their partial groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.columns import as_date, as_timestamp, col_or_null, double_or_zero, first_present, int_or_zero
from voxlake.functions.numeric import ratio
from voxlake.functions.text import MART_STOP_WORDS, is_keyword, word_runs
from voxlake.operators.counting import counted, row_counts

_TEXT = (
    "platform query_id query_text topic genre video_id video_title channel_title comment_id comment_text "
    "sentiment_label sentiment_backend sentiment_model"
).split()
_VIDEOS = {"videos_covered": "video_id"}
_COUNTS = "comment_like_count reply_count positive_hits negative_hits token_count".split()


def prepare_scored(df: DataFrame) -> DataFrame:
    """Mart input in one projection: text columns, counts and scores with 0 for missing, null or bad values."""
    published = as_timestamp(df, "comment_published_at")
    return df.select(
        col_or_null(df, "collection_date").cast("string").alias("collection_date"),
        published.alias("comment_published_at"),
        *[col_or_null(df, name).cast("string").alias(name) for name in _TEXT],
        *[int_or_zero(df, name).alias(name) for name in _COUNTS],
        double_or_zero(df, "sentiment_score").alias("sentiment_score"),
        double_or_zero(df, "sentiment_confidence").alias("sentiment_confidence"),
        double_or_zero(df, "sentiment_negative_prob", "negative_probability").alias("negative_probability"),
        double_or_zero(df, "sentiment_neutral_prob", "neutral_probability").alias("neutral_probability"),
        double_or_zero(df, "sentiment_positive_prob", "positive_probability").alias("positive_probability"),
        F.hour(published).cast("bigint").alias("comment_hour_24"),
        F.date_format(published, "EEEE").alias("weekday_name"),
    )


def _label_count(name: str) -> Column:
    return F.count_if(F.col("sentiment_label") == name).alias(f"{name}_comments")


def _distinct(name: str, unique: bool) -> Column:
    return F.count(name) if unique else F.count_distinct(name)


_AVERAGES = (
    "sentiment_score sentiment_confidence negative_probability neutral_probability positive_probability"
).split()
_LABELS = ("positive", "neutral", "negative")


def metric_columns(unique_ids: bool = False) -> list[Column]:
    """Aggregates every mart shares."""
    return [
        _distinct("comment_id", unique_ids).alias("comments_count"),
        *[_label_count(name) for name in _LABELS],
        *[F.round(F.avg(name), 4).alias(f"avg_{name}") for name in _AVERAGES],
        F.sum("comment_like_count").alias("total_comment_likes"),
        F.round(F.avg("comment_like_count"), 4).alias("avg_comment_likes"),
    ]


def _row_sums() -> dict[str, Column]:
    """What a comment row adds to a group: a row, its label, scores and likes."""
    labels = {f"{name}_comments": F.coalesce(F.col("sentiment_label") == name, F.lit(False)) for name in _LABELS}
    summed = {name: F.col(name) for name in [*_AVERAGES, "comment_like_count"]}
    return {"comment_rows": F.lit(1).cast("bigint"), **row_counts(**labels), **summed}


def _sums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mergeable state of rows with unique comment ids: counts and sums per combination of values, no averages."""
    ids = row_counts(comment_ids=F.col("comment_id").isNotNull())
    return counted(df, by, {}, {**_row_sums(), **ids})


def _metrics(summed: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The columns of a mart from counts and sums per key."""
    mean = lambda name: F.round(F.col(name) / F.col("comment_rows"), 4)
    return summed.select(
        *keys,
        *names,
        "comments_count",
        *[f"{name}_comments" for name in _LABELS],
        *[mean(name).alias(f"avg_{name}") for name in _AVERAGES],
        F.col("comment_like_count").alias("total_comment_likes"),
        mean("comment_like_count").alias("avg_comment_likes"),
    )


def _from_sums(states: DataFrame, keys: Sequence[str], distinct: dict[str, str]) -> DataFrame:
    """Metrics per key from such states, whatever finer values they are kept by; counted values must be among them."""
    again = {name: F.col(name) for name in [*_row_sums(), "comment_ids"]}
    out = counted(states, keys, distinct, again).withColumnRenamed("comment_ids", "comments_count")
    return _metrics(out, keys, list(distinct))


def _mart(
    df: DataFrame,
    keys: Sequence[str],
    distinct: dict[str, str] | None = None,
    unique_ids: bool = False,
    built_at: str | None = None,
    ratios: bool = True,
) -> DataFrame:
    """Group by the non-null keys; ``distinct`` maps result names to columns whose values are counted.

    Ratios divide label ROWS by distinct ids.
    """
    keyed = df
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    if distinct and unique_ids:
        out = _from_sums(_sums(keyed, list(dict.fromkeys([*keys, *distinct.values()]))), keys, distinct)
    elif distinct:
        out = _metrics(counted(keyed, keys, {"comments_count": "comment_id", **distinct}, _row_sums()), keys, list(distinct))
    else:
        out = keyed.groupBy(*keys).agg(*metric_columns(unique_ids))
    return _finished(out, built_at, ratios)


def _finished(out: DataFrame, built_at: str | None, ratios: bool = True) -> DataFrame:
    if ratios:
        out = out.withColumns(
            {
                "positive_ratio": ratio(F.col("positive_comments"), F.col("comments_count")),
                "negative_ratio": ratio(F.col("negative_comments"), F.col("comments_count")),
            }
        )
    return out if built_at is None else out.withColumn("built_at", F.lit(built_at))


def daily_summary(scored: DataFrame, unique_ids: bool = False, built_at: str | None = None) -> DataFrame:
    return _mart(prepare_scored(scored), ["collection_date", "topic", "genre"], None, unique_ids, built_at)


def video_summary(scored: DataFrame, unique_ids: bool = False, built_at: str | None = None) -> DataFrame:
    keys = ["collection_date", "topic", "genre", "video_id", "video_title", "channel_title"]
    return _mart(prepare_scored(scored), keys, None, unique_ids, built_at)


def topic_summary(scored: DataFrame, unique_ids: bool = False, built_at: str | None = None) -> DataFrame:
    distinct = {**_VIDEOS, "collection_dates_seen": "collection_date"}
    return _mart(prepare_scored(scored), ["topic", "genre"], distinct, unique_ids, built_at)


def daily_trend(scored: DataFrame, unique_ids: bool = False, built_at: str | None = None) -> DataFrame:
    return _mart(prepare_scored(scored), ["collection_date", "topic", "genre"], _VIDEOS, unique_ids, built_at)


def weekday_hour(scored: DataFrame, unique_ids: bool = False, built_at: str | None = None) -> DataFrame:
    """Comments by weekday name and hour of publication; rows without a time are left out."""
    published = prepare_scored(scored).filter(F.col("comment_published_at").isNotNull())
    keys = ["collection_date", "topic", "genre", "weekday_name", "comment_hour_24"]
    return _mart(published, keys, _VIDEOS, unique_ids, built_at, ratios=False)


def overview_kpis(scored: DataFrame, unique_ids: bool = False, built_at: str | None = None) -> DataFrame:
    distinct = {**_VIDEOS, "topics_covered": "topic", "genres_covered": "genre"}
    return _mart(prepare_scored(scored), ["collection_date", "platform"], distinct, unique_ids, built_at)


STATE_VALUES = ("collection_date", "platform", "topic", "genre", "video_id")


def day_states(scored: DataFrame, unique_ids: bool = True, built_at: str | None = None) -> DataFrame:
    """Sums per day, platform, topic, genre and video of comments with unique ids.

    Marts over any span of days, with their distinct counts, follow from these without reading comments again (see
    :func:`from_states`): a table as large as its days have videos.
    """
    if not unique_ids:
        raise ValueError("states need unique comment ids: merged counts could not tell repeats")
    out = _sums(prepare_scored(scored), STATE_VALUES)
    return out if built_at is None else out.withColumn("built_at", F.lit(built_at))


#: Marts that states of days give: keys and distinct counts.
STATE_MARTS = {
    "daily_summary": (("collection_date", "topic", "genre"), {}),
    "topic_summary": (("topic", "genre"), {**_VIDEOS, "collection_dates_seen": "collection_date"}),
    "daily_trend": (("collection_date", "topic", "genre"), _VIDEOS),
    "overview_kpis": (("collection_date", "platform"), {**_VIDEOS, "topics_covered": "topic", "genres_covered": "genre"}),
}


def from_states(states: DataFrame, mart: str, built_at: str | None = None) -> DataFrame:
    """One of ``STATE_MARTS`` from the states of days; the same rows as from the comments."""
    keys, distinct = STATE_MARTS[mart]
    keyed = states
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    return _finished(_from_sums(keyed, keys, distinct), built_at)


def period_summary(states: DataFrame, unit: str = "month", built_at: str | None = None) -> DataFrame:
    """Metrics per calendar ``unit`` (month, week, quarter, year), topic and genre, with the days and videos seen."""
    start = F.to_date(F.date_trunc(unit, as_date(states, "collection_date").cast("timestamp")))
    keyed = states.withColumn("period_start", F.date_format(start, "yyyy-MM-dd"))
    keys = ["period_start", "topic", "genre"]
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    return _finished(_from_sums(keyed, keys, {**_VIDEOS, "collection_dates_seen": "collection_date"}), built_at)


def comment_keywords(df: DataFrame, columns: Sequence[str | Column], stop_words: Sequence[str]) -> DataFrame:
    """One row per comment row and distinct keyword; only the named columns travel along."""
    words = F.explode(F.array_distinct(word_runs(F.col("comment_text")))).alias("keyword")
    return df.select(*columns, words).filter(is_keyword(F.col("keyword"), stop_words))


def flag_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_again``: whether the row's comment id occurs more than once in its group.

    Found by one aggregate over the ids alone, in the same plan. It lets keyword counts add up per keyword before the
    shuffle, because only repeated ids still have to be told apart per keyword; with distinct ids (the usual case) the
    joined side is empty.
    """
    names = [*keys, "comment_id"]
    repeated = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    side = repeated.select([F.col(n).alias(f"r_{n}") for n in names])
    joined = df.join(side, [F.col(n).eqNullSafe(F.col(f"r_{n}")) for n in names], "left")
    return joined.withColumn("_again", F.col("r_comment_id").isNotNull()).drop(*side.columns)


def distinct_comments(unique_ids: bool) -> Column:
    """Aggregate over flagged keyword rows: distinct comment ids, of which only repeated ones need a distinct."""
    if unique_ids:
        return F.count(F.lit(1))
    once = F.count_if(~F.col("_again"))
    return once + F.count_distinct(F.when(F.col("_again"), F.col("comment_id")))


def keyword_frequency(
    scored: DataFrame,
    top_n: int = 25,
    unique_ids: bool = False,
    built_at: str | None = None,
    stop_words: Sequence[str] = tuple(MART_STOP_WORDS),
) -> DataFrame:
    """The ``top_n`` keywords of each (date, topic, genre), null keys included, ties by keyword.

    Rows are counted per (group, keyword) before the shuffle (see ``flag_repeats``); the ranking keeps ``top_n``
    rows per group and task before its own shuffle, so no task sees a whole vocabulary of a large group.
    """
    keys = ["collection_date", "topic", "genre"]
    columns = [*keys, "comment_id", "sentiment_score", "comment_text"]
    df = prepare_scored(scored).withColumn("comment_id", F.coalesce("comment_id", F.lit("<NA>"))).select(*columns)
    flagged = df.withColumn("_again", F.lit(False)) if unique_ids else flag_repeats(df, keys)
    words = comment_keywords(flagged, [*keys, "comment_id", "_again", "sentiment_score"], stop_words)
    counted = words.groupBy(*keys, "keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"),
        distinct_comments(unique_ids).alias("distinct_comments"),
        F.round(F.avg("sentiment_score"), 4).alias("avg_sentiment_score"),
    )
    window = Window.partitionBy(*keys).orderBy(F.col("keyword_count").desc(), F.col("keyword"))
    top = counted.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= top_n).drop("_rank")
    return top if built_at is None else top.withColumn("built_at", F.lit(built_at))


def _or_unknown(df: DataFrame, name: str) -> Column:
    value = col_or_null(df, name).cast("string")
    return F.when(F.trim(F.coalesce(value, F.lit(""))) == "", F.lit("unknown")).otherwise(value)


def daily_topic_metrics(scored: DataFrame, unique_ids: bool = False, built_at: Column | None = None) -> DataFrame:
    """Metrics per day, topic and genre; the day is the first of collection, publication and processing date.

    Unlike the other marts, averages skip nulls and a blank topic or genre becomes ``unknown``.
    """
    probability = lambda cls: first_present(
        scored, (f"sentiment_{cls}_prob" if cls != "confidence" else "sentiment_confidence", f"{cls}_probability")
    )
    df = scored.select(
        F.coalesce(*[as_date(scored, n) for n in ("collection_date", "comment_published_at", "processed_at")]).alias(
            "metric_date"
        ),
        _or_unknown(scored, "topic").alias("topic"),
        _or_unknown(scored, "genre").alias("genre"),
        "comment_id",
        "video_id",
        "sentiment_label",
        first_present(scored, ["sentiment_score"]).alias("sentiment_score"),
        first_present(scored, ["sentiment_confidence"]).alias("confidence"),
        *[probability(cls).alias(cls) for cls in ("negative", "neutral", "positive")],
        int_or_zero(scored, "comment_like_count").alias("likes"),
        int_or_zero(scored, "reply_count").alias("replies"),
    ).filter(F.col("metric_date").isNotNull())
    mean = {"sentiment_score": "avg_sentiment_score", "confidence": "avg_sentiment_confidence", "likes": "avg_like_count"}
    mean |= {cls: f"avg_{cls}_probability" for cls in ("negative", "neutral", "positive")}
    total = {"likes": "total_like_count", "replies": "total_reply_count"}
    keys, videos = ["metric_date", "topic", "genre"], {"distinct_videos": "video_id"}
    labels = {f"{name}_comments": F.coalesce(F.col("sentiment_label") == name, F.lit(False)) for name in _LABELS}
    filled = {f"{name}_rows": F.col(name).isNotNull() for name in mean}
    sums = {**row_counts(**labels, **filled), **{name: F.col(name) for name in [*mean, "replies"]}}
    if unique_ids:
        sums |= row_counts(comment_count=F.col("comment_id").isNotNull())
        out = counted(df, keys, videos, sums)
    else:
        out = counted(df, keys, {"comment_count": "comment_id", **videos}, sums)
    out = out.select(
        *keys,
        "comment_count",
        *[f"{name}_comments" for name in _LABELS],
        *[F.round(F.col(name) / F.nullif(F.col(f"{name}_rows"), F.lit(0)), 4).alias(alias) for name, alias in mean.items()],
        *[F.col(name).alias(alias) for name, alias in total.items()],
        "distinct_videos",
    )
    return out if built_at is None else out.withColumn("built_at", built_at)


# Presentation order of each mart (dates first, weekdays from Monday).
_WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
MART_ORDER = {
    "daily_summary": ("collection_date", "genre", "topic"),
    "video_summary": ("collection_date", "genre", "topic", "video_title"),
    "topic_summary": ("genre", "topic"),
    "daily_trend": ("collection_date", "genre", "topic"),
    "weekday_hour": ("collection_date", "topic", "genre", "weekday_name", "comment_hour_24"),
    "keyword_frequency": ("collection_date", "genre", "topic", "-keyword_count", "keyword"),
    "overview_kpis": ("collection_date", "platform"),
    "daily_topic_metrics": ("metric_date", "genre", "topic"),
}


def weekday_number(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(day) for day in _WEEKDAYS]), name)


def in_order(df: DataFrame, mart: str) -> DataFrame:
    """Presentation order, for the outermost reader only (never before a write)."""
    sort = []
    for name in MART_ORDER[mart]:
        if name == "weekday_name":
            sort.append(weekday_number(F.col(name)))
        elif name.startswith("-"):
            sort.append(F.col(name[1:]).desc())
        else:
            sort.append(F.col(name))
    return df.orderBy(*sort)
