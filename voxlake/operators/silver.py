"""Curated comments: union of bronze inputs, typing, trimming, latest version per comment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.contracts import CONTRACTS
from voxlake.functions.columns import as_date, as_timestamp, col_or_null, double_or_zero, int_or_zero


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Filtering ``row_number() = 1`` makes Spark keep one row per key and input partition before the shuffle, so a
    key with a third of all rows sends only one row per task to its reducer. Equal order values are settled by a
    hash of the whole row, which does not depend on the input order.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*plain))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


# Spark drops rows beyond a fixed row_number limit before the shuffle up to this limit (its default threshold).
_PUSHED_LIMIT = 1000


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: Column | int) -> DataFrame:
    """The first ``limit`` rows of each group; the limit may differ per row of a group-constant column.

    Small fixed limits are cut before the shuffle by Spark itself. Otherwise the rows are ranked in two steps, first
    within the input partitions, so a group with a third of all rows is sorted by as many tasks as read it and only the
    survivors of each meet. The first rows of a group are among the first rows of its parts, so nothing is lost.
    """
    bound = limit if isinstance(limit, Column) else F.lit(limit)
    steps = [list(group)]
    ranked = df
    if isinstance(limit, Column) or limit > _PUSHED_LIMIT:
        ranked = df.withColumn("_salt", F.spark_partition_id())
        steps.insert(0, [*group, "_salt"])
    for keys in steps:
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = ranked.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= bound)
    return ranked.drop("_n", "_salt")


def union_bronze(inputs: dict[str, DataFrame | None]) -> DataFrame:
    """Union by column name of those bronze tables that exist, tagged with their name in ``source_table``."""
    frames = [df.withColumn("source_table", F.lit(name)) for name, df in inputs.items() if df is not None]
    if not frames:
        raise FileNotFoundError(f"no bronze input found among {', '.join(inputs)}")
    names = list(dict.fromkeys(name for df in frames for name in df.columns))
    wide = [df.select([col_or_null(df, name, _type_of(name, frames)).alias(name) for name in names]) for df in frames]
    return reduce(DataFrame.unionAll, wide)


def _type_of(name: str, frames: Sequence[DataFrame]) -> str:
    """The type of a column in the first frame that has it."""
    return next(kind for df in frames for column, kind in df.dtypes if column == name)


def curate(bronze: DataFrame) -> DataFrame:
    """Typed and trimmed silver columns in one projection; columns the input lacks are null."""
    out = []
    for field in CONTRACTS["silver.youtube_comments_silver"].schema:
        if field.name == "processed_at":
            continue
        if isinstance(field.dataType, T.DateType):
            column = as_date(bronze, field.name)
        elif isinstance(field.dataType, T.TimestampType):
            column = as_timestamp(bronze, field.name)
        elif isinstance(field.dataType, T.StringType):
            column = F.trim(col_or_null(bronze, field.name).cast("string"))
        else:
            column = col_or_null(bronze, field.name).try_cast(field.dataType)
        out.append(column.alias(field.name))
    return bronze.select(out)


def has_required_fields(df: DataFrame) -> DataFrame:
    """Rows with a non-blank comment id and text."""
    return df.filter((F.trim("comment_id") != "") & (F.trim("comment_text") != ""))


def latest_versions(df: DataFrame) -> DataFrame:
    """One row per comment: last updated, then last published, then last ingested."""
    order = [
        F.col(name).desc_nulls_last() for name in ("comment_updated_at", "comment_published_at", "ingested_at")
    ]
    return newest_per_key(df, ["comment_id"], order)


def build_silver(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Bronze rows to curated, deduplicated comments."""
    silver = latest_versions(has_required_fields(curate(bronze)))
    return silver if processed_at is None else silver.withColumn("processed_at", processed_at)


# Names a comment-level source may use, and what they become.
_RENAMES = {
    "text": "comment_text",
    "published_at": "comment_published_at",
    "fetched_at": "collected_at",
    "source_run_id": "run_id",
    "like_count": "comment_like_count",
    "author_name": "author_display_name",
}
_TEXT_DEFAULTS = (
    "run_id query_id query_text topic genre video_id video_title channel_title comment_id comment_text "
    "sentiment_label"
).split()


def normalize_comments(comments: DataFrame) -> DataFrame:
    """Comment rows of any tier in one shape: old names filled in, defaults, hour and weekday derived."""
    df = comments
    for old, new in _RENAMES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumn(new, F.col(old))
    published = as_timestamp(df, "comment_published_at")
    fresh: dict[str, Column] = {
        name: F.lit(None).cast("string") for name in _TEXT_DEFAULTS if name not in df.columns
    }
    if "platform" not in df.columns:
        fresh["platform"] = F.lit("youtube")
    fresh["comment_published_at"] = published
    if "collection_date" not in df.columns:
        fresh["collection_date"] = F.date_format(published, "yyyy-MM-dd")
    fresh["comment_like_count"] = int_or_zero(df, "comment_like_count")
    fresh["reply_count"] = int_or_zero(df, "reply_count")
    fresh["sentiment_score"] = double_or_zero(df, "sentiment_score")
    fresh["comment_hour_24"] = F.hour(published).cast("bigint")
    fresh["weekday_name"] = F.date_format(published, "EEEE")
    return df.withColumns(fresh)


def keep_last(df: DataFrame, keys: Sequence[str] = ("comment_id",)) -> DataFrame:
    """The last ingested row of each key, of these the last updated, then the last published.

    Spark has no file order, so the order is explicit; rows equal in all that differ by a hash of the row.
    """
    times = ("ingested_at", "comment_updated_at", "comment_published_at")
    return newest_per_key(df, keys, [F.col(name).desc_nulls_last() for name in times if name in df.columns])


__all__ = [
    "build_silver",
    "curate",
    "has_required_fields",
    "keep_last",
    "latest_versions",
    "newest_per_key",
    "normalize_comments",
    "union_bronze",
]
