"""Facet filters, query scope, and mart filters that follow the comment selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions.columns import as_date, as_timestamp, present
from voxlake.functions.text import normalized

Day = str | dt.date


@dataclass(frozen=True)
class Facets:
    """Selected values; an empty list selects everything. The date range includes both days."""

    topics: Sequence[str] = field(default_factory=tuple)
    genres: Sequence[str] = field(default_factory=tuple)
    statuses: Sequence[str] = field(default_factory=tuple)
    start: Day | None = None
    end: Day | None = None


def _day(value: Day) -> Column:
    return F.to_date(F.lit(str(value)))


def day_bounds(start: Day | None, end: Day | None) -> tuple[Column | None, Column | None]:
    """Half-open UTC timestamp bounds of an inclusive day range."""
    low = None if start is None else _day(start).cast("timestamp")
    high = None if end is None else F.date_add(_day(end), 1).cast("timestamp")
    return low, high


def selected(df: DataFrame, values: dict[str, Sequence[str]]) -> DataFrame:
    for name, wanted in values.items():
        if wanted and name in df.columns:
            df = df.filter(F.col(name).isin(list(wanted)))
    return df


def filter_runs(df: DataFrame, facets: Facets) -> DataFrame:
    """Run-level rows by facets; both run days included."""
    df = selected(df, {"topic": facets.topics, "genre": facets.genres, "collection_status": facets.statuses})
    if "run_date" in df.columns:
        run_date = as_date(df, "run_date")
        if facets.start is not None:
            df = df.filter(run_date >= _day(facets.start))
        if facets.end is not None:
            df = df.filter(run_date <= _day(facets.end))
    return df


def filter_comments(df: DataFrame, facets: Facets) -> DataFrame:
    """Comment rows by facets and a half-open range of the publication time."""
    df = selected(df, {"topic": facets.topics, "genre": facets.genres})
    return _in_range(df, "comment_published_at", facets)


def _in_range(df: DataFrame, name: str, facets: Facets) -> DataFrame:
    if name not in df.columns:
        return df
    low, high = day_bounds(facets.start, facets.end)
    moment = as_timestamp(df, name)
    if low is not None:
        df = df.filter(moment >= low)
    if high is not None:
        df = df.filter(moment < high)
    return df


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def exact_mask(df: DataFrame, query: str) -> Column:
    """Topic or genre equals the query."""
    return _any([normalized(F.col(name)) == query for name in present(df, ("topic", "genre"))])


def query_text_mask(df: DataFrame, query: str) -> Column:
    """The query occurs literally in the query text."""
    return _any([F.contains(normalized(F.col(n)), F.lit(query)) for n in present(df, ("query_text",))])


def alias_mask(df: DataFrame, topic: str | None, genre: str | None) -> Column:
    """Topic or genre equals what the query was resolved to."""
    wanted = {"topic": topic, "genre": genre}
    return _any([normalized(F.col(n)) == v.lower() for n, v in wanted.items() if v and n in df.columns])


def scope_mode(
    frames: Sequence[DataFrame], query: str, topic: str | None = None, genre: str | None = None
) -> str | None:
    """How the query applies: exact, text, alias or not at all; chosen once for all frames.

    Each frame is reduced to two flags in one aggregate; only those reach the driver.
    """
    found = {"exact_topic_or_genre": False, "query_text": False}
    for df in frames:
        flags = df.agg(
            F.coalesce(F.bool_or(exact_mask(df, query)), F.lit(False)).alias("exact_topic_or_genre"),
            F.coalesce(F.bool_or(query_text_mask(df, query)), F.lit(False)).alias("query_text"),
        ).first()
        for mode in found:
            found[mode] = found[mode] or flags[mode]
        if found["exact_topic_or_genre"]:
            break
    for mode, hit in found.items():
        if hit:
            return mode
    return "alias_context" if topic or genre else None


def in_scope(df: DataFrame, mode: str | None, query: str, topic: str | None, genre: str | None) -> DataFrame:
    """The rows the chosen mode selects; without a mode all rows stay."""
    if mode == "exact_topic_or_genre":
        return df.filter(exact_mask(df, query))
    if mode == "query_text":
        return df.filter(query_text_mask(df, query))
    if mode == "alias_context":
        return df.filter(alias_mask(df, topic, genre))
    return df


def apply_filters(
    collection: DataFrame,
    queries: DataFrame,
    facets: Facets,
    comments: DataFrame | None = None,
    analysis_query: str = "",
    topic: str | None = None,
    genre: str | None = None,
) -> dict[str, DataFrame]:
    """Filtered run rows, query rows and (when given) comments.

    ``topic`` and ``genre`` are what the analysis query was resolved to by the alias dictionary.
    """
    frames = {
        "collection": filter_runs(collection, Facets(facets.topics, facets.genres, (), facets.start, facets.end)),
        "queries": filter_runs(queries, facets),
    }
    if comments is not None:
        frames["comments"] = filter_comments(comments, facets)
    query = analysis_query.strip().lower()
    if not query:
        return frames
    order = [frames[name] for name in ("comments", "collection", "queries") if name in frames]
    mode = scope_mode(order, query, topic, genre)
    return {name: in_scope(df, mode, query, topic, genre) for name, df in frames.items()}


def _followed(df: DataFrame, comments: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose values all occur in the selected comments; one semi join per column.

    The distinct value lists stay in Spark, whatever their length; nothing selected means nothing kept.
    """
    for name in names:
        if name in df.columns and name in comments.columns:
            values = comments.select(F.col(name).cast("string").alias("_value")).distinct()
            df = df.join(values, F.col(name).cast("string") == F.col("_value"), "left_semi")
    return df


def filter_mart(
    df: DataFrame, facets: Facets, comments: DataFrame | None = None, date_column: str | None = "collection_date"
) -> DataFrame:
    """A mart by facets, half-open day range, and the topics, genres and videos of the selected comments.

    Marts over all dates have no date to filter on: pass ``date_column=None``.
    """
    df = selected(df, {"topic": facets.topics, "genre": facets.genres})
    if date_column:
        df = _in_range(df, date_column, facets)
    return df if comments is None else _followed(df, comments, ("topic", "genre", "video_id"))


def filter_marts(marts: dict[str, DataFrame], facets: Facets, comments: DataFrame | None = None):
    """All sentiment marts of the bundle, filtered alike."""
    return {
        name: filter_mart(df, facets, comments, None if name == "sentiment_topic_summary" else "collection_date")
        for name, df in marts.items()
        if name.startswith("sentiment_") and name != "sentiment_comments"
    }


def filter_forecasts(summary: DataFrame, forecast: DataFrame, comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forecast tables restricted to the topics and genres of the selected comments."""
    names = ("topic", "genre")
    return _followed(summary, comments, names), _followed(forecast, comments, names)


def value_pool(frames: Sequence[DataFrame], name: str) -> DataFrame:
    """Distinct non-null values of a column over several frames (each made distinct before the union)."""
    parts = [df.select(F.col(name).cast("string").alias(name)).distinct() for df in frames if name in df.columns]
    union = reduce(lambda a, b: a.union(b), parts)
    return union.filter(F.col(name).isNotNull()).distinct()


def date_span(df: DataFrame, name: str) -> DataFrame:
    day = as_date(df, name)
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))
