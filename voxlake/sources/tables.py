"""Table scans that tolerate absent tables, tiered fallback, and the mart bundle."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.contracts import CONTRACTS
from voxlake.functions.columns import as_date, as_timestamp, date_label

DEFAULT_FORMAT = "parquet"

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE")


def read_if_exists(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or ``None`` where nothing has been written yet."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() and error.getCondition().split(".")[0] in _ABSENT:
            return None
        raise


def read_contract(spark: SparkSession, root: str, key: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A contract table below ``root``; an absent table reads as an empty one."""
    contract = CONTRACTS[key]
    schema = contract.schema if fmt == "parquet" else None
    found = read_if_exists(spark, contract.path(root), fmt, schema)
    if found is None:
        return spark.createDataFrame([], contract.schema)
    return found.select([field.name for field in contract.schema])


def first_non_empty(readers: Sequence[Callable[[], DataFrame | None]]) -> DataFrame | None:
    """The first tier that can be read and has a row; each check reads one row only.

    A tier that cannot be read, be it absent, of another format or corrupt, is left out with a warning.
    """
    for read in readers:
        try:
            frame = read()
            if frame is not None and not frame.isEmpty():
                return frame
        except (PySparkException, Py4JJavaError) as error:
            warnings.warn(f"a tier cannot be read: {str(error).splitlines()[0]}", stacklevel=2)
    return None


def comment_level_source(spark: SparkSession, root: str, raw_json: str | None = None, fmt: str = DEFAULT_FORMAT):
    """Scored comments, else daily bronze, else the historical bronze table, else the raw files."""
    from voxlake.sources.documents import read_run_records

    tiers: list[Callable[[], DataFrame | None]] = [
        lambda key=key: read_if_exists(spark, CONTRACTS[key].path(root), fmt)
        for key in (
            "silver.youtube_comments_sentiment",
            "bronze.youtube_comments_daily_raw",
            "bronze.youtube_comments_raw",
        )
    ]
    if raw_json:
        tiers.append(lambda: read_run_records(spark, raw_json))
    return first_non_empty(tiers)


# The mart bundle, name -> (table, date columns, whether a label column is added).
_RUN = (("run_date",), True)
_MART = (("collection_date",), True)
BUNDLE = {
    "overview": ("gold.dashboard_overview_daily", *_RUN),
    "collection": ("gold.collection_daily_summary", *_RUN),
    "query": ("gold.query_performance_summary", *_RUN),
    "sentiment_daily_summary": ("gold.youtube_sentiment_daily_summary", *_MART),
    "sentiment_video_summary": ("gold.youtube_sentiment_video_summary", *_MART),
    "sentiment_topic_summary": ("gold.youtube_sentiment_topic_summary", ("built_at",), False),
    "sentiment_daily_trend": ("gold.youtube_sentiment_daily_trend", *_MART),
    "sentiment_weekday_hour_engagement": ("gold.youtube_sentiment_weekday_hour_engagement", *_MART),
    "sentiment_keyword_frequency": ("gold.youtube_sentiment_keyword_frequency", *_MART),
    "sentiment_overview_kpis": ("gold.youtube_sentiment_overview_kpis", *_MART),
    "predictive_forecast_summary": (
        "gold.youtube_comments_forecast_summary",
        ("history_start_date", "history_end_date", "built_at"),
        False,
    ),
    "predictive_forecast_7d": ("gold.youtube_comments_forecast_7d", ("forecast_date", "built_at"), False),
}


def with_dates(df: DataFrame, columns: Sequence[str], labels: bool) -> DataFrame:
    """Date columns parsed (bad text is null), each with a ``yyyy-MM-dd`` label column when asked for."""
    for name in columns:
        if name not in df.columns:
            continue
        if name == "built_at":
            df = df.withColumn(name, as_timestamp(df, name))
            continue
        df = df.withColumn(name, as_date(df, name))
        if labels:
            df = df.withColumn(f"{name}_label", date_label(F.col(name)))
    return df


def load_marts(
    spark: SparkSession, root: str, raw_json: str | None = None, fmt: str = DEFAULT_FORMAT
) -> dict[str, DataFrame]:
    """All marts as lazy frames, plus the comments under two names."""
    from voxlake.operators.silver import normalize_comments

    out = {
        name: with_dates(read_contract(spark, root, key, fmt), columns, labels)
        for name, (key, columns, labels) in BUNDLE.items()
    }
    comments = comment_level_source(spark, root, raw_json, fmt)
    if comments is None:
        comments = read_contract(spark, root, "silver.youtube_comments_sentiment", fmt)
    out["comments"] = out["sentiment_comments"] = normalize_comments(comments)
    return out
