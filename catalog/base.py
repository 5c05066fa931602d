"""Bindings of the driver's tables to the engine's inputs, in Spark and as SQL.

The driver has no comment table; these views give its tables that meaning. Scores are multiples of 1/1024 so that
sums are exact in both engines whatever the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query with its oracle."""

    def register(query: Query) -> Query:
        if name in CASES:
            raise ValueError(f"query {name} registered twice")
        CASES[name] = Case(query, sql)
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for queries that write before they read."""
    return scratch_path(spark, name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.select(
        [
            (F.round(c, digits) if t == "double" else F.col(c)).alias(c)
            for c, t in df.dtypes
        ]
    )


# ---------------------------------------------------------------- Spark views


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    score = F.floor(1024 * (F.col("value") - 50) / (F.col("value") + 50)) / 1024
    return e.select(
        "*",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        score.alias("sentiment_score"),
    ).withColumn("sentiment_label", _label(F.col("sentiment_score")))


def _label(score):
    return F.when(score > 0.2, "positive").when(score < -0.2, "negative").otherwise("neutral")


def engagement(spark: SparkSession, folder: str) -> DataFrame:
    e = scored_events(spark, folder)
    zero = F.lit(0.0)
    return e.select(
        F.col("event_id").cast("string").alias("comment_id"),
        F.col("event_type").alias("topic"),
        F.when(F.col("k") % 3 == 0, "tech_news").when(F.col("k") % 3 == 1, "sports").otherwise("music").alias("genre"),
        F.col("user_id").cast("string").alias("video_id"),
        F.concat(F.lit("video "), F.col("user_id")).alias("video_title"),
        F.concat(F.lit("channel_"), F.col("user_id") % 10).alias("channel_title"),
        F.when(F.col("user_id") % 2 == 0, "youtube").otherwise("mirror").alias("platform"),
        F.date_format("ts", "yyyy-MM-dd").alias("collection_date"),
        F.col("ts").alias("comment_published_at"),
        F.floor("value").alias("comment_like_count"),
        F.col("k").alias("reply_count"),
        "sentiment_score",
        "sentiment_label",
        (F.floor(1024 * F.col("value") / (F.col("value") + 100)) / 1024).alias("sentiment_confidence"),
        F.greatest(-F.col("sentiment_score"), zero).alias("negative_probability"),
        (1 - F.abs("sentiment_score")).alias("neutral_probability"),
        F.greatest(F.col("sentiment_score"), zero).alias("positive_probability"),
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    e = scored_events(spark, folder)
    joined = d.join(e, e["event_id"] == d["doc_id"] * 5, "left")
    return joined.select(
        F.col("doc_id").cast("string").alias("comment_id"),
        F.col("text").alias("comment_text"),
        F.col("source").alias("topic"),
        F.col("lang").alias("genre"),
        F.col("user_id").cast("string").alias("video_id"),
        F.concat(F.lit("video "), F.col("user_id"), F.lit(" of the "), "event_type", F.lit(" collection part "),
                 F.col("user_id")).alias("video_title"),
        F.concat(F.lit("channel_"), F.col("user_id") % 10).alias("channel_title"),
        F.col("event_type").alias("query_id"),
        F.concat(F.lit("All about "), "event_type").alias("query_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("collection_date"),
        F.col("ts").alias("comment_published_at"),
        F.floor("value").alias("comment_like_count"),
        F.col("k").alias("reply_count"),
        "sentiment_score",
        "sentiment_label",
        F.lit("youtube").alias("platform"),
    )


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query of a run; a run is a day of orders."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("videos_count"),
            F.count_if(F.col("l_returnflag") != "R").alias("comments_count"),
        )
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    joined = o.join(c, o["o_custkey"] == c["c_custkey"]).join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select(
        F.concat(F.lit("daily-"), day).alias("run_id"),
        day.alias("run_date"),
        day.alias("plan_date"),
        F.concat(F.lit("q"), F.col("o_custkey")).alias("query_id"),
        F.concat(F.lit("about "), "c_name").alias("query_text"),
        F.col("c_mktsegment").alias("topic"),
        F.col("o_orderpriority").alias("genre"),
        F.floor("o_totalprice").alias("expected_units"),
        F.coalesce("videos_count", F.lit(0)).alias("videos_count"),
        F.coalesce("comments_count", F.lit(0)).alias("comments_count"),
        F.concat(day, F.lit("T06:00:00")).alias("created_at"),
    )


def errors(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    returned = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    joined = returned.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat(F.lit("daily-"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("run_id"),
        F.concat(F.lit("q"), F.col("o_custkey")).alias("query_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
        F.concat(F.lit("part "), F.col("l_partkey"), F.lit(" returned")).alias("error"),
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.concat(F.lit("q"), F.col("p_partkey")).alias("query_id"),
        F.col("p_brand").alias("platform"),
        F.col("p_type").alias("topic"),
        F.when(F.col("p_size") % 2 == 0, "tools").otherwise("toys").alias("genre"),
        F.col("p_name").alias("query_text"),
        (F.col("p_size") % 10 + 1).alias("priority"),
        (F.col("p_size") % 4 != 0).alias("active"),
        F.lit("daily").alias("cadence"),
        (F.floor(F.col("p_retailprice") * 10) % 997 + 1).alias("expected_units"),
        (F.col("p_size") + 5).alias("search_results_limit"),
        (F.col("p_size") * 3).alias("comments_per_video_limit"),
        (F.col("p_size") % 35).alias("lookback_days"),
    )


def untidy(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records with the faults raw records have."""
    e = table(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k"))
    n = F.col("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    count = (
        F.when(n % 7 == 0, F.lit(None).cast("string"))
        .when(n % 7 == 1, "")
        .when(n % 7 == 2, "   ")
        .when(n % 7 == 3, "abc")
        .when(n % 7 == 4, "3.7")
        .when(n % 7 == 5, "  12 ")
        .otherwise(F.floor("value").cast("string"))
    )
    topic = (
        F.when(n % 11 == 0, F.lit(None).cast("string"))
        .when(n % 11 == 1, "")
        .when(n % 11 == 2, F.concat(F.lit(" \t"), "event_type", F.lit(" \n")))
        .otherwise(F.col("event_type"))
    )
    return e.select(
        F.concat(F.lit("daily-"), F.date_format("ts", "yyyyMMdd")).alias("run_folder"),
        (n + 1).alias("position"),
        F.when(n % 17 == 0, F.concat(F.lit("  q"), (F.col("user_id") % 40).cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.lit("q"), (F.col("user_id") % 40).cast("string")))
        .alias("query_id"),
        F.when(n % 3 == 0, F.lit(None).cast("string")).when(n % 3 == 1, "").otherwise(text("about ", "event_type"))
        .alias("query_text"),
        topic.alias("topic"),
        F.when(n % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("genre "), (F.col("k").cast("bigint") % 3).cast("string")))
        .alias("genre"),
        F.when(n % 13 == 0, "").otherwise(text("v", "user_id")).alias("video_id"),
        F.when(n % 2 == 0, text("video ", "user_id")).alias("video_title"),
        text("old title ", "user_id").alias("title"),
        F.concat(F.lit("channel "), (F.col("user_id") % 10).cast("string")).alias("channel_title"),
        F.when(n % 19 == 0, "").when(n % 19 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("c"), F.floor(n / 2).cast("string")))
        .alias("comment_id"),
        F.when(n % 29 == 0, "  ").otherwise(F.concat(F.lit("  "), "event_type", F.lit(" number "), "k", F.lit(" ")))
        .alias("comment_text"),
        count.alias("like_count"),
        F.when(n % 7 == 0, "5").alias("comment_like_count"),
        F.when(n % 23 == 0, "not a date").otherwise(iso).alias("comment_published_at"),
        F.when(n % 31 == 0, F.lit(None).cast("string")).otherwise(iso).alias("comment_updated_at"),
        F.col("k").alias("reply_count"),
        F.when(n % 4 == 0, text("user ", "user_id")).alias("author_display_name"),
        text("name ", "user_id").alias("author_name"),
        F.when(n % 37 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("collection_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
        F.concat(F.lit("daily-"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("plan_date"),
    )


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest per day of events; its counts are text, as raw JSON may have them."""
    u = untidy(spark, folder)
    day = F.min("ingested_at")
    path = F.concat(F.lit("raw/"), F.col("run_folder"))
    return u.groupBy("run_folder").agg(
        day.alias("generated_at"), F.count(F.lit(1)).cast("string").alias("total_comments_collected")
    ).select(
        "run_folder",
        F.col("run_folder").alias("run_id"),
        "generated_at",
        F.concat(path, F.lit("/manifest.json")).alias("manifest_path"),
        F.concat(path, F.lit("/normalized_comments.json")).alias("normalized_comments_path"),
        F.lit("plans/plan.json").alias("plan_path"),
        F.lit("40").alias("queries_executed"),
        "total_comments_collected",
        F.lit(None).cast("string").alias("error_count"),
    )


def plan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Plan attributes of the queries that untidy records name."""
    c = table(spark, folder, "customer")
    return c.groupBy((F.col("c_custkey") % 60).alias("n")).agg(
        F.min("c_mktsegment").alias("topic"), F.count(F.lit(1)).alias("units")
    ).select(
        F.concat(F.lit("q"), F.col("n").cast("string")).alias("query_id"),
        F.concat(F.lit("plan text "), F.col("n").cast("string")).alias("query_text"),
        F.when(F.col("n") % 2 == 0, F.col("topic")).alias("topic"),
        F.lit("plan genre").alias("genre"),
        F.lit("daily").alias("cadence"),
        (F.col("n") % 10).cast("string").alias("priority"),
        F.col("units").cast("string").alias("expected_units"),
        F.lit("en").alias("language_target"),
    )


def threads(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as nested JSON threads: the first line is the comment, further lines its replies."""
    c = table(spark, folder, "conversations")
    key = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    lines = F.split("text", "\n")
    language = F.when(
        F.col("turn") % 2 == 0, F.parse_json(F.lit('["Other", {"LangDetect": "en"}]'))
    ).otherwise(F.parse_json(F.lit('["Other"]')))

    def comment(text, identity, like):
        return F.struct(
            identity.alias("comment_id"),
            F.concat(F.lit("author-"), F.col("role")).alias("author_channel_id"),
            F.col("role").alias("author_name"),
            text.alias("text"),
            language.alias("detected_language"),
            like.alias("like_count"),
            F.lit("2024-01-01T00:00:00Z").alias("published_at"),
        )

    replies = F.transform(
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
        lambda line, i: comment(
            line, F.when(i % 5 != 4, F.concat(key, F.lit("-r"), i.cast("string"))).otherwise(""), i
        ),
    )
    document = F.struct(
        F.lit("x1").alias("_id"),
        F.concat(F.lit("v"), F.col("conv_id").cast("string")).alias("video_id"),
        key.alias("thread_id"),
        F.col("role").alias("language_target"),
        F.parse_json(F.lit('{"$date": "2024-02-03T04:05:06Z"}')).alias("fetched_at"),
        F.col("turn").alias("total_reply_count"),
        comment(F.element_at(lines, 1), F.concat(key, F.lit("-top")), F.col("turn")).alias("top_level_comment"),
        replies.alias("replies"),
        F.struct(
            F.struct(
                F.concat(F.lit("ch"), F.col("conv_id").cast("string")).alias("channelId"),
                F.struct(F.struct(F.col("role").alias("authorDisplayName")).alias("snippet")).alias("topLevelComment"),
            ).alias("snippet")
        ).alias("raw_snippet"),
    )
    return c.select(F.to_json(document).alias("document"))


# ---------------------------------------------------------------- SQL views

VIEWS = {
    "ev": """
  SELECT *, CASE WHEN sentiment_score > 0.2 THEN 'positive' WHEN sentiment_score < -0.2 THEN 'negative'
         ELSE 'neutral' END AS sentiment_label
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
               floor(1024 * (value - 50) / (value + 50)) / 1024 AS sentiment_score FROM events)""",
    "eng": """
  SELECT CAST(event_id AS VARCHAR) AS comment_id, event_type AS topic,
    CASE k % 3 WHEN 0 THEN 'tech_news' WHEN 1 THEN 'sports' ELSE 'music' END AS genre,
    CAST(user_id AS VARCHAR) AS video_id, 'video ' || user_id AS video_title,
    'channel_' || (user_id % 10) AS channel_title,
    CASE user_id % 2 WHEN 0 THEN 'youtube' ELSE 'mirror' END AS platform,
    strftime(ts, '%Y-%m-%d') AS collection_date, ts AS comment_published_at,
    CAST(floor(value) AS BIGINT) AS comment_like_count, k AS reply_count, sentiment_score, sentiment_label,
    floor(1024 * value / (value + 100)) / 1024 AS sentiment_confidence,
    greatest(-sentiment_score, 0.0::DOUBLE) AS negative_probability, 1 - abs(sentiment_score) AS neutral_probability,
    greatest(sentiment_score, 0.0::DOUBLE) AS positive_probability
  FROM ev""",
    "com": """
  SELECT CAST(d.doc_id AS VARCHAR) AS comment_id, d.text AS comment_text, d.source AS topic, d.lang AS genre,
    CAST(e.user_id AS VARCHAR) AS video_id,
    'video ' || e.user_id || ' of the ' || e.event_type || ' collection part ' || e.user_id AS video_title,
    'channel_' || (e.user_id % 10) AS channel_title,
    e.event_type AS query_id, 'All about ' || e.event_type AS query_text,
    strftime(e.ts, '%Y-%m-%d') AS collection_date, e.ts AS comment_published_at,
    CAST(floor(e.value) AS BIGINT) AS comment_like_count, e.k AS reply_count, e.sentiment_score, e.sentiment_label,
    'youtube' AS platform
  FROM documents d LEFT JOIN ev e ON e.event_id = d.doc_id * 5""",
    "summ": """
  SELECT 'daily-' || day AS run_id, day AS run_date, day AS plan_date, 'q' || o_custkey AS query_id,
    'about ' || c_name AS query_text, c_mktsegment AS topic, o_orderpriority AS genre,
    CAST(floor(o_totalprice) AS BIGINT) AS expected_units, coalesce(videos_count, 0) AS videos_count,
    coalesce(comments_count, 0) AS comments_count, day || 'T06:00:00' AS created_at
  FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
  JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS videos_count, count(*) FILTER (l_returnflag <> 'R') AS comments_count
             FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "errs": """
  SELECT 'daily-' || strftime(o_orderdate, '%Y-%m-%d') AS run_id, 'q' || o_custkey AS query_id,
    l_orderkey * 10 + l_linenumber AS position, 'part ' || l_partkey || ' returned' AS error
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "reg": """
  SELECT 'q' || p_partkey AS query_id, p_brand AS platform, p_type AS topic,
    CASE p_size % 2 WHEN 0 THEN 'tools' ELSE 'toys' END AS genre, p_name AS query_text,
    p_size % 10 + 1 AS priority, p_size % 4 <> 0 AS active, 'daily' AS cadence,
    CAST(floor(p_retailprice * 10) AS BIGINT) % 997 + 1 AS expected_units, p_size + 5 AS search_results_limit,
    p_size * 3 AS comments_per_video_limit, p_size % 35 AS lookback_days
  FROM part""",
    "unt": r"""
  SELECT 'daily-' || strftime(ts, '%Y%m%d') AS run_folder, n + 1 AS position,
    CASE WHEN n % 17 = 0 THEN '  q' || (user_id % 40) || ' ' ELSE 'q' || (user_id % 40) END AS query_id,
    CASE n % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'about ' || event_type END AS query_text,
    CASE n % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || chr(9) || event_type || ' ' || chr(10)
      ELSE event_type END AS topic,
    CASE n % 5 WHEN 0 THEN NULL ELSE 'genre ' || (k % 3) END AS genre,
    CASE n % 13 WHEN 0 THEN '' ELSE 'v' || user_id END AS video_id,
    CASE n % 2 WHEN 0 THEN 'video ' || user_id END AS video_title, 'old title ' || user_id AS title,
    'channel ' || (user_id % 10) AS channel_title,
    CASE n % 19 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'c' || CAST(floor(n / 2) AS BIGINT) END AS comment_id,
    CASE n % 29 WHEN 0 THEN '  ' ELSE '  ' || event_type || ' number ' || k || ' ' END AS comment_text,
    CASE n % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN 'abc' WHEN 4 THEN '3.7'
      WHEN 5 THEN '  12 ' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS like_count,
    CASE n % 7 WHEN 0 THEN '5' END AS comment_like_count,
    CASE n % 23 WHEN 0 THEN 'not a date' ELSE iso END AS comment_published_at,
    CASE n % 31 WHEN 0 THEN NULL ELSE iso END AS comment_updated_at, CAST(k AS VARCHAR) AS reply_count,
    CASE n % 4 WHEN 0 THEN 'user ' || user_id END AS author_display_name, 'name ' || user_id AS author_name,
    CASE n % 37 WHEN 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d') END AS collection_date, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at,
    'daily-' || strftime(ts, '%Y%m%d') AS run_id, strftime(ts, '%Y-%m-%d') AS plan_date
  FROM (SELECT *, event_id AS n, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM ev)""",
    "man": """
  SELECT run_folder, run_folder AS run_id, min(ingested_at) AS generated_at,
    'raw/' || run_folder || '/manifest.json' AS manifest_path,
    'raw/' || run_folder || '/normalized_comments.json' AS normalized_comments_path,
    'plans/plan.json' AS plan_path, count(*) AS total_comments_collected
  FROM unt GROUP BY 1""",
    "plan": """
  SELECT 'q' || n AS query_id, 'plan text ' || n AS query_text, CASE n % 2 WHEN 0 THEN topic END AS topic,
    'plan genre' AS genre, 'daily' AS cadence, CAST(n % 10 AS VARCHAR) AS priority,
    CAST(units AS VARCHAR) AS expected_units, 'en' AS language_target
  FROM (SELECT c_custkey % 60 AS n, min(c_mktsegment) AS topic, count(*) AS units FROM customer GROUP BY 1)""",
    "thr": """
  SELECT conv_id, turn, role, conv_id || '-' || turn AS thread_id, string_split(text, chr(10)) AS lines,
    len(string_split(text, chr(10))) - 1 AS n_replies FROM conversations""",
    "thc": """
  SELECT t.*, i.idx - 1 AS place, lines[i.idx] AS line,
    CASE WHEN i.idx = 1 THEN thread_id || '-top' WHEN (i.idx - 2) % 5 <> 4 THEN thread_id || '-r' || (i.idx - 2)
         ELSE '' END AS comment_id,
    CASE WHEN i.idx = 1 THEN turn ELSE i.idx - 2 END AS likes
  FROM thr t, unnest(range(1, n_replies + 2)) AS i(idx)""",
}
NEEDS = {"eng": ["ev"], "com": ["ev"], "unt": ["ev"], "man": ["unt"], "thc": ["thr"]}


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for needed in [*_ordered(NEEDS.get(name, [])), name]:
            if needed not in out:
                out.append(needed)
    return out


def view(name: str, body: str, *needs: str) -> str:
    """Add a derived SQL view."""
    VIEWS[name] = body
    NEEDS[name] = list(needs)
    return name


def sql(select: str, *views: str, recursive: bool = False) -> str:
    """A query over the named views."""
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]}\n)" for name in _ordered(list(views)))
    head = "WITH RECURSIVE " if recursive else "WITH "
    return f"{head}{ctes}\n{select}" if ctes else select


def display_sql(expr: str) -> str:
    pieces = f"regexp_extract_all(replace({expr}, '_', ' '), '\\p{{L}}+|[^\\p{{L}}]+')"
    return f"array_to_string(list_transform({pieces}, lambda x: upper(x[1]) || lower(x[2:])), '')"


def slug_sql(expr: str, length: int = 40) -> str:
    joined = f"trim(regexp_replace(lower({expr}), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"coalesce(nullif(trim(substr({joined}, 1, {length}), '_'), ''), 'custom')"


WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def text_sql(expr: str, default: str = "''") -> str:
    return f"coalesce(nullif(trim({expr}, {WS}), ''), {default})"


def int_sql(expr: str, default: str = "0") -> str:
    return f"coalesce(CAST(trunc(TRY_CAST(trim({expr}) AS DOUBLE)) AS BIGINT), {default})"


METRICS = """
  count(DISTINCT comment_id) AS comments_count,
  count(*) FILTER (sentiment_label = 'positive') AS positive_comments,
  count(*) FILTER (sentiment_label = 'neutral') AS neutral_comments,
  count(*) FILTER (sentiment_label = 'negative') AS negative_comments,
  round(avg(sentiment_score), 4) AS avg_sentiment_score,
  round(avg(sentiment_confidence), 4) AS avg_sentiment_confidence,
  round(avg(negative_probability), 4) AS avg_negative_probability,
  round(avg(neutral_probability), 4) AS avg_neutral_probability,
  round(avg(positive_probability), 4) AS avg_positive_probability,
  CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes,
  round(avg(comment_like_count), 4) AS avg_comment_likes"""
RATIOS = """
  round(count(*) FILTER (sentiment_label = 'positive') / greatest(count(DISTINCT comment_id), 1), 4) AS positive_ratio,
  round(count(*) FILTER (sentiment_label = 'negative') / greatest(count(DISTINCT comment_id), 1), 4) AS negative_ratio"""
