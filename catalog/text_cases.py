"""Text analytics, scoring, and column functions over untidy values."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    WS,
    case,
    comments,
    display_sql,
    engagement,
    int_sql,
    registry,
    rounded,
    scratch,
    slug_sql,
    sql,
    summaries,
    text_sql,
    untidy,
    view,
)
from voxlake.contracts import CONTRACTS, align
from voxlake.functions import columns as C
from voxlake.functions import numeric as N
from voxlake.functions import sentiment as S
from voxlake.functions import text as X
from voxlake.operators import marts, scoring, silver
from voxlake.plans import jobs
from voxlake.sinks.tables import write_contract
from voxlake.sources.tables import read_contract, with_dates

# The test corpus hardly contains the default lexicon, so the queries bind frequent words of it.
LEXICON = S.Lexicon(
    positive=("that", "with", "der", "la", "best"),
    negative=("this", "das", "que", "le"),
    negations=("no", "in", "the", "un"),
    threshold=0.01,
)


def _list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


view(
    "lex_tokens",
    """SELECT comment_id, topic, collection_date, genre, comment_like_count,
    regexp_extract_all(replace(lower(comment_text), '’', ''''), '[a-z'']+') AS tokens FROM com""",
    "com",
)
view(
    "lex_hits",
    f"""SELECT comment_id, collection_date, topic, genre, comment_like_count, len(tokens) AS token_count,
    len(list_filter(range(1, len(tokens) + 1), lambda i: (tokens[i] IN {_list(LEXICON.positive)}
        AND NOT coalesce(tokens[i - 1] IN {_list(LEXICON.negations)}, false))
      OR (tokens[i] IN {_list(LEXICON.negative)} AND coalesce(tokens[i - 1] IN {_list(LEXICON.negations)}, false))))
      AS positive_hits,
    len(list_filter(range(1, len(tokens) + 1), lambda i: (tokens[i] IN {_list(LEXICON.negative)}
        AND NOT coalesce(tokens[i - 1] IN {_list(LEXICON.negations)}, false))
      OR (tokens[i] IN {_list(LEXICON.positive)} AND coalesce(tokens[i - 1] IN {_list(LEXICON.negations)}, false))))
      AS negative_hits
  FROM (SELECT comment_id, collection_date, topic, genre, comment_like_count,
    CASE WHEN len(tokens) > 0 THEN tokens ELSE [] END AS tokens FROM lex_tokens)""",
    "lex_tokens",
)
view(
    "lex",
    """SELECT *, round(raw, 4) AS sentiment_score,
    CASE WHEN raw > 0.01 THEN 'positive' WHEN raw < -0.01 THEN 'negative' ELSE 'neutral' END AS sentiment_label
  FROM (SELECT *, (positive_hits - negative_hits) / greatest(token_count, 1) AS raw FROM lex_hits)""",
    "lex_hits",
)


@case(
    "lexicon_sentiment",
    sql(
        "SELECT comment_id, sentiment_score, sentiment_label, positive_hits, negative_hits, token_count FROM lex",
        "lex",
    ),
)
def _lexicon(spark, d):
    scored = scoring.score_with_lexicon(comments(spark, d), LEXICON)
    return scored.select(
        "comment_id", "sentiment_score", "sentiment_label", "positive_hits", "negative_hits", "token_count"
    )


@case(
    "daily_sentiment_from_texts",
    sql(
        """SELECT collection_date, topic, genre, count(DISTINCT comment_id) AS comments_count,
    count(*) FILTER (sentiment_label = 'positive') AS positive_comments,
    count(*) FILTER (sentiment_label = 'neutral') AS neutral_comments,
    count(*) FILTER (sentiment_label = 'negative') AS negative_comments,
    CAST(sum(comment_like_count) AS BIGINT) AS total_comment_likes
  FROM lex GROUP BY collection_date, topic, genre""",
        "lex",
    ),
)
def _flagship(spark, d):
    curated = silver.build_silver(comments(spark, d))
    scored = scoring.score_with_lexicon(curated, LEXICON)
    mart = marts.daily_summary(scored)
    return mart.select(
        "collection_date",
        "topic",
        "genre",
        "comments_count",
        "positive_comments",
        "neutral_comments",
        "negative_comments",
        "total_comment_likes",
    )


@case(
    "keyword_tokens",
    sql(
        f"""SELECT doc_id, len(kept) AS keywords, array_to_string(kept, ' ') AS joined FROM (
    SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'),
      lambda w: len(w) >= 3 AND NOT regexp_full_match(w, '[0-9]+') AND w NOT IN {_list(X.MART_STOP_WORDS)}) AS kept
    FROM documents)"""
    ),
)
def _tokens(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = docs.select("doc_id", X.keyword_tokens(F.col("text")).alias("kept"))
    return kept.select("doc_id", F.size("kept").cast("bigint").alias("keywords"), F.array_join("kept", " ").alias("joined"))


@case(
    "whitespace_token_count",
    sql("SELECT doc_id, len(regexp_extract_all(text, '[^\\t\\n\\f\\r\\x0b ]+')) AS tokens FROM documents"),
)
def _count(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", X.token_count(F.col("text")).cast("bigint").alias("tokens"))


_LABELS = {"click": "LABEL_2", "error": " negativ ", "purchase": "Positive!", "signup": "label_1"}


@case(
    "classifier_label_normalisation",
    sql(
        """SELECT event_id, CASE event_type WHEN 'click' THEN 'positive' WHEN 'error' THEN 'negative'
    WHEN 'purchase' THEN 'positive' ELSE 'neutral' END AS label FROM ev""",
        "ev",
    ),
)
def _label_names(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    raw = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in _LABELS.items()], F.lit("other"))
    return e.select("event_id", S.normalize_label(raw).alias("label"))


@case(
    "probabilities_to_result",
    sql(
        """SELECT event_id, round(p - n, 4) AS sentiment_score,
    CASE WHEN p >= u AND p >= n THEN 'positive' WHEN u >= n THEN 'neutral' ELSE 'negative' END AS sentiment_label,
    round(greatest(p, u, n), 4) AS sentiment_confidence, round(p, 4) AS positive_probability,
    round(u, 4) AS neutral_probability, round(n, 4) AS negative_probability
  FROM (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 0.0::DOUBLE ELSE p END AS p,
    CASE WHEN event_id % 6 = 0 THEN 1.0::DOUBLE ELSE u END AS u,
    CASE WHEN event_id % 6 = 0 THEN 0.0::DOUBLE ELSE n END AS n
    FROM (SELECT event_id, (event_id % 9)::DOUBLE / 8 AS p, (event_id % 5)::DOUBLE / 4 AS u,
          (event_id % 3)::DOUBLE / 2 AS n FROM ev))""",
        "ev",
    ),
)
def _result(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    n = F.col("event_id")
    text = F.when(n % 6 == 0, " \t").otherwise(F.col("event_type"))
    result = S.probability_columns(text, n % 9 / 8, n % 5 / 4, n % 3 / 2)
    return e.select("event_id", *[column.alias(name) for name, column in result.items()])


_CLASSIFIED = """SELECT comment_id, round(p - n, 4) AS sentiment_score,
    CASE WHEN p >= u AND p >= n THEN 'positive' WHEN u >= n THEN 'neutral' ELSE 'negative' END AS sentiment_label,
    greatest(p, u, n) AS sentiment_confidence, CAST(round(p * 100) AS BIGINT) AS positive_hits,
    CAST(round(n * 100) AS BIGINT) AS negative_hits
  FROM (SELECT comment_id, (length(comment_text) % 8)::DOUBLE / 8 AS p, (length(comment_text) % 4)::DOUBLE / 4 AS u,
        (length(comment_text) % 2)::DOUBLE / 2 AS n FROM com)"""


def _as_bronze(df):
    blank = F.lit("").alias
    return df.select(
        "*",
        F.lit("r1").alias("run_id"),
        F.lit("2024-01-01").alias("ingested_at"),
        F.lit("t").alias("ingestion_type"),
        blank("author_display_name"),
    )


@case("batch_classifier", sql(_CLASSIFIED, "com"))
def _classifier(spark, d):
    def length_scorer():
        """A stand-in model: class shares from the text's length, so that SQL can repeat it."""

        def score(texts):
            shares = (("LABEL_2", 8), ("LABEL_1", 4), ("LABEL_0", 2))
            return [[{"label": name, "score": len(text) % n / n} for name, n in shares] for text in texts]

        return score

    plain = comments(spark, d).drop("sentiment_score", "sentiment_label")
    scored = scoring.enrich_sentiment(_as_bronze(plain), length_scorer, "length")
    names = "comment_id sentiment_score sentiment_label sentiment_confidence positive_hits negative_hits"
    return scored.select(*names.split())


@case(
    "sentiment_enrichment",
    sql(
        """SELECT comment_id, 'unknown' AS language_target, sentiment_score, sentiment_label,
    greatest(sentiment_score, 0.0::DOUBLE) AS positive_probability,
    greatest(-sentiment_score, 0.0::DOUBLE) AS negative_probability,
    round(1 - abs(sentiment_score), 4) AS neutral_probability, 'lexicon' AS sentiment_model, positive_hits,
    negative_hits, token_count FROM lex""",
        "lex",
    ),
)
def _enriched(spark, d):
    plain = comments(spark, d).drop("sentiment_score", "sentiment_label")
    scored = scoring.enrich_sentiment(_as_bronze(plain.union(plain)), lexicon=LEXICON)
    names = (
        "comment_id language_target sentiment_score sentiment_label positive_probability negative_probability "
        "neutral_probability sentiment_model positive_hits negative_hits token_count"
    )
    return scored.select(*names.split())


@case(
    "sentiment_table_job",
    sql(
        """SELECT comment_id, CAST(collection_date AS VARCHAR) AS collection_date, topic, 'lexicon' AS sentiment_model,
    comment_like_count FROM com""",
        "com",
    ),
)
def _sentiment_table(spark, d):
    root = scratch(spark, "lakehouse")
    silver_rows = silver.build_silver(comments(spark, d))
    write_contract(silver_rows, jobs.SILVER, root, "overwrite", refuse_empty=False)
    jobs.score_silver(spark, root, at="2024-01-01")
    names = "comment_id collection_date topic sentiment_model comment_like_count"
    return read_contract(spark, root, jobs.SCORED).select(*names.split())


# ------------------------------------------------------------ untidy values


@case(
    "safe_text_values",
    sql(
        f"""SELECT position, {text_sql('topic', "'unknown'")} AS topic, {text_sql('comment_text')} AS comment_text,
    {text_sql('query_text', text_sql('genre', "'none'"))} AS query_or_genre FROM unt""",
        "unt",
    ),
)
def _safe_text(spark, d):
    return untidy(spark, d).select(
        "position",
        C.safe_text(F.col("topic"), "unknown").alias("topic"),
        C.safe_text(F.col("comment_text")).alias("comment_text"),
        C.safe_text(F.col("query_text"), C.safe_text(F.col("genre"), "none")).alias("query_or_genre"),
    )


@case(
    "safe_and_strict_ints",
    sql(
        f"""SELECT position, {int_sql('like_count')} AS safe, {int_sql('like_count', '-1')} AS safe_default,
    CASE WHEN regexp_full_match(trim(like_count), '[+-]?[0-9]+') THEN CAST(trim(like_count) AS BIGINT) ELSE 0 END
      AS strict,
    coalesce({int_sql("nullif(like_count, '')", 'NULL')}, {int_sql('comment_like_count')}) AS picked
  FROM unt""",
        "unt",
    ),
)
def _safe_int(spark, d):
    u = untidy(spark, d)
    return u.select(
        "position",
        C.safe_int(F.col("like_count")).alias("safe"),
        C.safe_int(F.col("like_count"), -1).alias("safe_default"),
        C.strict_int(F.col("like_count")).alias("strict"),
        C.safe_int(F.col("like_count"), C.safe_int(F.col("comment_like_count"))).alias("picked"),
    )


@case(
    "first_filled_of_several",
    sql(
        """SELECT position, coalesce(nullif(video_title, ''), nullif(title, ''), '') AS title,
    coalesce(nullif(query_text, ''), nullif(topic, ''), 'none') AS query_or_topic,
    coalesce(nullif(author_display_name, ''), nullif(author_name, '')) AS author FROM unt""",
        "unt",
    ),
)
def _first_filled(spark, d):
    u = untidy(spark, d)
    return u.select(
        "position",
        C.first_filled(F.col("video_title"), F.col("title"), default=F.lit("")).alias("title"),
        C.first_filled(F.col("query_text"), F.col("topic"), default=F.lit("none")).alias("query_or_topic"),
        C.pick(u, ["author_display_name", "absent", "author_name"]).alias("author"),
    )


@case(
    "optional_columns",
    sql(
        """SELECT position, CAST(NULL AS VARCHAR) AS absent, topic, TRY_CAST(trim(like_count) AS DOUBLE) AS likes,
    CAST(0 AS BIGINT) AS zero FROM unt""",
        "unt",
    ),
)
def _optional(spark, d):
    u = untidy(spark, d)
    return u.select(
        "position",
        C.col_or_null(u, "absent").alias("absent"),
        C.col_or_null(u, "topic").alias("topic"),
        C.first_present(u, ["no_such", "like_count", "comment_like_count"]).alias("likes"),
        C.int_or_zero(u, "no_such").alias("zero"),
    )


@case(
    "contract_alignment",
    sql(
        """SELECT topic, CAST(NULL AS VARCHAR) AS thread_id, comment_id, CAST(position AS BIGINT) AS like_count,
    CASE WHEN regexp_full_match(trim(like_count), '[0-9]+') THEN CAST(trim(like_count) AS DOUBLE) END AS reply_count,
    CAST(position AS VARCHAR) AS text FROM unt""",
        "unt",
    ),
)
def _aligned(spark, d):
    u = untidy(spark, d).select(
        "topic",
        "comment_id",
        F.col("position").alias("text"),
        F.col("position").cast("double").alias("like_count"),
        F.col("like_count").alias("reply_count"),
        "title",
    )
    out = align(u, CONTRACTS["bronze.youtube_comments_raw"])
    return out.select(
        "topic", "thread_id", "comment_id", "like_count", F.col("reply_count").cast("double").alias("reply_count"), "text"
    )


@case(
    "display_texts",
    sql(
        f"""SELECT l_orderkey, p_partkey, {display_sql("p_type || '_' || p_name")} AS shown,
    CASE WHEN length(t) > 58 THEN substr(t, 1, 55) || '...' ELSE t END AS shortened,
    CASE WHEN length(t) > 42 THEN rtrim(substr(t, 1, 42), {WS}) || '...' ELSE t END AS truncated
  FROM (SELECT *, p_name || ' ' || p_type || ' ' || p_brand || ' sold by ' || l_suppkey || ' in lot '
     || l_orderkey || ' and ' || p_name AS t FROM lineitem JOIN part ON l_partkey = p_partkey)"""
    ),
)
def _display(spark, d):
    li, p = spark.read.parquet(f"{d}/lineitem.parquet"), spark.read.parquet(f"{d}/part.parquet")
    joined = li.join(p, li["l_partkey"] == p["p_partkey"])
    text = F.concat(
        "p_name", F.lit(" "), "p_type", F.lit(" "), "p_brand", F.lit(" sold by "), "l_suppkey", F.lit(" in lot "),
        "l_orderkey", F.lit(" and "), "p_name",
    )
    return joined.select(
        "l_orderkey",
        "p_partkey",
        X.display_text(F.concat("p_type", F.lit("_"), "p_name")).alias("shown"),
        X.shorten(text).alias("shortened"),
        X.truncate_text(text).alias("truncated"),
    )


@case(
    "date_labels",
    sql(
        """SELECT position, strftime(TRY_CAST(collection_date AS DATE), '%Y-%m-%d') AS collection_date_label,
    TRY_CAST(collection_date AS DATE) IS NULL AS bad_date FROM unt""",
        "unt",
    ),
)
def _labels(spark, d):
    out = with_dates(untidy(spark, d), ["collection_date"], labels=True)
    return out.select("position", "collection_date_label", F.col("collection_date").isNull().alias("bad_date"))


@case(
    "slugs_and_query_ids",
    sql(
        f"""SELECT query_id, {slug_sql("query_text || ' !! ' || platform")} AS text_slug,
    'yt-custom-' || {slug_sql('topic', 20)} || '-' || {slug_sql("query_text || ' for ' || genre", 24)} AS youtube_id,
    {slug_sql('platform', 8)} || '-custom-' || {slug_sql('topic', 20)} || '-' || {slug_sql('query_text', 24)}
      AS other_id,
    coalesce(nullif(trim(regexp_replace(' ' || platform || '/' || query_text, '[^\\p{{L}}\\p{{N}}_-]', '_', 'g'), '_'),
      ''), 'query') AS file_name,
    trim(regexp_replace('  ' || query_text || '   ' || topic || ' ', '\\s+', ' ', 'g')) AS collapsed
  FROM reg""",
        "reg",
    ),
)
def _slugs(spark, d):
    r = registry(spark, d)
    text = F.col("query_text")
    return r.select(
        "query_id",
        X.slug(F.concat(text, F.lit(" !! "), "platform")).alias("text_slug"),
        X.custom_query_id(F.lit("YouTube"), F.col("topic"), F.concat(text, F.lit(" for "), "genre")).alias("youtube_id"),
        X.custom_query_id(F.col("platform"), F.col("topic"), text).alias("other_id"),
        X.safe_name(F.concat(F.lit(" "), "platform", F.lit("/"), text)).alias("file_name"),
        X.collapse_spaces(F.concat(F.lit("  "), text, F.lit("   "), "topic", F.lit(" "))).alias("collapsed"),
    )


@case(
    "outcomes_and_limits",
    sql(
        """SELECT run_id, query_id, expected_units, CASE WHEN comments_count > 0 AND videos_count = comments_count
    THEN 'success' WHEN comments_count > 0 THEN 'partial_success' WHEN videos_count > 0 THEN 'failed'
    ELSE 'no_data' END AS outcome,
    CAST(CASE WHEN expected_units % 3 = 0 THEN 25 ELSE videos_count END AS INTEGER) AS effective_limit FROM summ""",
        "summ",
    ),
)
def _outcomes(spark, d):
    s = summaries(spark, d)
    limit = F.when(F.col("expected_units") % 3 == 0, "").otherwise(F.col("videos_count").cast("string"))
    missing = F.col("videos_count") - F.col("comments_count")
    return s.select(
        "run_id",
        "query_id",
        "expected_units",
        N.outcome(F.col("comments_count"), missing).alias("outcome"),
        C.resolve_limit(limit, 25).alias("effective_limit"),
    )


@case(
    "safe_ratios",
    sql(
        """SELECT run_id, query_id, expected_units, round(comments_count / greatest(videos_count, 1), 4) AS ratio,
    round(CASE WHEN videos_count = 0 THEN 0 ELSE comments_count / videos_count END, 6) AS quotient FROM summ""",
        "summ",
    ),
)
def _ratios(spark, d):
    n, v = F.col("comments_count"), F.col("videos_count")
    out = summaries(spark, d).select(
        "run_id", "query_id", "expected_units", N.ratio(n, v).alias("ratio"), N.divide(n, v).alias("quotient")
    )
    return rounded(out)


@case(
    "lookback_cutoff",
    sql(
        """SELECT event_id, ts >= TIMESTAMP '2024-01-20 12:00:00' - to_days(CAST(k % 30 + 1 AS INTEGER)) AS recent
  FROM ev""",
        "ev",
    ),
)
def _lookback(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    days = (F.get_json_object("props", "$.k").cast("int") % 30 + 1).cast("int")
    moment = F.to_timestamp(F.lit("2024-01-20 12:00:00"))
    return e.select("event_id", C.published_after(F.col("ts").cast("timestamp"), moment, days).alias("recent"))


@case(
    "extended_json_parts",
    sql(
        """SELECT event_id, CASE event_id % 4 WHEN 0 THEN '2024-05-06' WHEN 1 THEN 'plain ' || event_type
    WHEN 2 THEN NULL END AS date_value, CASE event_id % 3 WHEN 0 THEN event_type END AS label,
    CASE event_id % 3 WHEN 0 THEN 'l' || k END AS code FROM ev""",
        "ev",
    ),
)
def _extended(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("k", F.get_json_object("props", "$.k"))
    n = F.col("event_id")
    date = (
        F.when(n % 4 == 0, '{"$date": "2024-05-06"}')
        .when(n % 4 == 1, F.concat(F.lit("plain "), "event_type"))
        .when(n % 4 == 2, '{"other": 1}')
    )
    parts = F.when(n % 3 == 0, F.format_string('["%s", {"LangDetect": "l%s"}]', "event_type", "k")).when(
        n % 3 == 1, F.format_string('["%s"]', "event_type")
    )
    label, code = C.language_parts(parts)
    return e.select("event_id", C.extended_date(date).alias("date_value"), label.alias("label"), code.alias("code"))


@case(
    "normalised_comment_rows",
    sql(
        f"""SELECT position, trim(comment_id) AS comment_id, 'youtube' AS platform, comment_text,
    {int_sql('like_count')} AS comment_like_count, CAST(0 AS BIGINT) AS reply_count,
    CAST(hour(t) AS DOUBLE) AS comment_hour_24, strftime(t, '%A') AS weekday_name,
    strftime(t, '%Y-%m-%d') AS collection_date, CAST(NULL AS VARCHAR) AS topic
  FROM (SELECT *, TRY_CAST(comment_published_at AS TIMESTAMP) AS t FROM unt)""",
        "unt",
    ),
)
def _normalised(spark, d):
    raw = untidy(spark, d).select(
        "position",
        "comment_id",
        F.col("comment_text").alias("text"),
        F.col("comment_published_at").alias("published_at"),
        "like_count",
        "author_name",
    )
    out = silver.normalize_comments(raw)
    return out.select(
        "position",
        F.trim("comment_id").alias("comment_id"),
        "platform",
        "comment_text",
        "comment_like_count",
        "reply_count",
        F.col("comment_hour_24").cast("double").alias("comment_hour_24"),
        "weekday_name",
        "collection_date",
        "topic",
    )


@case(
    "weighted_averages",
    sql(
        """SELECT topic, round(coalesce(CASE WHEN sum(w) FILTER (v IS NOT NULL) > 0
    THEN sum(v * w) / sum(w) FILTER (v IS NOT NULL) ELSE avg(v) END, 0), 6) AS weighted,
    round(sum(sentiment_score * greatest(w, 1)) / sum(greatest(w, 1)), 6) AS floored
  FROM (SELECT *, comment_like_count % 3 AS w, CASE WHEN reply_count % 4 > 0 THEN sentiment_score END AS v FROM eng)
  GROUP BY topic""",
        "eng",
    ),
)
def _weighted(spark, d):
    e = engagement(spark, d).withColumns(
        {
            "w": F.col("comment_like_count") % 3,
            "v": F.when(F.col("reply_count") % 4 > 0, F.col("sentiment_score")),
        }
    )
    out = e.groupBy("topic").agg(
        N.weighted_avg(F.col("v"), F.col("w")).alias("weighted"),
        N.floor_weighted_avg(F.col("sentiment_score"), F.col("w")).alias("floored"),
    )
    return rounded(out)
