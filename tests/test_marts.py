import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from voxlake.functions.text import MART_STOP_WORDS
from voxlake.operators import marts

SCHEMA = (
    "collection_date string, topic string, genre string, video_id string, video_title string, channel_title string, "
    "platform string, comment_id string, comment_text string, sentiment_label string, comment_like_count string, "
    "sentiment_score double, comment_published_at string"
)


def scored(spark, *rows):
    base = ("2026-04-01", "phones", "tech", "v1", "V", "C", "youtube", "c", "t", "neutral", "0", 0.0, "2026-04-01T05:00:00Z")
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([{**dict(zip(names, base)), **row} for row in rows], SCHEMA)


def sample(spark):
    return scored(
        spark,
        {"comment_id": "1", "sentiment_label": "positive", "sentiment_score": 0.6, "comment_like_count": "5"},
        {"comment_id": "2", "sentiment_label": "negative", "sentiment_score": -0.5, "comment_like_count": "abc"},
        {"comment_id": "3", "comment_like_count": None},
    )


def test_daily_summary(spark, rows):
    (row,) = rows(marts.daily_summary(sample(spark)))
    assert (row["comments_count"], row["positive_comments"], row["neutral_comments"], row["negative_comments"]) == (3, 1, 1, 1)
    assert row["avg_sentiment_score"] == pytest.approx(0.0333)
    assert (row["total_comment_likes"], row["avg_comment_likes"]) == (5, 1.6667)
    assert (row["positive_ratio"], row["avg_sentiment_confidence"]) == (0.3333, 0.0)


def test_ratio_counts_rows_over_distinct_ids(spark, rows):
    twice = sample(spark).filter("comment_id = '1'")
    (row,) = rows(marts.daily_summary(twice.union(twice)))
    assert (row["comments_count"], row["positive_comments"], row["positive_ratio"]) == (1, 2, 2.0)


def test_null_keys_are_left_out_except_in_keywords(spark):
    df = scored(spark, {"topic": None, "comment_text": "wonderful"}, {"comment_id": None, "comment_text": "wonderful"})
    assert marts.daily_summary(df).count() == 1
    assert marts.video_summary(df).count() == 1
    assert {r["topic"] for r in marts.keyword_frequency(df).collect()} == {None, "phones"}


@pytest.mark.parametrize("build", [marts.topic_summary, marts.overview_kpis, marts.daily_trend, marts.weekday_hour,
                                   marts.daily_summary, marts.video_summary])
def test_unique_ids_give_the_same_mart(spark, rows, build):
    df = scored(
        spark,
        *[
            {"comment_id": str(i), "video_id": f"v{i % 4}", "topic": f"t{i % 2}", "collection_date": f"2026-04-0{i % 3 + 1}",
             "sentiment_score": (i % 7) / 8 - 0.4, "comment_like_count": str(i), "platform": f"p{i % 2}",
             "sentiment_label": ["positive", "neutral", "negative"][i % 3],
             "comment_published_at": None if i % 5 == 0 else f"2026-04-0{i % 3 + 1}T0{i % 4}:00:00Z"}
            for i in range(50)
        ],
    )
    assert rows(build(df, unique_ids=True).select(*sorted(build(df).columns)), "comments_count", "total_comment_likes") == rows(
        build(df).select(*sorted(build(df).columns)), "comments_count", "total_comment_likes"
    )


@pytest.mark.parametrize("build", [marts.daily_summary, marts.video_summary, marts.topic_summary, marts.daily_trend,
                                   marts.weekday_hour, marts.overview_kpis, marts.keyword_frequency, marts.daily_topic_metrics])
def test_empty_input(spark, build):
    assert build(scored(spark, {}).limit(0)).count() == 0


def test_weekday_hour_and_order(spark, rows):
    df = scored(spark, {"comment_published_at": "2026-04-05T23:10:00Z"}, {"comment_published_at": "2026-04-06T00:10:00Z"},
                {"comment_published_at": "unknown"})
    out = [r.asDict() for r in marts.in_order(marts.weekday_hour(df), "weekday_hour").collect()]
    assert [(r["weekday_name"], r["comment_hour_24"]) for r in out] == [("Monday", 0), ("Sunday", 23)]


def brute_keywords(rows, top):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["collection_date"], r["topic"], r["genre"])].append(r)
    out = set()
    for key, members in groups.items():
        count, ids = Counter(), defaultdict(set)
        for r in members:
            words = set(re.findall("[a-z0-9]+", (r["comment_text"] or "").lower()))
            for w in words:
                if len(w) >= 3 and w not in MART_STOP_WORDS and not w.isdigit():
                    count[w] += 1
                    ids[w].add(r["comment_id"] or "<NA>")
        for w, n in sorted(count.items(), key=lambda item: (-item[1], item[0]))[:top]:
            out.add((*key, w, n, len(ids[w])))
    return out


@pytest.mark.parametrize("repeats", [False, True])
def test_keywords_equal_brute_force(spark, repeats):
    texts = ["Battery life battery 2024 is lasting", "camera battery ok", "lasting camera, lasting zoom", "zoom zoom 99", None]
    df = scored(
        spark,
        *[
            {"comment_id": (None if i == 3 else f"c{i % (5 if repeats else 100)}"), "comment_text": texts[i % 5],
             "topic": None if i % 9 == 0 else f"t{i % 2}"}
            for i in range(40)
        ],
    )
    want = brute_keywords([r.asDict() for r in df.collect()], 3)
    got = {
        (r["collection_date"], r["topic"], r["genre"], r["keyword"], r["keyword_count"], r["distinct_comments"])
        for r in marts.keyword_frequency(df, top_n=3).collect()
    }
    assert got == want


def test_daily_topic_metrics(spark, rows):
    schema = (
        "collection_date string, comment_published_at string, processed_at string, topic string, genre string, "
        "comment_id string, video_id string, sentiment_label string, comment_like_count int, reply_count int, "
        "sentiment_score double, sentiment_confidence double"
    )
    data = [
        ("2026-04-01", None, None, "smartphones", "tech", "c1", "v1", "positive", 2, 1, 0.8, 0.9),
        ("2026-04-01", None, None, "smartphones", "tech", "c2", "v1", "neutral", 3, None, None, 0.7),
        (None, "2026-04-02T01:00:00Z", None, " ", None, "c3", "v2", "negative", 1, 0, -0.4, None),
        ("bad", None, None, "x", "y", "c4", "v3", "positive", 1, 0, 0.1, 0.5),
    ]
    a, b = rows(marts.daily_topic_metrics(spark.createDataFrame(data, schema)), "metric_date")
    assert (a["comment_count"], a["distinct_videos"], a["total_like_count"], a["total_reply_count"]) == (2, 1, 5, 1)
    assert (a["avg_sentiment_score"], a["avg_sentiment_confidence"], a["positive_comments"]) == (0.8, 0.8, 1)
    assert (b["topic"], b["genre"], str(b["metric_date"])) == ("unknown", "unknown", "2026-04-02")


def test_probability_columns_under_either_name(spark, rows):
    df = sample(spark).filter("comment_id = '1'")
    for name in ("sentiment_positive_prob", "positive_probability"):
        (row,) = rows(marts.daily_summary(df.withColumn(name, F.lit(0.25))))
        assert row["avg_positive_probability"] == 0.25
