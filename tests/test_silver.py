import random

from pyspark.sql import functions as F

from voxlake.operators import silver

COLUMNS = (
    "run_id collection_date ingested_at platform topic genre query_id comment_id comment_text comment_like_count "
    "comment_published_at comment_updated_at reply_count author_display_name"
).split()


def bronze(spark, *changes):
    base = dict.fromkeys(COLUMNS, "x") | {
        "collection_date": "2026-04-01",
        "ingested_at": "2026-04-01T11:00:00+00:00",
        "comment_id": "c-1",
        "comment_text": " text ",
        "comment_like_count": "3",
        "reply_count": "1",
        "comment_published_at": "2026-04-01T09:00:00Z",
        "comment_updated_at": "2026-04-01T10:00:00Z",
    }
    return spark.createDataFrame([{**base, **c} for c in changes], ", ".join(f"{c} string" for c in COLUMNS))


def test_newest_version_wins_and_is_trimmed(spark, rows):
    df = bronze(
        spark,
        {"comment_text": "  old comment  "},
        {
            "comment_text": "  new comment  ",
            "comment_updated_at": "2026-04-01T10:05:00Z",
            "comment_like_count": "5",
            "reply_count": "2",
            "author_display_name": " Raj ",
        },
    )
    (row,) = rows(silver.build_silver(df, F.current_timestamp()))
    assert (row["comment_text"], row["comment_like_count"], row["reply_count"]) == ("new comment", 5, 2)
    assert row["author_display_name"] == "Raj" and row["processed_at"] is not None
    assert row["video_description"] is None and row["kafka_offset"] is None


def test_bad_values_become_null_and_blank_rows_go(spark, rows):
    df = bronze(
        spark,
        {"comment_id": "a", "comment_like_count": "abc", "collection_date": "soon", "comment_updated_at": None},
        {"comment_id": "  "},
        {"comment_id": None},
        {"comment_id": "b", "comment_text": "   "},
        {"comment_id": "d", "comment_text": None},
    )
    (row,) = rows(silver.build_silver(df))
    assert row["comment_id"] == "a"
    assert row["comment_like_count"] is None and row["collection_date"] is None


def test_dedup_does_not_depend_on_order_or_partitions(spark, rows):
    changes = [
        {"comment_id": f"c{i % 7}", "comment_text": f"t{i}", "comment_updated_at": f"2026-04-01T10:0{i % 3}:00Z"}
        for i in range(60)
    ]
    first = rows(silver.build_silver(bronze(spark, *changes)), "comment_id")
    for seed, parts in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(changes)
        assert rows(silver.build_silver(bronze(spark, *changes).repartition(parts)), "comment_id") == first


def test_one_comment_with_most_rows_is_reduced_before_the_shuffle(spark):
    plan = silver.build_silver(bronze(spark, {}, {}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_union_tags_sources_and_needs_one(spark, rows):
    daily = bronze(spark, {"comment_id": "a"})
    streamed = bronze(spark, {"comment_id": "b"}).withColumn("kafka_offset", F.lit(4).cast("bigint"))
    out = rows(silver.union_bronze({"daily": daily, "streamed": streamed, "none": None}), "comment_id")
    assert [(r["source_table"], r["kafka_offset"]) for r in out] == [("daily", None), ("streamed", 4)]
    try:
        silver.union_bronze({"daily": None})
        raise AssertionError("no input must be an error")
    except FileNotFoundError:
        pass


def test_normalized_rows_fill_old_names_and_derive(spark, rows):
    df = spark.createDataFrame(
        [("c1", "hello", "2026-04-01T23:30:00Z", "4"), ("c2", "x", "never", "bad")],
        "comment_id string, text string, published_at string, like_count string",
    )
    a, b = rows(silver.normalize_comments(df), "comment_id")
    assert (a["comment_text"], a["comment_like_count"], a["weekday_name"]) == ("hello", 4, "Wednesday")
    assert (a["collection_date"], a["comment_hour_24"], a["platform"]) == ("2026-04-01", 23, "youtube")
    assert (b["comment_like_count"], b["comment_published_at"], b["sentiment_score"]) == (0, None, 0.0)
