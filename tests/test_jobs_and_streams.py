import json

import pytest
from pyspark.sql import functions as F

from voxlake.operators import bronze, diagnostic, marts
from voxlake.plans import jobs
from voxlake.sources import docstore
from voxlake.sources.tables import read_contract
from voxlake.streaming import events as streaming

AT = "2026-04-16T10:00:00+00:00"
RAW = "run_folder string, position bigint, query_id string, video_id string, comment_id string, comment_text string, like_count string, comment_published_at string, comment_updated_at string"
ALIASES = {"technology": {"smartphones": ["phone"]}}


def manifests(spark, *days):
    data = [(f"daily-{d}", f"daily-{d}", f"{d}T09:00:00", f"raw/daily-{d}/manifest.json", "raw/c.json", "plan.json", "1", "2", "0") for d in days]
    return spark.createDataFrame(data, "run_folder string, run_id string, generated_at string, manifest_path string, "
                                 "normalized_comments_path string, plan_path string, queries_executed string, total_comments_collected string, error_count string")


def record(day, n, text, updated="2026-04-01T00:00:00Z", comment=None):
    return (f"daily-{day}", n, "q1", f"v{n}", comment or f"c{day}-{n}", text, "3", f"{day}T0{n}:00:00Z", updated)


def registry(spark):
    return spark.createDataFrame(
        [("q1", "youtube", "phones", "tech", "best phones", 9, 100, True)],
        "query_id string, platform string, topic string, genre string, query_text string, priority int, expected_units bigint, active boolean")


def summaries(spark):
    return spark.createDataFrame(
        [("daily-2026-04-01", "2026-04-01", "2026-04-01", "q1", "best phones", "phones", "tech", 100, 2, 3, AT)],
        "run_id string, run_date string, plan_date string, query_id string, query_text string, topic string, genre string, "
        "expected_units bigint, videos_count bigint, comments_count bigint, created_at string")


def test_whole_day_then_a_custom_query(spark, tmp_path):
    root = str(tmp_path / "lake")
    none = spark.createDataFrame([], "run_id string, query_id string, position bigint, error string")
    first = spark.createDataFrame([record("2026-04-01", 1, "amazing camera 🔥"), record("2026-04-01", 2, "worst overpriced thing"),
                                   record("2026-04-02", 1, "fine by me")], RAW)
    out = jobs.daily_run(spark, root, registry(spark), first, manifests(spark, "2026-04-01", "2026-04-02"), summaries(spark), none, at=AT)
    assert out["silver"] == {"silver_path": out["silver"]["silver_path"], "source_rows": 3, "rows_written": 3}
    assert out["overview"]["status"] == "success"
    daily = {r["collection_date"]: r for r in read_contract(spark, root, "gold.youtube_sentiment_daily_summary").collect()}
    assert (daily["2026-04-01"]["positive_comments"], daily["2026-04-01"]["negative_comments"]) == (1, 1)
    assert daily["2026-04-01"]["topic"] == "phones" and daily["2026-04-01"]["built_at"] == AT

    query = spark.createDataFrame([("youtube", "cheap phone", 5, 50)], "platform string, query_text string, priority int, expected_units bigint")
    more = spark.createDataFrame([record("2026-04-03", 1, "great"), record("2026-04-03", 2, "perfect phone", "2026-04-05T00:00:00Z", "c2026-04-01-2")], RAW)
    later = "2026-04-17T10:00:00+00:00"
    refreshed = jobs.custom_query_refresh(spark, root, registry(spark), query, ALIASES, more, manifests(spark, "2026-04-03"), later)
    assert {r["action"] for r in refreshed["registry"].collect()} == {None, "created"}
    assert refreshed["dates"] == ["2026-04-01", "2026-04-03"]
    marts_now = {r["collection_date"]: r for r in read_contract(spark, root, "gold.youtube_sentiment_daily_summary").groupBy(
        "collection_date").agg(F.sum("comments_count").alias("n"), F.max("built_at").alias("built_at")).collect()}
    assert {d: (r["n"], r["built_at"]) for d, r in marts_now.items()} == {
        "2026-04-01": (1, later), "2026-04-02": (1, AT), "2026-04-03": (2, later)}
    assert read_contract(spark, root, jobs.SCORED).count() == 4


def test_overview_is_skipped_without_inputs(spark, tmp_path):
    assert jobs.overview_gold(spark, str(tmp_path))["status"] == "skipped_missing_inputs"


def messages(spark, n):
    schema = "position bigint, run_id string, topic string, comment_id string, plan_date string"
    records = spark.createDataFrame([(i, "r", "t", f"c{i}", f"2026-04-0{i % 2 + 1}") for i in range(n)], schema)
    events = bronze.build_events(records, None, "p", AT)
    return events.select(F.lit("comments").alias("topic"), F.lit(0).cast("bigint").alias("partition"),
                         F.monotonically_increasing_id().alias("offset"), "key", "value")


def test_drain_restart_and_repeated_batch(spark, tmp_path):
    root, log, checkpoint = (str(tmp_path / n) for n in ("lake", "log", "checkpoint"))
    run = lambda: streaming.consume_to_bronze(docstore.read_message_files(spark, log), root, checkpoint).awaitTermination()
    messages(spark, 10).write.json(log)
    run()
    assert read_contract(spark, root, streaming.COMMENTS).count() == 10
    run()
    messages(spark, 6).write.mode("append").json(log)
    run()
    table = read_contract(spark, root, streaming.COMMENTS)
    assert table.count() == 16 and table.select("event_id").distinct().count() == 10
    log_rows = read_contract(spark, root, streaming.RUNS)
    assert log_rows.agg(F.sum("messages_consumed")).first()[0] == 16
    newest = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    newest.unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(f".{newest.name}.crc"):
        crc.unlink()
    run()
    assert read_contract(spark, root, streaming.COMMENTS).count() == 16
    assert json.loads(messages(spark, 1).first()["value"])["event_type"] == "youtube.comment.raw.v1"


def scored(spark, n=400):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("event_id"),
        F.col("id").cast("string").alias("comment_id"),
        F.timestamp_seconds(F.lit(1775000000) + F.col("id") * 900).alias("comment_published_at"),
        F.concat(F.lit("t"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)).alias("topic"),
        F.lit("g").alias("genre"), F.lit("v").alias("video_id"),
        (F.col("id") % 9 / 8 - 0.5).alias("sentiment_score"),
        F.when(F.col("id") % 9 > 5, "positive").otherwise("negative").alias("sentiment_label"),
        (F.col("id") % 11).alias("comment_like_count"))
    return df.withColumn("collection_date", F.date_format("comment_published_at", "yyyy-MM-dd"))


def test_windowed_stream_equals_batch_on_closed_days(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(2):
        scored(spark).write.mode("append").parquet(source)
    stream = streaming.event_time(spark.readStream.schema(scored(spark).schema).parquet(source))
    unique = streaming.without_repeats(stream, "10 days")
    streaming.drain(unique.drop("event_time"), str(tmp_path / "unique"), str(tmp_path / "cp1"))
    assert spark.read.parquet(str(tmp_path / "unique")).count() == 400
    again = spark.readStream.schema(scored(spark).schema).parquet(str(tmp_path / "unique"))
    streaming.drain(streaming.windowed_mart(streaming.event_time(again), delay="0 seconds"), out, str(tmp_path / "cp2"))
    got = {(r["window_start"][:10], r["topic"]): (r["comments_count"], r["positive_comments"], r["total_comment_likes"], r["avg_sentiment_score"])
           for r in spark.read.parquet(out).collect()}
    batch = marts.daily_trend(scored(spark)).collect()
    last = max(r["collection_date"] for r in batch)
    want = {(r["collection_date"], r["topic"]): (r["comments_count"], r["positive_comments"], r["total_comment_likes"], r["avg_sentiment_score"])
            for r in batch if r["collection_date"] < last}
    assert got == want


def test_views_on_empty_and_single_day_input(spark):
    empty = scored(spark).limit(0)
    assert [r["comments_count"] for r in diagnostic.endorsement(empty).orderBy("sentiment_bucket_order").collect()] == [0] * 5
    one_day = marts.daily_trend(scored(spark, 10))
    assert diagnostic.sharpest_drop(one_day.filter("collection_date = '2026-03-31'")).count() == 0
    assert diagnostic.drivers(None, empty.withColumn("comment_text", F.lit("x")), True).count() == 0
    edges = spark.createDataFrame([(-1.01,), (-0.35,), (-0.05,), (0.05,), (0.35,), (1.01,), (1.2,)], "sentiment_score double")
    counts = [r["comments_count"] for r in diagnostic.endorsement(edges).orderBy("sentiment_bucket_order").collect()]
    assert counts == [2, 1, 1, 1, 1]


def test_refresh_scores_comments_without_a_date(spark, tmp_path):
    root = str(tmp_path / "lake")
    none = spark.createDataFrame([], "run_id string, query_id string, position bigint, error string")
    first = spark.createDataFrame([record("2026-04-01", 1, "amazing camera")], RAW)
    jobs.daily_run(spark, root, registry(spark), first, manifests(spark, "2026-04-01"), summaries(spark), none, at=AT)
    query = spark.createDataFrame([("youtube", "cheap phone", 5, 50)], "platform string, query_text string, priority int, expected_units bigint")
    more = spark.createDataFrame([record("2026-04-03", 1, "great"), ("daily-undated", 1, "q1", "v9", "undated", "perfect", "1", None, None)], RAW)
    days = manifests(spark, "2026-04-03").unionByName(
        manifests(spark, "undated").withColumn("generated_at", F.lit("no date")))
    jobs.custom_query_refresh(spark, root, registry(spark), query, ALIASES, more, days, AT)
    scored = read_contract(spark, root, jobs.SCORED)
    assert {r["comment_id"] for r in scored.collect()} == {"c2026-04-01-1", "c2026-04-03-1", "undated"}


def _events(spark, folder, *rows):
    spark.createDataFrame([*rows], "event_id string, comment_published_at string, topic string, genre string, sentiment_label string, sentiment_score double, comment_like_count string").coalesce(
        1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    reader = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", "1")
    return streaming.event_time(reader.parquet(folder))


def test_late_events_are_kept_and_windows_grow(spark, tmp_path):
    folder, out = str(tmp_path / "in"), [str(tmp_path / f"out{i}") for i in range(4)]
    event = lambda i, day: (f"e{i}", f"2026-04-{day:02d}T10:00:00Z", "t", None if i == 4 else "g", "positive", 0.5, "2")
    for i, day in ((1, 8), (2, 9), (3, 3), (1, 8)):
        _events(spark, folder, event(i, day))
    streaming.drain(streaming.without_repeats(_stream(spark, folder)), out[0], out[1])
    assert sorted(r["event_id"] for r in spark.read.parquet(out[0]).collect()) == ["e1", "e2", "e3"]
    streaming.drain_windows(streaming.windowed_mart(_stream(spark, folder)), out[2], out[3])
    _events(spark, folder, event(4, 3), event(5, 3))
    streaming.drain_windows(streaming.windowed_mart(_stream(spark, folder)), out[2], out[3])
    got = {(r["window_start"][:10], r["genre"]): r["comments_count"] for r in streaming.read_windows(spark, out[2]).collect()}
    assert got == {("2026-04-03", "g"): 2, ("2026-04-03", None): 1, ("2026-04-08", "g"): 2, ("2026-04-09", "g"): 1}


def test_drain_stops_at_its_bound_and_says_when_there_is_nothing(spark, tmp_path):
    log, root, checkpoint = (str(tmp_path / name) for name in ("log", "lake", "checkpoint"))
    for n in range(3):
        message = json.dumps({"event_id": f"e{n}", "comment_id": f"c{n}", "comment_text": "x", "plan_date": "2026-04-01"})
        spark.createDataFrame([("comments", 0, n, "k", message)], "topic string, partition bigint, offset bigint, key string, value string").coalesce(
            1).write.mode("append").json(log)
    read = lambda: docstore.read_message_files(spark, log, max_files=1)
    run = lambda most=None: streaming.consume_available(spark, read(), root, checkpoint, most, AT)
    assert run(1) == {"status": "success", "messages_consumed": 1}
    assert run() == {"status": "success", "messages_consumed": 2}
    assert run() == {"status": "empty", "messages_consumed": 0}
    assert read_contract(spark, root, streaming.COMMENTS).count() == 3


def test_a_corrupt_tier_is_left_out(spark, tmp_path):
    from voxlake.sources.tables import comment_level_source

    root = tmp_path / "lake"
    broken = root / "silver" / "youtube_comments_sentiment"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("this is no parquet file")
    spark.createDataFrame([("c1", "2026-04-01")], "comment_id string, collection_date string").write.parquet(str(root / "bronze" / "youtube_comments_daily_raw"))
    with pytest.warns(UserWarning, match="cannot be read"):
        assert [r["comment_id"] for r in comment_level_source(spark, str(root)).collect()] == ["c1"]


def test_empty_video_mart_gives_the_comment_side(spark):
    from voxlake.operators import descriptive

    comments = spark.createDataFrame([("c1", "v1", "T", "ch", "t", "g", "3"), ("c2", "v1", "T", "ch", "t", "g", "5")],
                                     "comment_id string, video_id string, video_title string, channel_title string, topic string, genre string, comment_like_count string")
    empty = spark.createDataFrame([], "video_id string, comments_count bigint")
    (row,) = descriptive.video_evidence(comments, empty).collect()
    assert (row["video_id"], row["matched_comments"], row["total_comment_likes"], row["comments_count"]) == ("v1", 2, 8, 2)


def test_backfill_keeps_fields_that_a_source_lacks(spark, tmp_path):
    key = ("r", "q", "v")
    store = [str(tmp_path / name) for name in ("absent", "first", "second")]
    names = "run_id string, query_id string, video_id string, comment_id string, mongo_loaded_at string, position bigint, source_type string, source_path string"
    one = spark.createDataFrame([(*key, "c1", "2026-01-01", 1, "a", "a.json", "text 1", "en"), (*key, "c2", "2026-01-01", 2, "a", "a.json", "text 2", "en")], names + ", comment_text string, language string")
    two = spark.createDataFrame([(*key, "c1", "2026-01-05", 1, "b", "b.json", "newer 1", 7)], names + ", comment_text string, like_count bigint")
    jobs.backfill(spark, [one], store[0], store[1])
    out = jobs.backfill(spark, [two, one.where("comment_id = 'c2'")], store[1], store[2])
    got = {r["comment_id"]: (r["comment_text"], r["language"], r["like_count"]) for r in spark.read.parquet(store[2]).collect()}
    assert got == {"c1": ("newer 1", "en", 7), "c2": ("text 2", "en", None)}
    assert out["counts"] == {"input_documents": 2, "matched_documents": 2, "modified_documents": 1, "upserted_documents": 0}
