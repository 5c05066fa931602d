"""Stores and tables that change in parts: buckets, dates, offsets, streams of versions, states of days."""

import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxlake.operators import bronze, marts, silver
from voxlake.plans import changes, jobs
from voxlake.sinks import buckets, upsert
from voxlake.sources.tables import read_contract
from voxlake.streaming import events, latest, offsets

AT = "2026-04-16T10:00:00+00:00"
DOCS = "run_id string, query_id string, video_id string, comment_id string, text string, likes bigint"


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def docs(spark, ids, text="a", likes=1):
    return spark.createDataFrame([("r", "q", "v", f"c{i}", text, likes) for i in ids], DOCS)


# ------------------------------------------------------------------ buckets


def test_upsert_rewrites_only_changed_buckets(spark, tmp_path):
    path = str(tmp_path / "store")
    first = buckets.upsert(spark, path, docs(spark, range(200)), buckets=16)
    assert (first["upserted_documents"], first["matched_documents"], first["buckets_written"]) == (200, 0, 16)
    before = files(path)
    few = docs(spark, [3, 5], "b").union(docs(spark, [7])).union(docs(spark, [1000]))
    out = buckets.upsert(spark, path, few)
    assert (out["matched_documents"], out["modified_documents"], out["upserted_documents"]) == (3, 2, 1)
    assert out["buckets_read"] <= 4 and out["buckets_written"] <= 3
    after = files(path)
    # Files of buckets that hold no changed document are the same files as before.
    gone = {f.split("bucket_of_16=")[1].split("/")[0] for f in before - after}
    assert len(gone) == out["buckets_written"] and len(before & after) == len(before) - len(before - after) > 0
    rows = {r["comment_id"]: r["text"] for r in buckets.read(spark, path).collect()}
    assert len(rows) == 201 and rows["c3"] == rows["c5"] == "b" and rows["c7"] == "a"
    again = buckets.upsert(spark, path, few)
    assert again["buckets_written"] == 0 and files(path) == after


def test_upsert_into_buckets_equals_upsert_of_the_whole(spark, tmp_path):
    path, draw = str(tmp_path / "store"), random.Random(4)
    whole = spark.createDataFrame([], DOCS)
    for step in range(3):
        ids = [draw.randrange(60) for _ in range(25)]
        new = docs(spark, sorted(set(ids)), f"t{step}", step)
        if step == 1:
            new = new.drop("likes").withColumn("lang", F.lit("en"))
        if step == 2:
            new = new.withColumn("query_id", F.when(F.col("comment_id") > "c4", None).otherwise(F.col("query_id")))
        buckets.upsert(spark, path, new, buckets=8)
        whole = upsert.merge_rows(whole, upsert.with_text_keys(new)).drop("_action")
    names = ["run_id", "query_id", "video_id", "comment_id", "text", "likes", "lang"]
    read = lambda df: sorted(map(str, df.select(names).collect()))
    assert read(buckets.read(spark, path)) == read(whole)
    near = buckets.matching(spark, path, docs(spark, [1, 2]).select(*upsert.DOCUMENT_KEY))
    assert {r["comment_id"] for r in near.collect()} <= {"c1", "c2"}
    buckets.redeal(spark, path, str(tmp_path / "wider"), 32)
    assert read(buckets.read(spark, str(tmp_path / "wider"))) == read(whole)


def test_buckets_of_no_store_and_of_a_plain_table(spark, tmp_path):
    assert buckets.read(spark, str(tmp_path / "none")) is None
    assert buckets.matching(spark, str(tmp_path / "none"), docs(spark, [1])) is None
    docs(spark, [1]).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not dealt"):
        buckets.upsert(spark, str(tmp_path / "plain"), docs(spark, [1]))
    empty = buckets.upsert(spark, str(tmp_path / "new"), docs(spark, []).limit(0))
    assert empty["upserted_documents"] == 0


def test_backfill_in_place(spark, tmp_path):
    path = str(tmp_path / "store")
    tags = {"source_type": F.lit("dump"), "source_path": F.lit("a.json"), "position": F.lit(1).cast("bigint"), "mongo_loaded_at": F.lit("2026-01-01")}
    given = docs(spark, range(20)).withColumns(tags)
    assert jobs.backfill(spark, [given], path)["counts"]["upserted_documents"] == 20
    old = files(path)
    counts = jobs.backfill(spark, [given.filter("comment_id = 'c4'").withColumn("text", F.lit("new"))], path)["counts"]
    assert (counts["input_documents"], counts["matched_documents"], counts["modified_documents"], counts["buckets_written"]) == (1, 1, 1, 1)
    assert len(old - files(path)) == 1 and buckets.read(spark, path).count() == 20


# ------------------------------------------------------------------ dates

BRONZE = "comment_id string, comment_text string, collection_date string, comment_updated_at string, topic string, genre string, video_id string, ingested_at string"


def rows_of(spark, *rows):
    return spark.createDataFrame([(*r, "t", "g", "v", "2026-04-01T00:00:00") for r in rows], BRONZE.replace("comment_updated_at string, topic", "comment_updated_at string, topic"))


def silver_rows(df):
    return sorted((r["comment_id"], r["comment_text"], str(r["collection_date"])) for r in df.collect())


def test_changes_move_comments_between_dates_only(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = rows_of(spark, ("a", "a1", "2026-04-01", "2026-04-01"), ("b", "b1", "2026-04-01", "2026-04-01"), ("c", "c1", "2026-04-02", "2026-04-02"), ("d", "d1", "2026-04-03", "2026-04-03"))
    jobs.build_silver(spark, root, source=silver.union_bronze({"daily": first}))
    path = changes.CONTRACTS[changes.SILVER].path(root)
    before = files(path)
    new = rows_of(spark, ("c", "c2", "2026-04-04", "2026-04-05"), ("a", "old", "2026-04-09", "2025-01-01"), ("e", "e1", None, None), ("b", "b1", "2026-04-01", "2026-04-01"), (" ", "x", "2026-04-01", None))
    out = changes.apply_to_silver(spark, root, silver.union_bronze({"daily": new}))
    assert out["days"] == [None, "2026-04-02", "2026-04-04"] and out["rows_written"] == 2
    table = read_contract(spark, root, changes.SILVER)
    whole = silver.build_silver(silver.union_bronze({"daily": first.union(new)}))
    assert silver_rows(table) == silver_rows(whole)
    assert not os.path.exists(f"{path}/collection_date=2026-04-02")  # it lost its only comment
    kept = [f for f in before if "2026-04-01" in f or "2026-04-03" in f]
    assert set(kept) <= files(path)  # dates that did not change keep their files
    again = changes.apply_to_silver(spark, root, silver.union_bronze({"daily": new}))
    assert again["days"] == [] and again["rows_written"] == 0


def test_many_changes_equal_a_rebuild(spark, tmp_path):
    root, draw = str(tmp_path / "lake"), random.Random(3)
    drawn = lambda n: rows_of(spark, *[(f"c{draw.randrange(40)}", f"t{draw.randrange(9)}", f"2026-04-0{draw.randint(1, 6)}", f"2026-04-{draw.randint(1, 9):02d}") for _ in range(n)])
    parts = [drawn(60).cache(), drawn(20).cache(), drawn(20).cache()]
    jobs.build_silver(spark, root, source=silver.union_bronze({"daily": parts[0]}))
    for part in parts[1:]:
        changes.apply_to_silver(spark, root, silver.union_bronze({"daily": part}))
    whole = silver.build_silver(silver.union_bronze({"daily": parts[0].union(parts[1]).union(parts[2])}))
    assert silver_rows(read_contract(spark, root, changes.SILVER)) == silver_rows(whole)
    index = buckets.read(spark, changes.index_path(root))
    assert sorted((r["comment_id"], r["day"]) for r in index.collect()) == sorted((c, d) for c, _, d in silver_rows(whole))


# ------------------------------------------------------------------ states of days


def scored(spark, n=500):
    return spark.range(n).select(
        F.col("id").cast("string").alias("comment_id"),
        F.date_format(F.timestamp_seconds(F.lit(1775000000) + F.col("id") * 20000), "yyyy-MM-dd").alias("collection_date"),
        F.when(F.col("id") % 17 > 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("topic"), F.lit("g").alias("genre"), F.lit("p").alias("platform"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id") % 11)).alias("video_id"), (F.col("id") % 9 / 8 - 0.5).alias("sentiment_score"),
        F.when(F.col("id") % 9 > 5, "positive").otherwise("negative").alias("sentiment_label"), (F.col("id") % 13).alias("comment_like_count"))


def test_marts_from_states_equal_marts_from_comments(spark):
    comments = scored(spark).cache()
    states = marts.day_states(comments).cache()
    for name in marts.STATE_MARTS:
        want = getattr(marts, name)(comments)
        got = marts.from_states(states, name).select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    month = comments.withColumn("collection_date", F.concat(F.substring("collection_date", 1, 7), F.lit("-01")))
    want = {(r["collection_date"], r["topic"]): (r["comments_count"], r["videos_covered"], r["avg_sentiment_score"]) for r in marts.daily_trend(month).collect()}
    assert want == {(r["period_start"], r["topic"]): (r["comments_count"], r["videos_covered"], r["avg_sentiment_score"]) for r in marts.period_summary(states).collect()}
    with pytest.raises(ValueError):
        marts.day_states(comments, unique_ids=False)


# ------------------------------------------------------------------ offsets


def log_of(spark, *rows):
    data = [("comments", p, o, "k", json.dumps({"event_id": f"e{p}-{o}", "comment_id": f"c{p}-{o}", "comment_text": "x", "plan_date": f"2026-04-0{1 + o % 2}"})) for p, o in rows]
    return spark.createDataFrame(data, "topic string, partition bigint, offset bigint, key string, value string")


def ids(spark, root):
    return sorted(r["event_id"] for r in read_contract(spark, root, offsets.COMMENTS).collect())


def test_even_shares():
    assert offsets.even_shares({1: 10, 2: 1, 3: 5}, None) == {1: 10, 2: 1, 3: 5}
    assert offsets.even_shares({1: 10, 2: 1, 3: 5}, 9) == {1: 4, 2: 1, 3: 4}
    assert offsets.even_shares({1: 10, 2: 0, 3: 5}, 3) == {1: 2, 3: 1}
    assert offsets.even_shares({1: 2}, 0) == {} and offsets.even_shares({}, 5) == {}


def test_drain_takes_exactly_what_was_asked_for(spark, tmp_path):
    root = str(tmp_path / "lake")
    log = log_of(spark, *[(0, o) for o in range(0, 40, 2)], *[(1, o) for o in range(7)], (2, 99))
    assert offsets.drain_log(spark, log, root, "c", 10, AT) == {"status": "success", "messages_consumed": 10}
    assert offsets.drain_log(spark, log, root, "c", 7, AT)["messages_consumed"] == 7
    assert len(set(ids(spark, root))) == len(ids(spark, root)) == 17
    taken = {r["partition"]: (r["next_offset"], r["messages"]) for r in offsets.progress(spark, root, "c").collect()}
    assert taken[2] == (100, 1) and sum(n for _, n in taken.values()) == 17
    assert offsets.drain_log(spark, log, root, "c", None, AT)["messages_consumed"] == 11
    assert offsets.drain_log(spark, log, root, "c", 5, AT) == {"status": "empty", "messages_consumed": 0}
    assert offsets.drain_log(spark, log, root, "other", 3, AT)["messages_consumed"] == 3
    assert len(ids(spark, root)) == 31
    runs = read_contract(spark, root, offsets.RUNS)
    assert runs.agg(F.sum("messages_consumed")).first()[0] == 31


def test_a_broken_drain_is_done_again_over_its_own_ranges(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    log = log_of(spark, *[(0, o) for o in range(6)])
    write, calls = offsets.overwrite, []

    def fails_late(*a, **b):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write(*a, **b)

    monkeypatch.setattr(offsets, "overwrite", fails_late)
    with pytest.raises(RuntimeError, match="lost"):
        offsets.drain_log(spark, log, root, "c", 4, AT)
    monkeypatch.setattr(offsets, "overwrite", write)
    assert len(ids(spark, root)) == 4  # written, not marked as done
    more = log.unionByName(log_of(spark, *[(0, o) for o in range(6, 9)]))
    assert offsets.drain_log(spark, more, root, "c", 5, AT)["messages_consumed"] == 5
    assert ids(spark, root) == [f"e0-{o}" for o in range(5)]
    assert offsets.drain_log(spark, more, root, "c", None, AT)["messages_consumed"] == 4


# ------------------------------------------------------------------ a stream of versions


def test_stream_of_versions_equals_the_batch_table(spark, tmp_path):
    source, store, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))
    draw = random.Random(8)
    parts = []
    for _ in range(3):
        rows = [(f"c{draw.randrange(12)}", f"t{draw.randrange(5)}", f"2026-04-0{draw.randint(1, 6)}", draw.choice([None, *[f"2026-04-{d:02d}T01:02:03.000004" for d in range(1, 9)]])) for _ in range(15)]
        parts.append(rows_of(spark, *rows).withColumn("source_table", F.lit("daily")).coalesce(1))
    schema = parts[0].schema
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(source)
    for part in parts[:2]:
        part.write.mode("append").parquet(source)
    latest.drain_latest(read(), store, checkpoint, dealt=4)
    parts[2].write.mode("append").parquet(source)
    latest.drain_latest(read(), store, checkpoint, dealt=4)  # a restart from the checkpoint
    seen = spark.read.schema(schema).parquet(source)
    names = ["comment_id", "comment_text", "collection_date", "comment_updated_at", "ingested_at", "topic"]
    show = lambda df: sorted(map(str, df.select(names).collect()))
    assert show(latest.read_latest(spark, store)) == show(silver.build_silver(seen))
    old = rows_of(spark, ("c1", "older than all", "2026-04-01", "2020-01-01")).withColumn("source_table", F.lit("daily"))
    old.write.mode("append").parquet(source)
    assert latest.drain_latest(read(), store, checkpoint, dealt=4) == {"upserted_documents": int(not seen.filter("comment_id = 'c1'").count()), "modified_documents": 0, "buckets_written": int(not seen.filter("comment_id = 'c1'").count())}


@pytest.mark.parametrize("keep", [None, 3600])
def test_stream_of_versions_gives_out_newer_ones_alone(spark, tmp_path, monkeypatch, keep):
    source = str(tmp_path / "in")
    given = []

    def seen(spark, path, batch, keys, dealt):
        given.append(sorted((r["comment_id"], r["comment_text"]) for r in batch.collect()))
        return dict.fromkeys(("upserted_documents", "modified_documents", "buckets_written"), 0)

    monkeypatch.setattr(buckets, "upsert", seen)
    new = ("c1", "new", "2026-04-02", "2026-04-02")
    steps = [
        [new, ("c1", "old", "2026-04-01", "2026-04-01"), ("c2", "a", "2026-04-01", None)],
        [new, ("c1", "older", "2026-04-03", "2026-03-01"), ("c3", "b", "2026-04-01", None)],
        [("c2", "edited", "2026-04-01", "2026-04-05"), ("c2", "edited before", "2026-04-01", "2026-04-04"), new],
    ]
    # Without this, a drain with timed state goes on with empty micro-batches and never ends.
    idle = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(idle, "false")
    try:
        for step in steps:
            rows = rows_of(spark, *step).withColumn("source_table", F.lit("daily")).coalesce(1)
            rows.write.mode("append").parquet(source)
            latest.drain_latest(spark.readStream.schema(rows.schema).parquet(source), "", str(tmp_path / "checkpoint"), keep)
    finally:
        spark.conf.unset(idle)
    assert given == [[("c1", "new"), ("c2", "a")], [("c3", "b")], [("c2", "edited")]]


def test_stream_of_versions_keeps_its_state_without_python(spark, tmp_path):
    """A processor in Python asks for the state of a comment at a time, which no large table can wait for."""
    rows = rows_of(spark, ("c1", "a", "2026-04-01", None)).withColumn("source_table", F.lit("daily"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    plan = latest.latest_changes(stream)._jdf.queryExecution().analyzed().toString()
    assert "max_by" in plan and "TransformWithState" not in plan


def test_modules_name_the_same_tables():
    assert (events.COMMENTS, events.RUNS) == (offsets.COMMENTS, offsets.RUNS)
    assert jobs.SILVER == changes.SILVER and jobs.SCORED == changes.SCORED and bronze and latest.KEY == changes.KEY[0]


# ------------------------------------------------------------------ the document store's connector


def test_connector_commits_whole_writes(spark, tmp_path):
    from voxlake.sources import connector

    path = str(tmp_path / "store")
    day = lambda ids, text, d: docs(spark, ids, text).withColumn("collection_date", F.lit(d))
    connector.write_documents(day(range(6), "a", "2026-04-01").unionByName(day(range(6, 9), "a", "2026-04-02")).repartition(3), path)
    connector.write_documents(day([2, 20], "b", "2026-04-03").drop("likes"), path)
    everything = connector.read_documents(spark, path)
    assert everything.count() == 11 and set(everything.columns) == {*DOCS.replace(" string", "").replace(" bigint", "").split(", "), "collection_date", "_sequence"}
    current = {r["comment_id"]: (r["text"], r["likes"]) for r in connector.current_documents(spark, path).collect()}
    assert len(current) == 10 and current["c2"] == ("b", None) and current["c3"] == ("a", 1)
    near = connector.read_documents(spark, path, only="2026-04-03")
    assert near.rdd.getNumPartitions() < everything.rdd.getNumPartitions() and near.count() == 2
    assert connector.read_documents(spark, path, only="1999-01-01").count() == 0 and everything.count() == 11


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    from voxlake.sources import connector

    path = str(tmp_path / "store")
    connector.write_documents(docs(spark, range(4)), path)
    seen = files(path)
    bad = docs(spark, range(100)).repartition(4).withColumn("likes", F.when(F.col("comment_id") == "c77", F.raise_error(F.lit("broken"))).otherwise(F.col("likes")))
    with pytest.raises(Exception, match="broken"):
        connector.write_documents(bad, path)
    assert files(path) == seen and len(os.listdir(f"{path}/commits")) == 1
    assert connector.read_documents(spark, path).count() == 4
    with pytest.raises(Exception, match="added to"):
        docs(spark, [1]).write.format(connector.FORMAT).option("path", path).mode("overwrite").save()
    connector.write_documents(docs(spark, [1]).limit(0), path)
    assert connector.read_documents(spark, path).count() == 4


def test_a_task_that_outlives_its_write_leaves_nothing(tmp_path):
    """The write fails while one of its tasks goes on: what that one writes later has no folder to go to."""
    from voxlake.sources import connector

    path = str(tmp_path / "store")
    writer = connector.document_source()({"path": path}).writer(None, False)
    batch = pa.RecordBatch.from_pydict({"comment_id": ["c1"], "collection_date": ["2024-01-01"]})
    writer.write(iter([batch]))
    assert files(path)
    writer.abort([])
    with pytest.raises(RuntimeError, match="given up"):
        writer.write(iter([batch]))
    assert not files(path)


def test_ranges_go_to_the_log(spark, tmp_path):
    """The log stays where it is read: met by topic and partition it would come to a task for each partition."""
    log = spark.range(1000).selectExpr("'t' AS topic", "id % 2 AS partition", "id AS offset", "'k' AS key", "'v' AS value")
    ranges = spark.createDataFrame([("t", 0, 0, 100, 50), ("t", 1, 0, 50, 25)], "topic string, partition bigint, first_offset bigint, end_offset bigint, messages bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = offsets.messages_of(log, ranges)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert found.count() == 75
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_logs_are_written_compressed_in_bounded_files(spark, tmp_path):
    from catalog import bronze_cases

    log = spark.range(0, 1000, 1, 1).selectExpr("'t' AS topic", "0L AS partition", "id AS offset", "'k' AS key", "repeat('v', 500) AS value")
    was, bronze_cases._FILE_MESSAGES = bronze_cases._FILE_MESSAGES, 400
    try:
        bronze_cases.write_log(log, str(tmp_path / "log"))
    finally:
        bronze_cases._FILE_MESSAGES = was
    files = [f for f in (tmp_path / "log").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 100_000
    assert spark.read.schema(log.schema).json(str(tmp_path / "log")).exceptAll(log).isEmpty()
