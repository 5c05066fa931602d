import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS, align
from voxlake.operators import bronze
from voxlake.plans import jobs
from voxlake.sinks import upsert
from voxlake.sinks.tables import write_contract
from voxlake.sources import docstore, documents
from voxlake.sources.tables import comment_level_source, load_marts, read_contract, read_if_exists

AT = "2026-04-16T10:00:00+00:00"
COMMENTS = [
    {"query_id": "q1", "video_id": "v1", "video_title": "T", "channel_title": "C", "thread_id": "t1", "comment_id": "c1",
     "comment_text": " hi ", "comment_published_at": "2026-04-15T00:00:00Z", "author_name": "Ann", "like_count": "3.7",
     "reply_count": 2, "extra": {"a": [1]}},
    {"query_id": " q1 ", "video_id": "", "title": "Old", "comment_id": "c2", "text": "yo", "like_count": "abc", "topic": "own"},
]
PLAN = [{"query_id": "q1", "query_text": "best phones", "topic": "phones", "genre": "tech", "cadence": "daily",
         "priority": 8, "expected_units": 100, "language_target": "en"}]


@pytest.fixture
def run_folder(tmp_path):
    folder = tmp_path / "raw" / "daily-20260416"
    folder.mkdir(parents=True)
    (folder / "normalized_comments.json").write_text(json.dumps(COMMENTS))
    plan = tmp_path / "plan.json"
    plan.write_text(json.dumps(PLAN))
    (folder / "manifest.json").write_text(
        json.dumps({"run_id": "daily-20260416", "generated_at": "2026-04-16T09:00:00+00:00", "plan_path": str(plan),
                    "normalized_comments_path": str(folder / "normalized_comments.json"), "queries_executed": 1,
                    "total_comments_collected": 2, "error_count": 0})
    )
    return tmp_path


def sources(spark, root):
    records = documents.read_run_records(spark, f"{root}/raw/*/normalized_comments.json")
    manifests = documents.read_manifests(spark, f"{root}/raw/*/manifest.json")
    return records, manifests, documents.read_plan(spark, f"{root}/plan.json")


def test_manifest_bundle_to_bronze(spark, rows, run_folder):
    records, manifests, plan = sources(spark, run_folder)
    a, b = rows(bronze.records_to_bronze(records, manifests, plan, AT), "comment_id")
    assert (a["topic"], a["genre"], a["priority"], a["language_target"]) == ("phones", "tech", 8, "en")
    assert (a["comment_text"], a["comment_like_count"], a["reply_count"], a["author_display_name"]) == ("hi", 3, 2, "Ann")
    assert a["video_url"].endswith("watch?v=v1") and a["collection_date"] == "2026-04-16"
    assert json.loads(a["raw_record_json"]) == COMMENTS[0]
    assert (b["topic"], b["video_title"], b["comment_text"], b["comment_like_count"]) == ("own", "Old", "yo", 0)
    assert (b["video_url"], b["query_id"], b["run_id"]) == ("", "q1", "daily-20260416")


def test_daily_job_logs_and_repeats_add_nothing(spark, rows, run_folder, tmp_path):
    records, manifests, plan = sources(spark, run_folder)
    root = str(tmp_path / "lake")
    first = jobs.bronze_daily(spark, root, records, manifests, plan, AT)
    again = jobs.bronze_daily(spark, root, records, manifests, plan, AT)
    assert (first["comments_records_written"], again["comments_records_written"]) == (2, 0)
    assert read_contract(spark, root, jobs.DAILY).count() == 2
    log = rows(read_contract(spark, root, "bronze.daily_ingestion_runs"))
    assert sorted((r["ingested_records"], r["queries_executed"], r["status"]) for r in log) == [(0, 1, "success"), (2, 1, "success")]


@pytest.mark.parametrize("payload", [COMMENTS + [5, None, "x"], {"comments": COMMENTS}, {"records": COMMENTS}])
def test_document_shapes(spark, tmp_path, payload):
    path = tmp_path / "r1" / "normalized_comments.json"
    path.parent.mkdir()
    path.write_text(json.dumps(payload))
    found = documents.read_run_records(spark, str(path)).orderBy("position").collect()
    assert [(r["position"], r["comment_id"], r["run_folder"]) for r in found] == [(1, "c1", "r1"), (2, "c2", "r1")]


def test_other_shapes_fail(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"items": []}')
    with pytest.raises(PySparkException, match="unsupported comment document"):
        documents.read_run_records(spark, str(tmp_path / "x.json")).collect()


@pytest.mark.parametrize("payload", [PLAN, {"plan_version": "v2", "selected_queries": PLAN, "deferred_queries": []}])
def test_plan_as_list_and_as_object(spark, tmp_path, payload):
    (tmp_path / "plan.json").write_text(json.dumps(payload))
    (row,) = documents.read_plan(spark, str(tmp_path / "plan.json")).collect()
    assert (row["query_id"], row["priority"], row["genre"]) == ("q1", "8", "tech")


def test_latest_run(spark):
    df = spark.createDataFrame([("raw/daily-2/m", "b"), ("raw/daily-1/m", "a")], "manifest_path string, run_id string")
    assert [r["run_id"] for r in documents.latest_run(df).collect()] == ["b"]
    with pytest.raises(Exception, match="no run found"):
        documents.latest_run(df.limit(0)).collect()


def test_documents_of_any_shape_and_size(spark, tmp_path):
    """Larger than one variant value may be: a list, and both objects, one with a second list that does not count."""
    record = json.dumps({"comment_id": "c", "text": "x" * 100_000, "nested": {"b": [1, {"a": 2}], "a": "]},"}})
    many = ",\n ".join([record] * 1400)
    shapes = {"list": f"[{many}, 7, null]", "comments": f'{{"records": [], "n": {{"comments": 1}}, "comments": [{many}]}}', "records": f'{{"records": [{many}]}}'}
    for name, text in shapes.items():
        (tmp_path / f"daily-{name}").mkdir()
        (tmp_path / f"daily-{name}" / "comments.json").write_text(text)
        found = documents.read_run_records(spark, f"{tmp_path}/daily-{name}/*.json")
        (row,) = found.groupBy("run_folder").agg({"position": "max", "comment_id": "count"}).collect()
        assert tuple(row) == (f"daily-{name}", 1400, 1400)
    first = documents.read_run_records(spark, f"{tmp_path}/daily-records/*.json").select("raw_record_json").first()[0]
    assert json.loads(first) == json.loads(record)


@pytest.mark.parametrize("text", ['{"other": []}', "[1, 2", '{"comments": [{}] "x": 1}', "  ", "no"])
def test_unreadable_documents_raise(spark, tmp_path, text):
    (tmp_path / "broken.json").write_text(text)
    for read in (documents.read_run_records, documents.read_plan):
        with pytest.raises(Exception, match="unsupported|no JSON document"):
            read(spark, str(tmp_path / "broken.json")).collect()


def test_newest_of_five_versions(spark):
    rows = [("r", "q", "v", "c", "2026-01-09", f"2026-01-0{day}T00:00:00Z", "2026-02-01", f"text {day}") for day in (3, 1, 5, 2, 4)]
    names = "run_id string, query_id string, video_id string, comment_id string, collection_date string, comment_updated_at string, mongo_loaded_at string, comment_text string"
    (row,) = bronze.documents_to_bronze(spark.createDataFrame(rows, names), AT).collect()
    assert row["comment_text"] == "text 5"


THREAD = {
    "_id": {"$oid": "1"}, "source": "youtube", "video_id": "v1", "thread_id": "thread_1", "language_target": "en",
    "fetched_at": {"$date": "2026-04-01T00:00:00Z"},
    "top_level_comment": {"comment_id": "thread_1", "author_channel_id": "a1", "text": "Top", "like_count": 4,
                          "detected_language": ["Other", {"LangDetect": "en"}], "published_at": "2026-03-01T00:00:00Z"},
    "replies": [{"comment_id": "reply_1", "author_channel_id": "a2", "text": "Re", "like_count": None,
                 "published_at": "2026-03-02T00:00:00Z", "detected_language": ["short"]}, {"comment_id": " ", "text": "blank"}],
    "raw_snippet": {"snippet": {"channelId": "ch1", "topLevelComment": {"snippet": {"authorDisplayName": "Ann"}}}},
}


def test_thread_flatten_and_documents(spark, rows, tmp_path):
    (tmp_path / "dump.json").write_text(json.dumps([THREAD, {"thread_id": "bare", "replies": None}]))
    threads = documents.read_threads(spark, str(tmp_path / "dump.json"))
    flat = {r["comment_id"]: r for r in rows(bronze.flatten_threads(threads, "run"))}
    top, reply = flat["thread_1"], flat["reply_1"]
    assert (top["record_type"], top["reply_count"], top["author_name"], top["channel_id"]) == ("top_level", 2, "Ann", "ch1")
    assert (top["detected_language_label"], top["detected_language_code"]) == ("Other", "en")
    assert (reply["record_type"], reply["parent_comment_id"], reply["author_name"], reply["like_count"]) == (
        "reply", "thread_1", None, 0)
    assert reply["detected_language_label"] is None and reply["fetched_at"] == "2026-04-01T00:00:00Z"
    docs = rows(bronze.threads_to_documents(threads, AT), "comment_id")
    assert [(d["comment_id"], d["comment_level"], d["collection_date"], d["run_id"]) for d in docs] == [
        ("reply_1", "reply", "2026-04-01", "backfill-dump"), ("thread_1", "top_level", "2026-04-01", "backfill-dump")]


def test_event_defaults_and_round_trip(spark, rows):
    schema = "run_id string, query_id string, topic string, comment_id string, comment_like_count string, position bigint, plan_date string"
    records = spark.createDataFrame([("r", "q", "t", "c1", None, 1, "2026-04-16T00:00:00"), ("r", "q", None, None, "3.7", 2, None)], schema)
    events = bronze.build_events(records, None, "p", AT)
    first, second = (json.loads(r["value"]) for r in events.orderBy("key").collect())
    assert (first["event_id"], second["event_id"]) == ("p:c1", "p:unknown-comment-2")
    assert first["payload"]["video_title"] == "" and first["payload"]["comment_like_count"] == 0
    assert second["payload"]["comment_like_count"] == 0
    messages = events.select(F.lit("comments").alias("topic"), F.lit(0).alias("partition"), F.lit(14).alias("offset"), "key", "value")
    a, b = rows(bronze.envelopes_to_bronze(messages, AT), "event_id")
    assert (a["collection_date"], a["kafka_offset"], a["ingestion_type"], a["topic"]) == ("2026-04-16", 14, "youtube_kafka_to_bronze", "t")
    assert (b["collection_date"], b["topic"], b["comment_id"]) == ("", "", "")


def test_keys_with_separators_do_not_collide(spark):
    schema = ", ".join(f"{k} string" for k in upsert.DOCUMENT_KEY)
    have = spark.createDataFrame([("a||b", "c", "d", "e")], schema)
    new = spark.createDataFrame([("a", "b||c", "d", "e"), ("a||b", "c", "d", "e"), (None, "c", "d", "e")], schema)
    left = {tuple(r) for r in bronze.missing_from(new, have).collect()}
    assert left == {("a", "b||c", "d", "e"), (None, "c", "d", "e")}


def test_upsert_actions(spark, rows):
    schema = "run_id string, query_id string, video_id string, comment_id string, text string, at int"
    stored = spark.createDataFrame([("r", "q", "v", "1", "a"), ("r", "q", "v", "2", "b"), ("r", "q", "v", "3", "c")], schema[:-8])
    given = spark.createDataFrame(
        [("r", "q", "v", "1", "a", 1), ("r", "q", "v", "2", "old", 1), ("r", "q", "v", "2", "new", 2), ("r", "q", "v", "4", "d", 1),
         ("r", "q", "v", "", "x", 1)], schema)
    merged = upsert.merge_rows(stored, upsert.upsertable(given, [F.col("at").desc()]).drop("at"))
    assert [(r["comment_id"], r["text"], r["_action"]) for r in rows(merged, "comment_id")] == [
        ("1", "a", "matched"), ("2", "new", "modified"), ("3", "c", None), ("4", "d", "upserted")]
    assert rows(upsert.merge_counts(merged, 5)) == [
        {"input_documents": 5, "matched_documents": 2, "modified_documents": 1, "upserted_documents": 1}]


def test_backfill_twice_changes_nothing(spark, tmp_path):
    (tmp_path / "dump.json").write_text(json.dumps([THREAD]))
    threads = documents.read_threads(spark, str(tmp_path / "dump.json"))
    docs = bronze.threads_to_documents(threads, AT).withColumns(
        {"source_type": F.lit("legacy_dump"), "source_path": F.col("source_file_path"), "position": F.lit(1).cast("bigint")})
    first, second = str(tmp_path / "s1"), str(tmp_path / "s2")
    dry = jobs.backfill(spark, [docs], str(tmp_path / "none"), first, dry_run=True)
    assert dry["sources"].collect()[0]["documents_prepared"] == 2 and "counts" not in dry
    assert jobs.backfill(spark, [docs], str(tmp_path / "none"), first)["counts"] == {
        "input_documents": 2, "matched_documents": 0, "modified_documents": 0, "upserted_documents": 2}
    assert jobs.backfill(spark, [docs], first, second)["counts"] == {
        "input_documents": 2, "matched_documents": 2, "modified_documents": 0, "upserted_documents": 0}
    assert spark.read.parquet(second).count() == 2


def test_document_store_job_dry_run_and_limit(spark, tmp_path):
    root = str(tmp_path / "lake")
    docs = spark.createDataFrame(
        [("2026-04-01", "r", "q", "v", f"c{i}", "5") for i in range(4)] + [("2026-04-02", "r", "q", "v", "c9", "1")],
        "collection_date string, run_id string, query_id string, video_id string, comment_id string, like_count string")
    dry = jobs.bronze_collection(spark, root, docs, "store", dry_run=True, at=AT)
    assert (dry["comments_records_to_write"], dry["comments_records_written"]) == (5, 0)
    assert read_if_exists(spark, CONTRACTS[jobs.DAILY].path(root)) is None
    part = jobs.bronze_collection(spark, root, docs, "store", "2026-04-01", 3, at=AT)
    assert (part["documents_read"], part["comments_records_written"]) == (3, 3)
    rest = jobs.bronze_collection(spark, root, docs, "store", at=AT)
    assert (rest["existing_bronze_matches"], rest["comments_records_written"]) == (3, 2)


def test_scan_without_limit_is_not_sorted(spark):
    df = spark.range(5).selectExpr("string(id) AS collection_date", "'r' AS run_id", "'q' AS query_id", "'v' AS video_id", "'c' AS comment_id")
    assert "Sort" not in docstore.scan_collection(df)._jdf.queryExecution().executedPlan().toString()
    assert docstore.scan_collection(df, "3").count() == 1


def test_alignment(spark, rows):
    df = spark.createDataFrame([("7", 3.0, "x"), ("3.7", 3.5, "y"), ("z", None, "w")], "like_count string, reply_count double, text string")
    out = rows(align(df, CONTRACTS["bronze.youtube_comments_raw"]), "text")
    assert [(r["like_count"], r["reply_count"]) for r in out] == [(None, None), (7, 3), (None, None)]  # z/null, 7/3.0, 3.7/3.5
    assert list(out[0]) == [f.name for f in CONTRACTS["bronze.youtube_comments_raw"].schema]


def test_contract_write_refuses_empty_and_unknown_mode(spark, tmp_path):
    empty = spark.createDataFrame([], "topic string")
    with pytest.raises(ValueError, match="nothing to write"):
        write_contract(empty, jobs.SCORED, str(tmp_path))
    with pytest.raises(ValueError, match="unknown mode"):
        write_contract(spark.createDataFrame([("t",)], "topic string"), jobs.SCORED, str(tmp_path), "merge")


def test_tiers_and_bundle_on_an_empty_lakehouse(spark, tmp_path, run_folder):
    root = str(tmp_path / "lake")
    assert comment_level_source(spark, root) is None
    raw = comment_level_source(spark, root, f"{run_folder}/raw/*/normalized_comments.json")
    assert raw.count() == 2
    bundle = load_marts(spark, root)
    assert len(bundle) == 14 and bundle["comments"].count() == 0
    assert "run_date_label" in bundle["collection"].columns


def test_batched_writes(spark):
    def deliver(batch):
        assert len(batch) <= 3
        return len(batch)

    out = upsert.write_in_batches(spark.range(10).repartition(1), deliver, 3).collect()
    assert [(r["batches"], r["documents"]) for r in out] == [(4, 10)]


def test_a_large_list_document_is_read_by_spark_alone(spark, tmp_path):
    """200 MB in one file; no Python worker takes part."""
    record = json.dumps({"comment_id": "c", "text": "x" * 1900, "nested": {"b": [1, 2], "a": None}})
    with open(tmp_path / "big.json", "w") as out:
        out.write('{"meta": 1, "comments": [' + ",".join([record] * 105_000) + "]}")
    assert (tmp_path / "big.json").stat().st_size > 200_000_000
    found = documents.read_run_records(spark, str(tmp_path / "big.json"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    assert found.select("comment_id", "text").groupBy("comment_id").count().collect()[0]["count"] == 105_000


def test_shapes_of_documents(spark, tmp_path):
    cases = {
        "a": '[{"comment_id": "1"}, 5, null, [], {"comment_id": "2", "x": {"k": 1}}]',
        "b": '﻿ {"records": [{"comment_id": "3"}], "comments": {"not": "a list"}}',
        "c": '{"comments": [{"comment_id": "4"}], "records": [{"comment_id": "no"}]}',
        "d": "",
    }
    for name, text in cases.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    rows = documents.read_run_records(spark, f"{tmp_path}/*.json").collect()
    assert sorted((r["comment_id"], r["position"]) for r in rows) == [("1", 1), ("2", 5), ("3", 1), ("4", 1)]
    assert next(r for r in rows if r["comment_id"] == "2")["raw_record_json"] == '{"comment_id":"2","x":{"k":1}}'
    (tmp_path / "m.txt").write_text('{"run_id": 7, "plan_path": ["x"], "queries_executed": 3, "other": [{"deep": 1}]}')
    (found,) = documents.read_manifests(spark, f"{tmp_path}/m.txt").collect()
    assert (found["run_id"], found["plan_path"], found["queries_executed"], found["error_count"]) == ("7", None, "3", None)


def test_lists_with_an_element_a_line_are_split(spark, tmp_path):
    one = lambda i: {"thread_id": f"t{i}", "video_id": "a ] b", "replies": [{"comment_id": "x", "text": "},\n{[,"}]}
    texts = [json.dumps(one(i)) for i in range(400)]
    plain = {"split": "[{}\n" + "".join(f",{t}\n" for t in texts) + "]\n", "ends": "[\n" + ",\n".join(f" {t}" for t in texts) + "\n]"}
    shared = {
        "pretty": json.dumps([one(i) for i in range(400)], indent=1),
        "single": json.dumps([one(i) for i in range(400)]),
        "broken": "[" + ",\n".join(t.replace(' [{"comment_id"', '\n[{"comment_id"') for t in texts) + "]",
        "pairs": "[" + ",\n".join(f"{a},{b}" for a, b in zip(texts[::2], texts[1::2], strict=True)) + "]",
    }
    (tmp_path / "a b").mkdir()
    for name, text in {**plain, **shared}.items():
        (tmp_path / "a b" / f"{name}.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        for name in [*plain, *shared]:
            found = documents.read_threads(spark, str(tmp_path / "a b" / f"{name}.json")).filter("thread_id is not null")
            assert sorted((r["thread_id"], r["video_id"], r["replies"][0]["text"]) for r in found.collect()) == sorted((f"t{i}", "a ] b", "},\n{[,") for i in range(400)), name
            assert (found.select(F.spark_partition_id()).distinct().count() > 1) == (name in plain), name
        whole = documents.read_threads(spark, str(tmp_path / "a b")).filter("thread_id is not null")
        assert {tuple(r) for r in whole.groupBy("source_path").count().select("count").distinct().collect()} == {(400,)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
