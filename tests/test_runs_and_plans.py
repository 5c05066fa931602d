import random

import pytest
from pyspark.sql import functions as F

from voxlake.operators import filters, planning, prescriptive, runs

ALIASES = {"technology": {"smartphones": ["smartphone", "phone", "iphone"], "ai_tools": ["ai", "chatgpt"]}, "sports": {"cricket": ["ipl", "test match"]}}


def queries(spark, *changes):
    base = {"run_date": "2026-04-01", "run_id": "r", "plan_date": "2026-04-01", "query_id": "q1", "query_text": "t",
            "topic": "a", "genre": "g", "expected_units": 10, "videos_count": 2, "comments_count": 3, "created_at": "x"}
    schema = ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in base.items())
    return spark.createDataFrame([{**base, **c} for c in changes], schema)


def failures(spark, *data):
    return spark.createDataFrame(list(data), "run_id string, query_id string, position bigint, error string")


def test_outcomes_and_messages(spark, rows):
    q = queries(spark, {}, {"query_id": "q2"}, {"query_id": "q3", "comments_count": 0}, {"query_id": "q4", "comments_count": 0})
    e = failures(spark, ("r", "q2", 2, "late"), ("r", "q2", 1, "early"), ("r", "q3", 1, None), ("other", "q1", 1, "not here"))
    out = {r["query_id"]: r for r in rows(runs.ingestion_runs(q, e))}
    assert {k: r["status"] for k, r in out.items()} == {"q1": "success", "q2": "partial_success", "q3": "failed", "q4": "no_data"}
    assert out["q2"]["error_message"] == "early; late" and out["q3"]["error_message"] == "unknown_error"
    assert out["q1"]["error_message"] == "" and out["q2"]["error_count"] == 2


def test_overview_row(spark, rows):
    q = queries(spark, {"comments_count": 20}, {"query_id": "q2", "topic": "b", "comments_count": 40}, {"query_id": "q3", "comments_count": 0})
    perf = runs.query_performance(q, failures(spark))
    (row,) = rows(runs.run_overview(runs.collection_daily_summary(perf), perf))
    assert (row["queries_executed"], row["successful_queries"], row["no_data_queries"], row["failed_queries"]) == (3, 2, 1, 0)
    assert (row["topics_covered"], row["genres_covered"], row["total_records_written"]) == (2, 1, 60)


def test_overview_without_query_rows(spark, rows):
    perf = runs.query_performance(queries(spark, {}), failures(spark))
    (row,) = rows(runs.run_overview(runs.collection_daily_summary(perf), perf.limit(0)))
    assert (row["successful_queries"], row["unique_queries_seen"]) == (0, 0)


def registry(spark, data):
    return spark.createDataFrame(data, "platform string, query_id string, priority int, expected_units bigint")


def greedy(data, budget):
    used, taken = {}, set()
    for p, q, prio, units in sorted(data, key=lambda r: (-r[2], r[3], r[1])):
        if used.get(p, 0) + units <= budget:
            used[p] = used.get(p, 0) + units
            taken.add((p, q))
    return taken


def test_budget_skips_and_goes_on(spark, rows):
    data = [("youtube", "q1", 10, 600), ("youtube", "q2", 9, 500), ("youtube", "q3", 8, 300)]
    plan = planning.plan_within_budget(registry(spark, data), 1000)
    assert [(r["query_id"], r["status"]) for r in rows(plan, "query_id")] == [
        ("q1", "selected"), ("q2", "deferred_budget_limit"), ("q3", "selected")]
    (row,) = rows(planning.plan_summary(plan, 1000))
    assert (row["total_queries_selected"], row["total_queries_deferred"], row["leftover_budget"]) == (2, 1, 100)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_budget_equals_greedy_with_one_hot_cost(spark, seed):
    rng = random.Random(seed)
    data = [(f"p{rng.randrange(2)}", f"q{i}", rng.randint(1, 10), 7 if i % 3 == 0 else rng.randint(1, 300)) for i in range(900)]
    plan = planning.plan_within_budget(registry(spark, data), 500).collect()
    assert {(r["platform"], r["query_id"]) for r in plan if r["status"] == "selected"} == greedy(data, 500)
    assert len(plan) == len(data)


def test_constraints(spark, rows):
    df = spark.createDataFrame([("q1", "ab", 0, 5, None), ("q2", "fine text", 3, 5, 51), ("q3", "fine text", 3, 5, None)],
                               "query_id string, query_text string, priority int, expected_units bigint, search_results_limit int")
    good, bad = planning.validated(planning.with_defaults(df))
    assert [(r["query_id"], r["search_results_limit"], r["lookback_days"], r["cadence"]) for r in good.collect()] == [("q3", 5, 7, "daily")]
    assert {r["query_id"]: len(r["violations"]) for r in bad.collect()} == {"q1": 2, "q2": 1}


TYPED = ["Best iPhone 17", "AI", "phone", "budget phone review", "ipl", "match", "zzz", "a", "a i", "test  match day", "", "  "]


def brute_alias(text):
    text = " ".join(text.split()).lower()
    for genre, topics in ALIASES.items():
        for topic, names in topics.items():
            for name in names:
                if name in text or text in name:
                    return topic, genre
    return None


def test_alias_resolution_equals_brute_force(spark):
    df = spark.createDataFrame([(t,) for t in TYPED], "query_text string")
    got = {r["query_text"]: (r["resolved_topic"], r["resolved_genre"]) for r in planning.resolve_aliases(df, ALIASES).collect()}
    for text in TYPED:
        match = brute_alias(text)
        assert got[text] == match if match else got[text][1] == "custom", text


def test_no_dictionary_and_explicit_values(spark, rows):
    df = spark.createDataFrame([("budget phone review", None, None), ("phone", "My Topic", "My Genre")], "query_text string, topic string, genre string")
    out = {r["query_text"]: r for r in rows(planning.resolve_aliases(df, {}))}
    assert out["budget phone review"]["resolved_topic"] == "budget_phone_review"
    assert out["phone"]["resolved_topic"] == "my_topic" and out["phone"]["resolved_genre"] == "my_genre"


def test_registry_upsert_creates_then_updates(spark, rows):
    empty = spark.createDataFrame([], "query_id string, platform string, topic string, genre string, query_text string, priority int, expected_units bigint")
    new = lambda text, priority: spark.createDataFrame([("youtube", text, priority, 100)], "platform string, query_text string, priority int, expected_units bigint")
    (first,) = rows(planning.upsert_queries(empty, new("Budget  phone review", 6), {}))
    assert (first["action"], first["query_id"]) == ("created", "yt-custom-budget_phone_review-budget_phone_review")
    known = planning.upsert_queries(empty, new("Budget  phone review", 6), {}).drop("action")
    (second,) = rows(planning.upsert_queries(known, new("budget phone REVIEW", 9), ALIASES))
    assert (second["action"], second["query_id"], second["priority"], second["topic"]) == ("updated", first["query_id"], 9, "smartphones")


def test_typed_query(spark, rows):
    typed = spark.createDataFrame([(" iPhone case ",), ("",)], "query_text string")
    known = spark.createDataFrame([("q", "Smartphones", "Technology")], "query_id string, topic string, genre string")
    blank, hit = rows(planning.resolve_analysis(typed, ALIASES, known), "raw_query")
    assert (hit["matched_topic"], hit["matched_genre"], hit["matched_alias"]) == ("smartphones", "technology", "phone")
    assert blank["matched_topic"] is None


def test_newest_distinct(spark, rows):
    df = spark.createDataFrame([("q", "a", 1), ("q", "a", 9), ("q", "b", 5), ("q", "c", 3), ("q", " ", 8), ("p", "a", 2)], "g string, v string, t int")
    out = rows(planning.newest_distinct(df, ["g"], "v", "t", 2), "g", "v")
    assert [(r["g"], r["v"], r["t"]) for r in out] == [("p", "a", 2), ("q", "a", 9), ("q", "b", 5)]


def test_facets_are_inclusive_for_runs_and_half_open_for_comments(spark):
    facets = filters.Facets(start="2026-04-01", end="2026-04-02")
    run = spark.createDataFrame([("2026-03-31",), ("2026-04-01",), ("2026-04-02",), ("2026-04-03",), ("bad",)], "run_date string")
    assert filters.filter_runs(run, facets).count() == 2
    moments = ["2026-03-31T23:59:59Z", "2026-04-01T00:00:00Z", "2026-04-02T23:59:59Z", "2026-04-03T00:00:00Z"]
    rows = spark.createDataFrame([(m,) for m in moments], "comment_published_at string")
    assert filters.filter_comments(rows, facets).count() == 2
    naive = rows.select(F.col("comment_published_at").cast("timestamp_ntz").alias("comment_published_at"))
    assert filters.filter_comments(naive, facets).count() == 2


def test_scope_modes(spark):
    run = spark.createDataFrame([("phones", "tech")], "topic string, genre string")
    query = spark.createDataFrame([("cars", "auto", "best cars of 2026")], "topic string, genre string, query_text string")
    comments = spark.createDataFrame([("phones", "tech", None)], "topic string, genre string, query_text string")
    sizes = lambda text, t=None, g=None: {k: v.count() for k, v in filters.apply_filters(
        run, query, filters.Facets(), comments, text, t, g).items()}
    assert sizes(" PHONES ") == {"collection": 1, "queries": 0, "comments": 1}
    assert sizes("cars of") == {"collection": 0, "queries": 1, "comments": 0}
    assert sizes("nothing", "cars") == {"collection": 0, "queries": 1, "comments": 0}
    assert sizes("nothing") == {"collection": 1, "queries": 1, "comments": 1}
    assert sizes("") == {"collection": 1, "queries": 1, "comments": 1}


def test_nothing_selected_keeps_nothing(spark):
    comments = spark.createDataFrame([("a", "g")], "topic string, genre string")
    assert filters.filter_mart(comments, filters.Facets(), comments.limit(0)).count() == 0
    assert filters.filter_mart(comments, filters.Facets(), comments).count() == 1


def test_recommendations(spark, rows):
    df = spark.createDataFrame([("t", "q1", "no_data", 0), ("t", "q2", "success", 5)], "topic string, query_id string, collection_status string, records_written int")
    out = [r["recommendation"] for r in prescriptive.recommendations(df).collect()]
    assert out[0] == "Query 'q1' is underperforming for topic 't'. Rewrite or deprioritize it." and len(out) == 2
    (none,) = prescriptive.recommendations(df.limit(0)).collect()
    assert none["recommendation"].startswith("No query performance data")


def test_budget_of_one_platform_in_two_spellings_and_shared_ids(spark):
    rows = [("youtube", "a", 5, 600), ("YouTube", "b", 4, 600), ("youtube", "c", 3, 300), ("youtube", "c", 3, 300), ("YOUTUBE", "c", 2, 50),
            ("youtube", "d", 9, 0), ("youtube", "e", 9, None), ("youtube", "f", 9, -5), (None, "g", 1, 10)]
    df = spark.createDataFrame(rows, "platform string, query_id string, priority int, expected_units bigint")
    plan = planning.plan_within_budget(df, 1000)
    got = sorted((r["query_id"], r["priority"], r["status"]) for r in plan.collect())
    late, bad = "deferred_budget_limit", "invalid_expected_units"
    assert got == [("a", 5, "selected"), ("b", 4, late), ("c", 2, "selected"), ("c", 3, late), ("c", 3, "selected"),
                   ("d", 9, bad), ("e", 9, bad), ("f", 9, bad), ("g", 1, "selected")]
    summary = {r["platform"]: (r["total_queries_available"], r["total_budget_used"]) for r in planning.plan_summary(plan, 1000).collect()}
    assert summary == {"YOUTUBE": (5, 950), None: (1, 10)}


def test_queries_meet_their_errors_once(spark, rows, tmp_path):
    """Both tables of queries follow from one pass over the summaries."""
    from voxlake.plans import jobs
    from voxlake.sources.tables import read_contract

    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    q = queries(spark, {}, {"query_id": "q2"}, {"query_id": "q3", "comments_count": 0})
    e = failures(spark, ("r", "q2", 2, "late"), ("r", "q2", 1, "early"), ("r", "q3", 1, None))
    jobs.collection_metrics(spark, str(tmp_path), q.withColumn("expected_units", F.udf(count, "bigint")("expected_units")), e)
    assert seen.value == 3
    for key, frame in {"bronze.ingestion_runs": runs.ingestion_runs(q, e), "gold.query_performance_summary": runs.query_performance(q, e)}.items():
        assert rows(read_contract(spark, str(tmp_path), key).select(*frame.columns), "query_id") == rows(frame, "query_id")
