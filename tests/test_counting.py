"""Sums with several distinct counts: brute force, and what the plan reads."""

import random

import pytest
from pyspark.sql import functions as F

from voxlake.operators import descriptive, diagnostic, marts
from voxlake.operators.counting import counted, row_counts


@pytest.mark.parametrize("keys", [["g"], ["g", "h"], []])
def test_counts_by_brute_force(spark, keys):
    draw = random.Random(len(keys))
    some = lambda *values: draw.choice([None, *values])
    rows = [(some("x", "y"), some(1, 2), some(*"abcdef"), some(*"pqr"), some(*range(4)), draw.choice([None, 1.0, 2.5])) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, h int, id string, v string, w int, n double")
    sums = {"total": F.col("n"), **row_counts(rows=F.lit(True), filled=F.col("n").isNotNull())}
    found = counted(df, keys, {"ids": "id", "vs": "v", "ws": "w", "gs": "g"}, sums).collect()
    groups = {}
    for g, h, i, v, w, n in rows:
        groups.setdefault(tuple({"g": g, "h": h}[k] for k in keys), []).append((g, i, v, w, n))
    assert len(found) == len(groups)
    for r in found:
        mine = groups[tuple(r[k] for k in keys)]
        seen = [len({m[at] for m in mine} - {None}) for at in (1, 2, 3, 0)]
        assert [r["ids"], r["vs"], r["ws"], r["gs"]] == seen and r["rows"] == len(mine)
        assert r["total"] == (sum(m[4] for m in mine if m[4] is not None) if r["filled"] else None)


def test_no_rows(spark):
    none = spark.createDataFrame([], "g string, id string, v string, n double")
    assert counted(none, ["g"], {"ids": "id", "vs": "v"}, {"n": F.col("n")}).count() == 0
    (one,) = counted(none, [], {"ids": "id", "vs": "v"}, {"n": F.col("n")}).collect()
    assert (one["ids"], one["vs"], one["n"]) == (0, 0, None)


def test_marts_read_their_input_once_and_copy_no_row(spark, tmp_path):
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("comment_id"), (F.col("id") % 9).cast("string").alias("video_id"), F.lit("V").alias("video_title"),
        F.lit("C").alias("channel_title"), F.lit("2026-04-01").alias("collection_date"), F.lit("p").alias("platform"), F.lit("t").alias("topic"), F.lit("g").alias("genre"),
        F.lit("positive").alias("sentiment_label"), (F.col("id") / 100).alias("sentiment_score"), F.lit("2026-04-01T05:00:00").alias("comment_published_at"),
        F.col("id").alias("comment_like_count"), F.col("id").alias("reply_count"), F.lit(None).cast("string").alias("processed_at"))
    rows.write.parquet(str(tmp_path / "rows"))
    scored = spark.read.parquet(str(tmp_path / "rows"))
    builders = [marts.daily_summary, marts.topic_summary, marts.daily_trend, marts.weekday_hour, marts.overview_kpis, marts.daily_topic_metrics,
                diagnostic.topic_risk, descriptive.header_kpis]
    for build in builders:
        plan = build(scored)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and plan.count("Relation [") == 1, build.__name__
