import ast
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from tools.check import TABLES, canonical  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COMPARED = (
    "daily_sentiment_from_texts sentiment_topic_summary sentiment_overview_kpis keyword_frequency_top25 "
    "damped_trend_forecast budget_plan alias_resolution_by_join video_evidence_left_join keyed_upsert "
    "latest_comment_versions query_scope_text like_box_statistics mart_filter_follows_comments registry_upsert"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def test_every_query_has_an_oracle_and_flagship_has_rows(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 120
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", COMPARED)
def test_equal_to_oracle(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = driver.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(driver.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize(
    ("name", "keys", "cap"),
    [
        ("mart_presentation_order", ["collection_date", "topic", "genre", "weekday_name", "comment_hour_24"], 40),
        ("registry_presentation_order", ["query_id"], 30),
    ],
)
def test_whole_orders(spark, name, keys, cap):
    """All rows, in the order of the SQL, past the cap of the short query of that name."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = driver.queries()[f"{name}_all"](spark, FOLDER).toPandas()
    want = con.execute(driver.oracle_sql()[f"{name}_all"]).df()
    assert len(got) > cap and canonical(got) == canonical(want)
    assert [tuple(map(str, r)) for r in got[keys].values] == [tuple(map(str, r)) for r in want[keys].values]


def test_library_never_collects_frames():
    """Driver-side collection is limited to single rows, days, buckets of a store and partitions of a log."""
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "voxlake")
    found = []
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":  # fits models to bounded samples; tested on its own
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as handle:
                    for node in ast.walk(ast.parse(handle.read())):
                        if isinstance(node, ast.Attribute) and node.attr in ("collect", "toPandas", "localCheckpoint"):
                            found.append(name)
    assert sorted(found) == ["buckets.py", "buckets.py", "changes.py", "changes.py", "changes.py", "jobs.py", "offsets.py"]
