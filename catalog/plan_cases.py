"""Registry, aliases, budget, newest-N selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import case, comments, engagement, registry, slug_sql, sql, view
from voxlake.operators import planning

BUDGET = 3000
ALIASES = {
    "hardware": {"fasteners": ["bolt", "nut"], "machines": ["gear", "widget", " Gizmo "]},
    "jewelry": {"rings": ["ring", "small ring set", ""]},
    "style": {"colors": ["red", "blue", "hot"]},
}
_ALIAS_ROWS = ", ".join(
    f"({n}, '{genre}', '{topic}', '{alias}')" for n, genre, topic, alias in planning.alias_rows(ALIASES)
)
view("aliases", f"SELECT * FROM (VALUES {_ALIAS_ROWS}) AS t(ordinal, a_genre, a_topic, alias)")
view(
    "matched",
    """SELECT query_id, a_genre, a_topic, alias FROM reg JOIN aliases
    ON contains(lower(query_text), alias) OR contains(alias, lower(query_text))
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY ordinal) = 1""",
    "reg",
    "aliases",
)


@case(
    "active_registry_rows",
    sql("SELECT query_id, platform, topic, priority FROM reg WHERE active AND lower(platform) = 'brand#4'", "reg"),
)
def _active(spark, d):
    rows = planning.active_queries(registry(spark, d), "BRAND#4")
    return rows.select("query_id", "platform", "topic", "priority")


@case(
    "registry_violations",
    sql(
        """SELECT query_id, array_to_string(list_filter([
    CASE WHEN length(query_text) < 3 THEN 'query_text must have at least 3 characters' END,
    CASE WHEN priority NOT BETWEEN 1 AND 10 THEN 'priority must be between 1 and 10' END,
    CASE WHEN expected_units < 1 THEN 'expected_units must be greater than 0' END,
    CASE WHEN search_results_limit NOT BETWEEN 1 AND 50 THEN 'search_results_limit must be between 1 and 50' END,
    CASE WHEN comments_per_video_limit NOT BETWEEN 1 AND 100
      THEN 'comments_per_video_limit must be between 1 and 100' END,
    CASE WHEN lookback_days NOT BETWEEN 1 AND 30 THEN 'lookback_days must be between 1 and 30' END],
    lambda m: m IS NOT NULL), '|') AS violations FROM reg""",
        "reg",
    ),
)
def _violations(spark, d):
    rows = planning.with_defaults(registry(spark, d))
    return rows.select("query_id", F.array_join(planning.violations(rows), "|").alias("violations"))


_RESOLVED = f"""SELECT r.query_id, coalesce(CASE WHEN r.n % 5 = 0 THEN {slug_sql('topic')} END,
      CASE WHEN a_topic IS NOT NULL THEN {slug_sql('a_topic')} END,
      {slug_sql('lower(query_text)')}) AS resolved_topic,
    coalesce(CASE WHEN r.n % 7 = 0 THEN {slug_sql('genre')} END,
      CASE WHEN a_genre IS NOT NULL THEN {slug_sql('a_genre')} END, 'custom') AS resolved_genre
  FROM (SELECT *, CAST(substr(query_id, 2) AS BIGINT) AS n FROM reg) r LEFT JOIN matched m USING (query_id)"""


def _partly_tagged(spark, d):
    r = registry(spark, d).withColumn("n", F.substring("query_id", 2, 20).cast("bigint"))
    return r.withColumns(
        {
            "topic": F.when(F.col("n") % 5 == 0, F.col("topic")),
            "genre": F.when(F.col("n") % 7 == 0, F.col("genre")).otherwise(" "),
        }
    )


@case("alias_resolution", sql(_RESOLVED, "matched"))
def _resolved(spark, d):
    out = planning.resolve_aliases(_partly_tagged(spark, d), ALIASES)
    return out.select("query_id", "resolved_topic", "resolved_genre")


@case("alias_resolution_by_join", sql(_RESOLVED, "matched"))
def _resolved_join(spark, d):
    out = planning.resolve_aliases(_partly_tagged(spark, d), ALIASES)
    return out.select("query_id", "resolved_topic", "resolved_genre")


@case(
    "typed_query_resolution",
    sql(
        """SELECT lower(query_text) AS raw_query, lower(a_topic) AS matched_topic, alias AS matched_alias,
    CASE WHEN a_topic IS NOT NULL THEN (SELECT min_by(genre, query_id) FROM typed_reg WHERE topic = lower(a_topic)) END
      AS matched_genre, count(*) AS queries
  FROM reg LEFT JOIN matched USING (query_id) GROUP BY ALL""",
        "matched",
        view("typed_reg", f"SELECT query_id, {slug_sql('split_part(query_text, chr(32), 1)')} AS topic, genre FROM reg"
             " WHERE false UNION ALL SELECT query_id, a_topic AS topic, genre FROM reg JOIN matched USING (query_id)"
             " WHERE a_topic <> 'rings'", "reg", "matched"),
    ),
)
def _typed(spark, d):
    r = registry(spark, d)
    known = planning.resolve_aliases(r.drop("topic"), ALIASES).join(
        planning.resolve_analysis(r.select("query_text").distinct(), ALIASES, r).select(
            F.col("raw_query").alias("query_text"), F.col("matched_topic").alias("topic")
        ),
        "query_text",
    )
    known = known.filter(F.col("topic").isNotNull() & (F.col("topic") != "rings")).select("query_id", "topic", "genre")
    out = planning.resolve_analysis(r, ALIASES, known)
    return out.groupBy("raw_query", "matched_topic", "matched_alias", "matched_genre").agg(
        F.count(F.lit(1)).alias("queries")
    )


view(
    "plan_walk",
    f"""SELECT platform, spelled, query_id, rn, expected_units, expected_units <= {BUDGET} AS taken,
    CASE WHEN expected_units <= {BUDGET} THEN expected_units ELSE 0 END AS used FROM plan_rows WHERE rn = 1
  UNION ALL
  SELECT o.platform, o.spelled, o.query_id, o.rn, o.expected_units, w.used + o.expected_units <= {BUDGET},
    CASE WHEN w.used + o.expected_units <= {BUDGET} THEN w.used + o.expected_units ELSE w.used END
  FROM plan_walk w JOIN plan_rows o ON o.platform = w.platform AND o.rn = w.rn + 1""",
    view(
        "plan_rows",
        """SELECT *, lower(spelled) AS platform,
    row_number() OVER (PARTITION BY lower(spelled) ORDER BY priority DESC, expected_units, query_id) AS rn FROM (
    SELECT priority, expected_units, CASE n % 3 WHEN 0 THEN upper(platform) ELSE platform END AS spelled,
      'q' || (n // 2) AS query_id FROM (SELECT *, CAST(substr(query_id, 2) AS BIGINT) AS n FROM reg))""",
        "reg",
    ),
)
_STATUS = "CASE WHEN taken THEN 'selected' ELSE 'deferred_budget_limit' END"


def _spelled_registry(spark, d):
    """Platforms in several spellings, and ids that two rows share."""
    n = F.substring("query_id", 2, 20).cast("bigint")
    return registry(spark, d).withColumns(
        {
            "platform": F.when(n % 3 == 0, F.upper("platform")).otherwise(F.col("platform")),
            "query_id": F.concat(F.lit("q"), F.floor(n / 2).cast("string")),
        }
    )


@case(
    "budget_plan",
    sql(
        f"SELECT spelled AS platform, query_id, expected_units, {_STATUS} AS status FROM plan_walk",
        "plan_walk",
        recursive=True,
    ),
)
def _plan(spark, d):
    plan = planning.plan_within_budget(_spelled_registry(spark, d), BUDGET)
    return plan.select("platform", "query_id", "expected_units", "status")


@case(
    "budget_summary",
    sql(
        f"""SELECT min(spelled) AS platform, count(*) AS total_queries_available, count(*) FILTER (taken) AS total_queries_selected,
    count(*) FILTER (NOT taken) AS total_queries_deferred,
    CAST(sum(expected_units) FILTER (taken) AS BIGINT) AS total_budget_used,
    CAST({BUDGET} AS BIGINT) AS total_budget_available,
    CAST({BUDGET} - sum(expected_units) FILTER (taken) AS BIGINT) AS leftover_budget
  FROM plan_walk GROUP BY platform""",
        "plan_walk",
        recursive=True,
    ),
)
def _budget(spark, d):
    return planning.plan_summary(planning.plan_within_budget(_spelled_registry(spark, d), BUDGET), BUDGET)


@case(
    "first_plan_entries",
    sql(
        "SELECT query_id, priority, expected_units FROM reg ORDER BY priority DESC, expected_units, query_id LIMIT 12",
        "reg",
    ),
)
def _first(spark, d):
    return planning.first_entries(registry(spark, d), 12).select("query_id", "priority", "expected_units")


@case(
    "registry_presentation_order",
    sql("SELECT query_id, priority, genre, topic FROM reg ORDER BY priority DESC, genre, topic, query_id", "reg"),
)
def _registry_order(spark, d):
    return planning.registry_order(registry(spark, d)).select("query_id", "priority", "genre", "topic")


@case(
    "registry_presentation_order_all",
    sql("SELECT query_id, priority, genre, topic FROM reg ORDER BY priority DESC, genre, topic, query_id", "reg"),
)
def _registry_order_all(spark, d):
    return planning.registry_order(registry(spark, d)).select("query_id", "priority", "genre", "topic")


@case(
    "newest_videos_per_query",
    sql(
        """SELECT topic, video_id, comment_published_at FROM (
    SELECT topic, video_id, comment_published_at FROM eng
    QUALIFY row_number() OVER (PARTITION BY topic, video_id ORDER BY comment_published_at DESC) = 1)
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY comment_published_at DESC, video_id) <= 25""",
        "eng",
    ),
)
def _newest_videos(spark, d):
    out = planning.newest_distinct(engagement(spark, d), ["topic"], "video_id", "comment_published_at", 25)
    return out.select("topic", "video_id", "comment_published_at")


@case(
    "newest_comments_per_video",
    sql(
        """SELECT video_id, comment_id FROM com WHERE comment_id <> ''
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY comment_published_at DESC, comment_id)
    <= CASE WHEN CAST(video_id AS BIGINT) % 2 = 0 THEN 3 ELSE 1 END""",
        "com",
    ),
)
def _newest_comments(spark, d):
    limit = F.when(F.col("video_id").cast("bigint") % 2 == 0, 3).otherwise(1)
    out = planning.newest_distinct(comments(spark, d), ["video_id"], "comment_id", "comment_published_at", limit)
    return out.select("video_id", "comment_id")


@case(
    "registry_upsert",
    sql(
        f"""SELECT * FROM (WITH fresh AS (
    SELECT lower(platform) AS p, lower(query_text) AS t, min(platform) AS platform, max(priority) AS priority,
      min(query_text) AS query_text FROM incoming GROUP BY 1, 2),
  first_old AS (SELECT * FROM reg QUALIFY
      row_number() OVER (PARTITION BY lower(platform), lower(query_text) ORDER BY query_id) = 1)
  SELECT coalesce(o.query_id, {slug_sql('f.platform', 8)} || '-custom-' ||
      CASE WHEN a_topic IS NULL THEN {slug_sql(slug_sql('f.query_text'), 20)} ELSE {slug_sql('a_topic', 20)} END || '-' || {slug_sql('f.query_text', 24)}) AS query_id,
    coalesce(f.platform, o.platform) AS platform, coalesce(f.priority, o.priority) AS priority,
    CASE WHEN f.p IS NULL THEN NULL WHEN o.query_id IS NULL THEN 'created' ELSE 'updated' END AS action
  FROM first_old o FULL JOIN fresh f ON lower(o.platform) = f.p AND lower(o.query_text) = f.t
  LEFT JOIN (SELECT min(query_id) AS q, query_text AS mt, any_value(a_topic) AS a_topic FROM reg
     JOIN matched USING (query_id) GROUP BY query_text) m
    ON lower(mt) = f.t
  UNION ALL
  SELECT query_id, platform, priority, NULL FROM reg QUALIFY
      row_number() OVER (PARTITION BY lower(platform), lower(query_text) ORDER BY query_id) > 1)""",
        "matched",
        view("incoming", "SELECT 'Youtube' || (p_partkey % 3) AS platform, p_name AS query_text,"
             " p_size % 10 + 1 AS priority FROM part UNION ALL SELECT p_brand, upper(p_name), p_size % 10 + 1 FROM part"
             " WHERE p_size > 25"),
    ),
)
def _upsert(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    priority = F.col("p_size") % 10 + 1
    base = part.select(
        F.concat(F.lit("Youtube"), (F.col("p_partkey") % 3).cast("string")).alias("platform"),
        F.col("p_name").alias("query_text"),
        priority.alias("priority"),
        F.lit(100).cast("bigint").alias("expected_units"),
    )
    loud = part.filter("p_size > 25").select(
        F.col("p_brand").alias("platform"),
        F.upper("p_name").alias("query_text"),
        priority.alias("priority"),
        F.lit(100).cast("bigint").alias("expected_units"),
    )
    out = planning.upsert_queries(registry(spark, d), base.union(loud), ALIASES)
    return out.select("query_id", "platform", "priority", "action")
