"""Query registry: validation, alias resolution, upsert; budget plan; newest-N selections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.columns import col_or_null, safe_text
from voxlake.functions.text import collapse_spaces, custom_query_id, normalized, slug

# Registry defaults and bounds.
DEFAULTS = {"search_results_limit": 5, "comments_per_video_limit": 20, "lookback_days": 7}
BOUNDS = {
    "priority": (1, 10, "priority must be between 1 and 10"),
    "expected_units": (1, None, "expected_units must be greater than 0"),
    "search_results_limit": (1, 50, "search_results_limit must be between 1 and 50"),
    "comments_per_video_limit": (1, 100, "comments_per_video_limit must be between 1 and 100"),
    "lookback_days": (1, 30, "lookback_days must be between 1 and 30"),
}
MIN_QUERY_LENGTH = 3
TOTAL_BUDGET = 10000


def with_defaults(registry: DataFrame) -> DataFrame:
    """Registry rows with limits, activity and cadence filled in."""
    filled = {
        name: F.coalesce(col_or_null(registry, name, "int").cast("int"), F.lit(value))
        for name, value in DEFAULTS.items()
    }
    filled["active"] = F.coalesce(col_or_null(registry, "active", "boolean"), F.lit(True))
    filled["cadence"] = F.coalesce(col_or_null(registry, "cadence"), F.lit("daily"))
    return registry.withColumns(filled)


def violations(registry: DataFrame) -> Column:
    """Array of the messages of all broken constraints."""
    checks = [
        F.when(
            F.length(collapse_spaces(F.coalesce("query_text", F.lit("")))) < MIN_QUERY_LENGTH,
            F.lit(f"query_text must have at least {MIN_QUERY_LENGTH} characters"),
        )
    ]
    for name, (low, high, message) in BOUNDS.items():
        if name not in registry.columns:
            continue
        bad = F.col(name).isNull() | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        checks.append(F.when(bad, F.lit(message)))
    return F.array_compact(F.array(*checks))


def validated(registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with their ``violations``."""
    checked = registry.withColumn("violations", violations(registry))
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def active_queries(registry: DataFrame, platform: str = "youtube") -> DataFrame:
    return registry.filter(F.col("active") & (F.lower("platform") == platform.lower()))


def plan_within_budget(registry: DataFrame, total_budget: int = TOTAL_BUDGET) -> DataFrame:
    """Greedy choice per platform (in any letter case): by priority, then cheaper first, then id; what no longer fits is
    skipped and later cheaper rows may still be taken. Rows whose cost is missing or not positive have no place in a
    plan: they get the status ``invalid_expected_units`` and use no budget.

    The choice itself is sequential, but only few rows can take part in it: rows of equal cost u are taken in
    order until one does not fit and none after it does, so at most budget/u rows of each cost matter. Those are
    at most about budget * ln(budget) rows per platform whatever the registry's size; they are found in two
    ranking steps (the first within input partitions, so one cost with a third of all rows is ranked in as many tasks as
    it is read by) and only they are folded. Rows that agree in platform, cost, priority and id are interchangeable:
    the fold says how many of them are taken, and a rank among them which.
    """
    order = [F.col("priority").desc(), F.col("expected_units"), F.col("query_id")]
    fits = F.col("_n") * F.col("expected_units") <= total_budget
    keyed = registry.withColumn("_platform", F.lower("platform"))
    valid = (F.col("expected_units") > 0) & F.col("expected_units").isNotNull()
    ranked = keyed.select("_platform", "query_id", "priority", "expected_units", F.spark_partition_id().alias("_part")).filter(
        valid & (F.col("expected_units") <= total_budget)
    )
    for groups in (["_platform", "expected_units", "_part"], ["_platform", "expected_units"]):
        window = Window.partitionBy(*groups).orderBy(*order)
        ranked = ranked.withColumn("_n", F.row_number().over(window)).filter(fits)
    candidates = ranked.groupBy("_platform").agg(
        F.array_sort(
            F.collect_list(
                F.struct((-F.col("priority")).alias("p"), F.col("expected_units").alias("u"), F.col("query_id").alias("q"))
            )
        ).alias("c")
    )
    item = candidates.schema["c"].dataType.elementType.simpleString()
    start = F.struct(F.lit(0).cast("bigint").alias("used"), F.array().cast(f"array<{item}>").alias("taken"))

    def step(state: Column, item: Column) -> Column:
        takes = state.used + item.u <= total_budget
        return F.struct(
            F.when(takes, state.used + item.u).otherwise(state.used).alias("used"),
            F.when(takes, F.concat(state.taken, F.array(item))).otherwise(state.taken).alias("taken"),
        )

    taken = candidates.select(F.col("_platform").alias("t_platform"), F.explode(F.aggregate("c", start, step).taken).alias("t"))
    counts = taken.groupBy("t_platform", "t").agg(F.count(F.lit(1)).alias("_taken"))
    same = ["_platform", "query_id", "priority", "expected_units"]
    placed = keyed.withColumn("_place", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64(*registry.columns))))
    found = (
        F.col("_platform").eqNullSafe(F.col("t_platform"))
        & F.col("query_id").eqNullSafe(F.col("t.q"))
        & F.col("priority").eqNullSafe(-F.col("t.p"))
        & (F.col("expected_units") == F.col("t.u"))
    )
    status = (
        F.when(~F.coalesce(F.col("expected_units") > 0, F.lit(False)), "invalid_expected_units")
        .when(F.col("_place") <= F.coalesce("_taken", F.lit(0)), "selected")
        .otherwise("deferred_budget_limit")
    )
    return placed.join(counts, found, "left").select(*registry.columns, status.alias("status"))


def plan_summary(plan: DataFrame, total_budget: int = TOTAL_BUDGET) -> DataFrame:
    """Counts and budget per platform, in any letter case (its least spelling is shown), over rows with a valid cost."""
    chosen = F.col("status") == "selected"
    used = F.coalesce(F.sum(F.when(chosen, F.col("expected_units"))), F.lit(0)).cast("bigint")
    valid = plan.filter(F.col("status") != "invalid_expected_units").groupBy(F.lower("platform").alias("_platform"))
    return valid.agg(
        F.min("platform").alias("platform"),
        F.count(F.lit(1)).alias("total_queries_available"),
        F.count_if(chosen).alias("total_queries_selected"),
        F.count_if(~chosen).alias("total_queries_deferred"),
        used.alias("total_budget_used"),
        F.lit(total_budget).cast("bigint").alias("total_budget_available"),
        (F.lit(total_budget).cast("bigint") - used).alias("leftover_budget"),
    ).drop("_platform")


def first_entries(plan: DataFrame, limit: int | None) -> DataFrame:
    """The first plan rows in plan order."""
    if limit is None:
        return plan
    return plan.orderBy(F.col("priority").desc(), F.col("expected_units"), F.col("query_id")).limit(limit)


def newest_distinct(
    df: DataFrame, group: Sequence[str], item: str, time: str, limit: Column | int
) -> DataFrame:
    """The newest ``limit`` distinct items of each group; blank ids are dropped, repeats keep their newest row."""
    from voxlake.operators.silver import first_per_group, newest_per_key

    filled = df.filter(safe_text(F.col(item).cast("string")) != "")
    distinct = newest_per_key(filled, [*group, item], [F.col(time).desc_nulls_last()])
    return first_per_group(distinct, group, [F.col(time).desc_nulls_last(), F.col(item)], limit)


Aliases = Mapping[str, Mapping[str, Sequence[str]]]
#: Characters of the pieces that texts and aliases meet by: long enough that common short words are no hot keys.
PIECE = 8


def alias_rows(aliases: Aliases) -> list[tuple[int, str, str, str]]:
    """(ordinal, genre, topic, alias) in dictionary order, blank aliases left out."""
    rows = []
    for genre, topics in aliases.items():
        for topic, names in topics.items():
            for name in names:
                cleaned = str(name).strip().lower()
                if cleaned:
                    rows.append((len(rows), genre, topic, cleaned))
    return rows


def _pieces(text: Column) -> Column:
    """Distinct substrings of 1 to ``PIECE`` characters."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    lengths = F.sequence(F.lit(1), F.lit(PIECE))
    of_length = lambda n: F.transform(places, lambda start: F.substring(text, start, n))
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def match_aliases(queries: DataFrame, aliases: DataFrame, text: str = "_text") -> DataFrame:
    """First alias per distinct non-blank query text, by equi joins, for dictionaries of any size.

    If one text contains the other, the first (up to) ``PIECE`` characters of the shorter one occur in the longer
    one, so both directions become joins on substrings, each verified afterwards. ``aliases`` has the
    columns ordinal, genre, topic, alias.
    """
    texts = queries.select(text).distinct().filter(F.col(text) != "")
    head = lambda name: F.substring(name, 1, PIECE)
    inside = texts.withColumn("_g", F.explode(_pieces(F.col(text)))).join(
        aliases.withColumn("_g", head("alias")), "_g"
    )
    around = texts.withColumn("_g", head(text)).join(
        aliases.withColumn("_g", F.explode(_pieces(F.col("alias")))), "_g"
    )
    hits = inside.filter(F.contains(F.col(text), F.col("alias"))).unionByName(
        around.filter(F.contains(F.col("alias"), F.col(text)))
    )
    return hits.groupBy(text).agg(
        F.min_by(F.struct("topic", "genre", "alias"), F.col("ordinal")).alias("_match")
    )


_MATCH = "struct<topic: string, genre: string, alias: string>"


def _matched(queries: DataFrame, aliases: Aliases, text: str, blank: bool) -> DataFrame:
    """``_match``: the first alias that equals, contains or is contained in the text.

    Every text contains the blank one, so a blank text matches the first entry if ``blank``, else nothing.
    """
    rows = alias_rows(aliases)
    if not rows:
        return queries.withColumn("_match", F.lit(None).cast(_MATCH))
    table = queries.sparkSession.createDataFrame(rows, "ordinal int, genre string, topic string, alias string")
    found = queries.join(match_aliases(queries, table, text), text, "left")
    if not blank:
        return found
    _, genre, topic, alias = rows[0]
    first = F.struct(F.lit(topic).alias("topic"), F.lit(genre).alias("genre"), F.lit(alias).alias("alias"))
    return found.withColumn("_match", F.when(F.col(text) == "", first).otherwise(F.col("_match")))


def resolve_aliases(queries: DataFrame, aliases: Aliases) -> DataFrame:
    """Queries with ``resolved_topic`` and ``resolved_genre``.

    An explicit topic or genre wins; else the first dictionary entry whose alias matches the query text; else
    the slug of the text and ``custom``.
    """
    df = queries.withColumn("_text", F.lower(collapse_spaces(F.coalesce("query_text", F.lit("")))))
    matched = _matched(df, aliases, "_text", blank=True)
    given = lambda name: F.when(
        safe_text(col_or_null(queries, name)) != "", slug(col_or_null(queries, name))
    )
    found = lambda name: F.when(F.col("_match").isNotNull(), slug(F.col(f"_match.{name}")))
    return matched.withColumns(
        {
            "resolved_topic": F.coalesce(given("topic"), found("topic"), slug(F.col("_text"))),
            "resolved_genre": F.coalesce(given("genre"), found("genre"), F.lit("custom")),
        }
    ).drop("_text", "_match")


def resolve_analysis(queries: DataFrame, aliases: Aliases, registry: DataFrame) -> DataFrame:
    """For typed queries: the first matching alias, its topic, and that topic's genre in the registry.

    Columns: raw_query, matched_topic, matched_genre, matched_alias; blank queries match nothing.
    """
    cleaned = queries.select(normalized(F.col("query_text")).alias("raw_query"))
    matched = _matched(cleaned, aliases, "raw_query", blank=False).select(
        "raw_query",
        F.lower(F.trim("_match.topic")).alias("matched_topic"),
        F.col("_match.alias").alias("matched_alias"),
    )
    genres = (
        registry.select(normalized(F.col("topic")).alias("matched_topic"), normalized(F.col("genre")).alias("_g"), "query_id")
        .groupBy("matched_topic")
        .agg(F.nullif(F.min_by("_g", "query_id"), F.lit("")).alias("matched_genre"))
    )
    return matched.join(genres, "matched_topic", "left").select(
        "raw_query", "matched_topic", "matched_genre", "matched_alias"
    )


_REGISTRY = (
    "query_id platform topic genre query_text priority active cadence expected_units search_results_limit "
    "comments_per_video_limit lookback_days"
).split()


def upsert_queries(registry: DataFrame, incoming: DataFrame, aliases: Aliases) -> DataFrame:
    """Registry after adding custom queries, with ``action`` created, updated or null for untouched rows.

    A query is the same when platform and normalised text match; it then keeps its id and gets the new settings.
    """
    from voxlake.operators.silver import newest_per_key

    resolved = resolve_aliases(with_defaults(incoming), aliases)
    fresh = resolved.select(
        F.lower("platform").alias("_p"),
        F.lower(collapse_spaces(F.col("query_text"))).alias("_t"),
        F.struct(
            F.lit(None).cast("string").alias("query_id"),
            "platform",
            F.col("resolved_topic").alias("topic"),
            F.col("resolved_genre").alias("genre"),
            collapse_spaces(F.col("query_text")).alias("query_text"),
            *[F.col(name) for name in _REGISTRY[5:]],
        ).alias("new"),
    )
    fresh = newest_per_key(fresh, ["_p", "_t"], [F.col("new.priority").desc()])
    known = with_defaults(registry).select(
        F.lower("platform").alias("_p"),
        F.lower(F.trim("query_text")).alias("_t"),
        F.struct(*_REGISTRY).alias("old"),
    )
    numbered = known.withColumn(
        "_n", F.row_number().over(Window.partitionBy("_p", "_t").orderBy("old.query_id"))
    )
    first, rest = numbered.filter("_n = 1").drop("_n"), numbered.filter("_n > 1")
    joined = first.join(fresh, ["_p", "_t"], "full")
    new_id = custom_query_id(F.col("new.platform"), F.col("new.topic"), F.col("new.query_text"))
    columns = [F.coalesce("old.query_id", new_id).alias("query_id")] + [
        F.when(F.col("new").isNotNull(), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
        for name in _REGISTRY[1:]
    ]
    action = F.when(F.col("new").isNotNull(), F.when(F.col("old").isNull(), "created").otherwise("updated"))
    untouched = rest.select("old.*", F.lit(None).cast("string").alias("action"))
    return joined.select(*columns, action.alias("action")).unionByName(untouched)


def registry_order(registry: DataFrame) -> DataFrame:
    return registry.orderBy(F.col("priority").desc(), "genre", "topic", "query_id")
