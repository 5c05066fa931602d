"""JSON run folders and nested comment dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Every field name a raw comment record may carry.
RECORD_FIELDS = (
    "run_id collected_at platform query_id query_text topic genre plan_date cadence priority expected_units "
    "video_id video_title title video_description channel_id channel_title video_channel_title "
    "video_published_at video_url thread_id comment_thread_id comment_id comment_text text like_count "
    "comment_like_count comment_published_at published_at comment_updated_at updated_at reply_count "
    "total_reply_count author_display_name author_name author_channel_id language_target"
).split()

# Schema of a nested thread in a historical dump.
_COMMENT = (
    "struct<comment_id string, author_channel_id string, author_name string, author_display_name string, "
    "text string, comment_text string, textOriginal string, textDisplay string, detected_language string, "
    "like_count string, published_at string, comment_published_at string, updated_at string, "
    "comment_updated_at string>"
)
THREAD_SCHEMA = (
    "source string, video_id string, thread_id string, language_target string, fetched_at string, "
    f"total_reply_count string, top_level_comment {_COMMENT}, replies array<{_COMMENT}>, "
    "raw_snippet struct<snippet: struct<channelId: string, "
    "topLevelComment: struct<snippet: struct<authorDisplayName: string>>>>"
)


_SHAPES = "unsupported comment document: expected a list, comments or records"


def _element(document: str) -> Column:
    """The record list of a document of any accepted shape."""
    whole = f"try_variant_get({document}, '$', 'array<variant>')"
    comments = f"try_variant_get({document}, '$.comments', 'array<variant>')"
    records = f"try_variant_get({document}, '$.records', 'array<variant>')"
    return F.expr(f"coalesce({whole}, {comments}, {records})")


def _field(record: str, name: str) -> Column:
    """A record field as text; objects and arrays become JSON."""
    path = f"'$.{name}'"
    return F.expr(
        f"coalesce(try_variant_get({record}, {path}, 'string'), "
        f"to_json(try_variant_get({record}, {path}, 'variant')))"
    ).alias(name)


def records_from_documents(documents: DataFrame, document: str = "document") -> DataFrame:
    """One row per JSON object of each document, with its position in the list.

    A document is a list, ``{"comments": [...]}`` or ``{"records": [...]}``; elements that are not objects are
    dropped, any other shape raises an error. ``raw_record_json`` is the whole record with sorted keys.
    """
    keep = [name for name in documents.columns if name != document]
    checked = documents.withColumn(
        "_elements",
        F.coalesce(
            _element(document),
            F.raise_error(F.lit(_SHAPES)).cast(
                "array<variant>"
            ),
        ),
    )
    exploded = checked.select(*keep, F.posexplode("_elements").alias("position", "record"))
    objects = exploded.filter(F.expr("schema_of_variant(record) LIKE 'OBJECT%'"))
    return objects.select(
        *keep,
        (F.col("position") + 1).cast("bigint").alias("position"),
        *[_field("record", name) for name in RECORD_FIELDS if name not in keep],
        F.to_json("record").alias("raw_record_json"),
    )


def _whole_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``source_path, run_folder, text, opens``: one row a file, and the first sign of its text that is no white space."""
    paths = [path] if isinstance(path, str) else list(path)
    mark = "\ufeff"
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), "value")
    text = F.when(F.startswith("value", F.lit(mark)), F.substring("value", 2, (1 << 31) - 1)).otherwise(F.col("value"))
    # A file without a byte gives a row or none, as the file system has it; it is no document.
    filled = files.select("source_path", text.alias("text")).filter(F.length("text") > 0)
    return filled.select(
        "source_path",
        F.regexp_extract("source_path", r"([^/]+)/[^/]+$", 1).alias("run_folder"),
        "text",
        F.regexp_extract("text", r"^\s*(\S)", 1).alias("opens"),
    )


def _refused(why: Column | str, kind: str) -> Column:
    reason = F.lit(why) if isinstance(why, str) else why
    return F.raise_error(F.concat(reason, F.lit(" ("), "source_path", F.lit(")"))).cast(kind)


def read_records(spark: SparkSession, path: str | Sequence[str], lists: tuple[str, ...], shape_error: str) -> DataFrame:
    """``source_path, run_folder, position, record`` (a variant) of all JSON objects in the lists of JSON files.

    A document is a list, or an object with one of ``lists``; of several the first named that is a list counts. Spark's
    JSON parser reads the document and makes each element a variant of its own, so the limit of a variant holds for a
    record, not for a file; a file is read by one task.
    """
    kind = "array<variant>"
    files = _whole_files(spark, path)
    listed = F.from_json("text", kind, {"mode": "PERMISSIVE"})
    named = F.from_json("text", "struct<" + ", ".join(f"`{name}`: {kind}" for name in lists) + ">", {"mode": "PERMISSIVE"})
    # Within a lambda the parsed object is one value, however many of its lists are asked for.
    chosen = F.transform(F.array(named), lambda d: F.coalesce(*[d.getField(name) for name in lists])).getItem(0)
    held = F.when(F.col("opens") == "[", listed).when(F.col("opens") == "{", chosen)
    rows = files.select("source_path", "run_folder", F.coalesce(held, _refused(shape_error, kind)).alias("elements"))
    exploded = rows.select("source_path", "run_folder", F.posexplode("elements").alias("position", "record"))
    objects = exploded.filter(F.expr("schema_of_variant(record) LIKE 'OBJECT%'"))
    return objects.select("source_path", "run_folder", (F.col("position") + 1).cast("bigint").alias("position"), "record")


def read_objects(spark: SparkSession, path: str | Sequence[str], fields: Sequence[str], shape_error: str) -> DataFrame:
    """``source_path, run_folder`` and the given fields, as text, of JSON files that are an object each.

    Only these fields are kept of a document, whatever else it holds; a field that is a list or an object is null.
    """
    kind = "struct<" + ", ".join(f"`{name}`: variant" for name in fields) + ">"
    parsed = F.from_json("text", kind, {"mode": "FAILFAST"})
    document = F.when(F.col("opens") == "{", parsed).otherwise(_refused(shape_error, kind))
    rows = _whole_files(spark, path).select("source_path", "run_folder", document.alias("d"))
    plain = lambda name: F.expr(f"CASE WHEN schema_of_variant(d.`{name}`) RLIKE '^(ARRAY|OBJECT)' THEN NULL ELSE try_variant_get(d.`{name}`, '$', 'string') END")
    return rows.select("source_path", "run_folder", *[plain(name).alias(name) for name in fields])


def read_run_records(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """Raw comment records of all run folders that match the file pattern, in documents of any accepted shape and size."""
    rows = read_records(spark, pattern, ("comments", "records"), _SHAPES)
    return rows.select(
        "source_path",
        "run_folder",
        "position",
        *[_field("record", name) for name in RECORD_FIELDS],
        F.to_json("record").alias("raw_record_json"),
    )


# Manifest and plan fields.
_MANIFEST_FIELDS = "run_id generated_at plan_path normalized_comments_path".split()
_MANIFEST_COUNTS = "queries_executed total_comments_collected error_count".split()
_PLAN_FIELDS = "query_id query_text topic genre cadence priority expected_units language_target plan_date".split()


def read_manifests(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per run folder with the manifest's fields."""
    fields = (*_MANIFEST_FIELDS, *_MANIFEST_COUNTS)
    documents = read_objects(spark, pattern, fields, "unsupported manifest: expected an object")
    return documents.select(F.col("source_path").alias("manifest_path"), "run_folder", *fields)


def latest_run(manifests: DataFrame, order: str = "manifest_path") -> DataFrame:
    """Only the run whose manifest path sorts last; reading it where there is no run is an error."""
    newest = manifests.agg(F.max_by(F.struct(*manifests.columns), F.col(order)).alias("m"))
    none = F.raise_error(F.lit("no run found")).cast(newest.schema["m"].dataType)
    return newest.select(F.coalesce("m", none).alias("m")).select("m.*")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Plan rows from a list or from an object with ``selected_queries``; the last row of a query id wins."""
    rows = read_records(spark, path, ("selected_queries",), "unsupported plan: expected a list or selected_queries")
    return plan_lookup(rows.select("position", *[_field("record", name) for name in _PLAN_FIELDS]), order="position")


def plan_lookup(plan: DataFrame, order: str | None = None) -> DataFrame:
    """One row per non-blank query id."""
    from voxlake.functions.columns import safe_text

    keyed = plan.withColumn("query_id", safe_text(F.col("query_id"))).filter(F.col("query_id") != "")
    sort = [F.col(order).desc()] if order else [F.xxhash64(*plan.columns)]
    ranked = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*sort)))
    return ranked.filter("_rank = 1").drop("_rank", *([order] if order else []))


# Fixed value: bytes of the longest line that is looked at; a list with a longer one is streamed.
_LONGEST_LINE = 1 << 28


def _list_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``source_path, file_size, opens, body, comma, closes, bytes``: the parts of each line of a JSON list.

    A line break is never within a JSON string, so a line's signs tell whether it holds one whole element.
    """
    lines = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", str(_LONGEST_LINE)).text(path)
    blank = " \t\r"
    cut = lambda column, at: F.btrim(F.expr(f"substring({column}, {at})"), F.lit(blank))
    df = lines.select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.octet_length("value").cast("bigint").alias("bytes"),
        F.btrim("value", F.lit(blank)).alias("body"),
    )
    df = df.withColumn("opens", F.startswith("body", F.lit("["))).withColumn("body", F.when(F.col("opens"), cut("body", 2)).otherwise(F.col("body")))
    df = df.withColumn("first", F.startswith("body", F.lit(","))).withColumn("body", F.when(F.col("first"), cut("body", 2)).otherwise(F.col("body")))
    df = df.withColumn("closes", F.endswith("body", F.lit("]")))
    df = df.withColumn("body", F.when(F.col("closes"), cut("body", "1, length(body) - 1")).otherwise(F.col("body")))
    df = df.withColumn("last", F.endswith("body", F.lit(",")))
    df = df.withColumn("body", F.when(F.col("last"), cut("body", "1, length(body) - 1")).otherwise(F.col("body")))
    commas = F.col("first").cast("bigint") + F.col("last").cast("bigint")
    return df.select("source_path", "file_size", "bytes", "opens", "body", commas.alias("commas"), "closes")


def _split_by_lines(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Files that are a JSON list of objects, each of them whole on a line of its own; all lines are looked at."""
    body = F.col("body")
    element = F.startswith(body, F.lit("{")) & F.endswith(body, F.lit("}"))
    one = F.coalesce(F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1, F.lit(False))
    found = _list_lines(spark, path).groupBy("source_path", "file_size").agg(
        F.bool_and((body == "") | (element & one)).alias("plain"),
        F.count_if(body != "").alias("elements"),
        F.sum("commas").alias("commas"),
        F.count_if("opens").alias("opening"),
        F.count_if("closes").alias("closing"),
        F.sum(F.col("bytes") + 1).alias("bytes"),
    )
    whole = (F.col("bytes") - F.col("file_size")).between(0, 1)  # no line was too long; breaks are of one byte
    listed = (F.col("opening") == 1) & (F.col("closing") == 1) & (F.col("commas") == F.col("elements") - 1)
    # One row: names of files.
    return found.filter(F.col("plain") & whole & listed).agg(F.sort_array(F.collect_list("source_path"))).first()[0]


def read_threads(spark: SparkSession, path: str | Sequence[str], lines: bool = False) -> DataFrame:
    """Nested threads of historical dumps, one row per thread with its file name.

    Files with a thread a ``line``, and JSON lists with an element a line, are split over tasks; any other JSON list is
    streamed element by element by one task.
    """
    raw = spark.read.schema(THREAD_SCHEMA).option("multiLine", not lines).json(path)
    file_path = F.col("_metadata.file_path")
    split = [] if lines else _split_by_lines(spark, path)
    if not split:
        return raw.select("*", file_path.alias("source_path"))
    elements = _list_lines(spark, path).filter(F.col("source_path").isin(split) & (F.col("body") != ""))
    parsed = elements.select(F.from_json("body", THREAD_SCHEMA).alias("t"), "source_path").select("t.*", "source_path")
    streamed = raw.select("*", file_path.alias("source_path")).filter(~F.col("source_path").isin(split))
    return parsed.unionByName(streamed)


def parse_threads(documents: DataFrame, column: str = "document") -> DataFrame:
    """Nested threads from a column of JSON text."""
    return documents.select(F.from_json(F.col(column), THREAD_SCHEMA).alias("t")).select("t.*")


def limit_per_source(records: DataFrame, limit: int | None, source: str = "source_path") -> DataFrame:
    """The first ``limit`` records of each source, in record order."""
    from voxlake.operators.silver import first_per_group

    return records if limit is None else first_per_group(records, [source], [F.col("position")], limit)


def first_runs(manifests: DataFrame, limit_runs: int | None) -> DataFrame:
    """The first runs in manifest path order."""
    if limit_runs is None:
        return manifests
    return manifests.orderBy("manifest_path").limit(limit_runs)


def source_summary(documents: DataFrame) -> DataFrame:
    """Documents per source, which is all a dry run reports."""
    return documents.groupBy("source_type", "source_path").agg(F.count(F.lit(1)).alias("documents_prepared"))
