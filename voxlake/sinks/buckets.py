"""A keyed store dealt into hash buckets: an upsert rewrites the buckets that change and no other file.

A row lies in the bucket of its key's hash, the bucket being a partition of the table. The partition column's name says
how many buckets there are (``bucket_of_64``), so a store describes itself. Incoming keys name their buckets; these alone
are read and joined, and of these only the ones with a changed row are written again, by a dynamic partition overwrite.
Reads by key prune to the buckets of the keys.

What is to be written is a table of its own first: a lost executor costs a retried task, and an upsert that died while
its files were being put in place is repeated with the same result. Buckets hold equal shares of the keys; a store that
has outgrown them is dealt anew (:func:`redeal`).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.session import discard, staged
from voxlake.sinks.tables import overwrite
from voxlake.sinks.upsert import DOCUMENT_KEY, key_columns, merge_rows, with_text_keys
from voxlake.sources.tables import read_if_exists

BUCKETS = 64
_NAME = re.compile(r"bucket_of_(\d+)")


def bucket_name(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key; key parts are compared as text, null as blank."""
    return F.pmod(F.xxhash64(*[c.cast("string") for c in key_columns(df, keys)]), F.lit(buckets)).cast("int")


def _scan(spark: SparkSession, path: str) -> tuple[DataFrame, int] | None:
    """All rows with their bucket column, and the number of buckets; files of different fields are read together."""
    found = read_if_exists(spark, path)
    if found is None:
        return None
    counts = [int(m.group(1)) for m in map(_NAME.fullmatch, found.columns) if m]
    if len(counts) != 1:
        raise ValueError(f"{path} is not dealt into buckets")
    return spark.read.option("mergeSchema", "true").parquet(path), counts[0]


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The store's rows, or ``None`` where nothing has been written yet."""
    found = _scan(spark, path)
    return found and found[0].drop(bucket_name(found[1]))


def matching(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str] = DOCUMENT_KEY) -> DataFrame | None:
    """The stored rows whose keys ``wanted`` has, read from the buckets of these keys alone."""
    found = _scan(spark, path)
    if found is None:
        return None
    rows, buckets = found
    touched = _touched(wanted.select(bucket_of(wanted, keys, buckets).alias("b")), "b")
    near = with_text_keys(rows.filter(F.col(bucket_name(buckets)).isin(touched)), keys)
    return near.join(with_text_keys(wanted.select(*keys), keys).distinct(), list(keys), "left_semi").drop(bucket_name(buckets))


def _touched(df: DataFrame, name: str) -> list[int]:
    """Distinct buckets: never more than the store has."""
    return sorted(row[0] for row in df.select(name).distinct().collect())


def upsert(
    spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str] = DOCUMENT_KEY, buckets: int = BUCKETS
) -> dict[str, int]:
    """Merge rows, one per key, into the store; ``buckets`` counts for a new store only.

    Fields follow :func:`voxlake.sinks.upsert.merge_rows`. Returns how many rows were matched, modified and upserted,
    and how many buckets were read and written.
    """
    found = _scan(spark, path)
    if found is not None:
        buckets = found[1]
    name = bucket_name(buckets)
    fresh = staged(with_text_keys(incoming, keys).withColumn(name, bucket_of(incoming, keys, buckets)), "incoming")
    touched = _touched(fresh, name)
    if found is None:
        existing = spark.createDataFrame([], incoming.drop("_present").schema)
    else:
        existing = found[0].filter(F.col(name).isin(touched)).drop(name)
    merged = merge_rows(existing, fresh.drop(name), keys)
    merged = staged(merged.withColumn(name, bucket_of(merged, keys, buckets)), "merged")
    changed = F.col("_action").isin("modified", "upserted")
    actions = {row["_action"]: row["count"] for row in merged.groupBy("_action").count().collect()}
    written = _touched(merged.filter(changed), name)
    if written:
        overwrite(merged.filter(F.col(name).isin(written)).drop("_action"), path, [name], only_touched_partitions=True)
    discard(fresh, merged)
    return {
        "matched_documents": actions.get("matched", 0) + actions.get("modified", 0),
        "modified_documents": actions.get("modified", 0),
        "upserted_documents": actions.get("upserted", 0),
        "buckets_read": len(touched),
        "buckets_written": len(written),
    }


def redeal(spark: SparkSession, path: str, new_path: str, buckets: int, keys: Sequence[str] = DOCUMENT_KEY) -> None:
    """The store at a new path with another number of buckets."""
    found = _scan(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    rows = found[0].drop(bucket_name(found[1]))
    overwrite(rows.withColumn(bucket_name(buckets), bucket_of(rows, keys, buckets)), new_path, [bucket_name(buckets)])
