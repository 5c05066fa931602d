"""Keyed upsert of documents, and batched writes to external stores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.operators.silver import newest_per_key

# Identity of a stored comment document.
DOCUMENT_KEY = ("run_id", "query_id", "video_id", "comment_id")


def key_columns(df: DataFrame, keys: Sequence[str] = DOCUMENT_KEY) -> list[Column]:
    """Key parts as text with null as blank; kept apart so that no separator can collide."""
    return [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in keys]


def with_text_keys(df: DataFrame, keys: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
    return df.withColumns(dict(zip(keys, key_columns(df, keys))))


def upsertable(documents: DataFrame, order: Sequence[Column], keys: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
    """Documents with a non-blank comment id, the newest per key."""
    keyed = with_text_keys(documents, keys).filter(F.col(keys[-1]) != "")
    return newest_per_key(keyed, keys, order)


PRESENT = "_present"


def field_by_field(documents: DataFrame, order: Column, keys: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
    """Documents of sources with different fields, one per key with a non-blank comment id.

    ``_present`` names the fields that a document has. Each field is that of the last document, in the order, that has
    it, as if the documents were written one after the other; ``_present`` then names the fields that any of them has.
    """
    keyed = with_text_keys(documents, keys).filter(F.col(keys[-1]) != "")
    last = lambda name: F.max_by(name, F.when(F.array_contains(PRESENT, name), order)).alias(name)
    fields = [last(name) for name in documents.columns if name not in keys and name != PRESENT]
    return keyed.groupBy(*keys).agg(*fields, F.array_distinct(F.flatten(F.collect_set(PRESENT))).alias(PRESENT))


def merge_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
    """Full outer key join of the stored and the incoming documents.

    Fields of an incoming document replace stored ones, fields it does not have stay: those that the frame lacks, or
    that ``_present``, where the frame has it, does not name. ``_action`` is ``upserted``,
    ``modified``, ``matched`` (no change) or null for rows that the input does not touch.
    """
    stored = with_text_keys(existing, keys).withColumn("_stored", F.lit(True)).alias("s")
    fresh = incoming.withColumn("_fresh", F.lit(True)).alias("f")
    joined = stored.join(fresh, [F.col(f"s.{k}") == F.col(f"f.{k}") for k in keys], "full")
    both = F.col("_stored").isNotNull() & F.col("_fresh").isNotNull()
    common = [c for c in incoming.columns if c in existing.columns and c not in keys]
    added = [c for c in incoming.columns if c not in existing.columns and c != PRESENT]
    given = lambda name: F.array_contains(f"f.{PRESENT}", name) if PRESENT in incoming.columns else F.lit(True)
    changed = F.lit(False)
    for name in common:
        changed = changed | (given(name) & ~F.col(f"s.{name}").eqNullSafe(F.col(f"f.{name}")))
    for name in added:
        changed = changed | F.col(f"f.{name}").isNotNull()
    action = (
        F.when(F.col("_stored").isNull(), "upserted").when(both & changed, "modified").when(both, "matched")
    )
    out = [F.coalesce(F.col(f"f.{k}"), F.col(f"s.{k}")).alias(k) for k in keys]
    for name in existing.columns:
        if name in keys:
            continue
        if name in common:
            out.append(F.when(F.col("_fresh") & given(name), F.col(f"f.{name}")).otherwise(F.col(f"s.{name}")).alias(name))
        else:
            out.append(F.col(f"s.{name}").alias(name))
    out += [F.col(f"f.{name}").alias(name) for name in added]
    return joined.select(*out, action.alias("_action"))


def merge_counts(merged: DataFrame, input_documents: int | Column) -> DataFrame:
    """One row with input, matched, modified and upserted counts."""
    given = input_documents if isinstance(input_documents, Column) else F.lit(input_documents).cast("bigint")
    return merged.agg(
        F.count_if(F.col("_action").isin("matched", "modified")).alias("matched_documents"),
        F.count_if(F.col("_action") == "modified").alias("modified_documents"),
        F.count_if(F.col("_action") == "upserted").alias("upserted_documents"),
    ).select(given.alias("input_documents"), "*")


def merge_into_table(incoming: DataFrame, table: str, keys: Sequence[str] = DOCUMENT_KEY) -> None:
    """The same upsert as one MERGE, for catalogs whose tables support it."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{table}.{key}") == incoming[key])
    incoming.mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def write_in_batches(
    df: DataFrame, write_batch: Callable[[list[dict]], int], batch_size: int = 1000
) -> DataFrame:
    """Hand each partition to ``write_batch`` in lists of at most ``batch_size`` documents.

    Runs on the executors; returns batches and documents per partition. A retried task writes its batches
    again, so ``write_batch`` has to be idempotent (an upsert is).
    """

    def deliver(chunks: Iterator) -> Iterator:
        import pandas as pd

        waiting: list[dict] = []
        batches = written = 0
        for chunk in chunks:
            waiting.extend(chunk.to_dict("records"))
            while len(waiting) >= batch_size:
                written += write_batch(waiting[:batch_size])
                batches += 1
                waiting = waiting[batch_size:]
        if waiting:
            written += write_batch(waiting)
            batches += 1
        if batches:
            yield pd.DataFrame({"batches": [batches], "documents": [written]})

    return df.mapInPandas(deliver, "batches bigint, documents bigint")
