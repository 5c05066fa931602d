"""Partitioned append, overwrite and contract-checked writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.contracts import CONTRACTS, align
from voxlake.sources.tables import DEFAULT_FORMAT


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a table partition brought together before the write.

    A rebalance (not a plain repartition) lets adaptive execution split a partition value that holds a large
    share of all rows and merge the small ones, so neither a giant task nor a swarm of tiny files comes out.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = DEFAULT_FORMAT) -> None:
    """Append; the first write creates the table."""
    _laid_out(df, partition_by).write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    only_touched_partitions: bool = False,
) -> None:
    """Replace the table, or only the partitions that ``df`` has rows for."""
    writer = _laid_out(df, partition_by).write.format(fmt).mode("overwrite").partitionBy(*partition_by)
    if fmt == "delta" and not only_touched_partitions:
        writer = writer.option("overwriteSchema", "true")
    else:
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched_partitions else "static")
    writer.save(path)


def write_contract(
    df: DataFrame,
    key: str,
    root: str,
    mode: str = "append",
    fmt: str = DEFAULT_FORMAT,
    refuse_empty: bool = True,
    only_touched_partitions: bool = False,
) -> str:
    """Align to the contract and write; an empty frame is an error unless ``refuse_empty`` is off.

    The emptiness check runs the plan up to its first row, so jobs check their input once and switch it off here.
    """
    contract = CONTRACTS[key]
    if refuse_empty and df.isEmpty():
        raise ValueError(f"nothing to write to {key}")
    aligned = align(df, contract)
    path = contract.path(root)
    if mode == "append":
        append(aligned, path, contract.partition_by, fmt)
    elif mode == "overwrite":
        overwrite(aligned, path, contract.partition_by, fmt, only_touched_partitions)
    else:
        raise ValueError(f"unknown mode {mode}")
    return path


def write_messages(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish (key, value) rows to a Kafka topic; delivery is batched by the connector."""
    rows = events.select(F.col("key").cast("string"), F.col("value").cast("string"))
    sink = rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
    sink.option("topic", topic).options(**options).save()
