"""Sums and several distinct counts per group from one pass over the input.

One aggregate with several distinct counts copies every row once per count; an aggregate of its own for each count
reads the input again. Here rows are added up once per group and combination of counted values. The values are then
counted one after the other: of the rows that hold one value of a group, one is marked, the marks are added up, and the
value is dropped from the key. Each step shrinks the table, so only the first works on as many rows as there are values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counted(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, Column]) -> DataFrame:
    """Per group the distinct counts (result name to column, null not counted) and the sums (name to row expression).

    List the column with most values first. Without keys there is one row, also for no input; sums of nothing are null
    within a group and 0 rows count 0.
    """
    columns = list(dict.fromkeys(distinct.values()))
    values = [c for c in columns if c not in keys]
    part = df.select(*keys, *values, *[expr.alias(name) for name, expr in sums.items()])
    add = lambda names: [F.sum(name).alias(name) for name in names]
    done: list[str] = []
    out = part.groupBy(*keys, *values).agg(*add(sums)) if values else part
    for n, value in enumerate(values[:-1]):
        rest = values[n + 1 :]
        order = Window.partitionBy(*keys, value).orderBy(*rest)
        first = (F.row_number().over(order) == 1) & F.col(value).isNotNull()
        marked = out.withColumn("_first", first.cast("bigint")).groupBy(*keys, *rest)
        out = marked.agg(*add([*sums, *done]), F.sum("_first").alias(_mark(value)))
        done.append(_mark(value))
    last = [F.count(values[-1]).alias(_mark(values[-1]))] if values else []
    out = out.groupBy(*keys).agg(*add([*sums, *done]), *last)
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    # A counted column that is a key has one value in its group, or none.
    counts = [(zero(_mark(c)) if c in values else F.col(c).isNotNull().cast("bigint")).alias(alias) for alias, c in distinct.items()]
    return out.select(*keys, *counts, *sums)


def _mark(value: str) -> str:
    return f"_distinct_{value}"


def row_counts(**conditions: Column) -> dict[str, Column]:
    """Sums that count the rows for which a condition holds."""
    return {name: F.when(condition, 1).otherwise(0).cast("bigint") for name, condition in conditions.items()}
