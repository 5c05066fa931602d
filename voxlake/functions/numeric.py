"""Ratios, weighted averages, clipping, buckets, change labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score buckets of the endorsement view, right-closed.
SCORE_EDGES = (-1.01, -0.35, -0.05, 0.05, 0.35, 1.01)
SCORE_LABELS = ("Very Negative", "Negative", "Neutral", "Positive", "Very Positive")


def safe_denominator(value: Column) -> Column:
    return F.when(value > 0, value).otherwise(F.lit(1))


def ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient; a denominator of 0 or less counts as 1."""
    return F.round(numerator / safe_denominator(denominator), digits)


def divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def weighted_avg(value: Column, weight: Column) -> Column:
    """Aggregate: weighted mean; plain mean when the weights add up to 0 or less; 0 for no rows."""
    both = value.isNotNull() & weight.isNotNull()
    v = F.when(both, value.cast("double"))
    w = F.when(both, weight.cast("double"))
    total = F.sum(w)
    return F.coalesce(F.when(total > 0, F.try_divide(F.sum(v * w), total)).otherwise(F.avg(v)), F.lit(0.0))


def floor_weighted_avg(value: Column, weight: Column, floor: int = 1) -> Column:
    """Aggregate: weighted mean with every weight raised to at least ``floor``."""
    w = F.greatest(weight, F.lit(floor))
    return F.sum(value * w) / F.sum(w)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull(), out)


def change_pct(current: Column, later: Column) -> Column:
    """Percent change, null without both values or a positive base."""
    return F.when(current > 0, (later - current) / current * 100.0)


def direction(value: Column, threshold: float) -> Column:
    return (
        F.when(value.isNull(), "not enough forecast evidence")
        .when(value > threshold, "rising")
        .when(value < -threshold, "falling")
        .otherwise("stable")
    )


def bucket_index(value: Column, edges: Sequence[float] = SCORE_EDGES) -> Column:
    """0-based right-closed bucket, the lowest edge included; null outside the edges."""
    out = F.when(value.isNull() | (value < edges[0]) | (value > edges[-1]), F.lit(None).cast("int"))
    for index, high in enumerate(edges[1:-1]):
        out = out.when(value <= high, F.lit(index))
    return out.otherwise(F.lit(len(edges) - 2))


def label_by_index(index: Column, labels: Sequence[str] = SCORE_LABELS) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in labels]), (index + 1).cast("int"))


def outcome(comments: Column, errors: Column) -> Column:
    """Collection status of a query."""
    return (
        F.when((comments > 0) & (errors == 0), "success")
        .when((comments > 0) & (errors > 0), "partial_success")
        .when((comments == 0) & (errors > 0), "failed")
        .otherwise("no_data")
    )
