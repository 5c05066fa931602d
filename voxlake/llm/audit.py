"""Audit of how filters interact, by count-weighted decision diagrams.

Every document fails a set of filters, its mask; a part of the corpus is known by how many documents have each mask, of
which there are at most two to the power of the filters, whatever the corpus. These counts of a part become a diagram:
a level for each filter, a node with one edge for "passes" and one for "fails", counts at the end, equal nodes shared,
and the weight of a node being all counts below it. Any order of the filters is a diagram with its levels in that
order. The orders are visited so that neighbours differ by one swap of adjacent levels, which touches the two levels
alone. The path of passes through a diagram tells what each step removes and keeps.

The mask of a document needs no Python: words, letters and signs are expressions, and a text that also has a smaller id
is told by a join on text and id, which spreads however many documents share the text.

Cases: a null text is empty; a null part is the empty string; a row with a null id is neither a repeat nor makes one;
rows that share an id and a text are equals, so both may be first; labels of one id are taken together (any 1 counts),
ids without labels are neither good nor toxic; parts without rows do not appear, so an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import key128, with_library

FILTERS = "ABCDE"
MEASURES = ("docs", "good", "toxic")
#: More filters than these have too many orders to list.
MOST_FILTERS = 8


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D: few words, repeated words, many capitals, odd signs."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("long") > 10 * F.char_length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]


def masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, docs, good, toxic``: documents of each part by the filters they fail (bit 0 is A)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("body")))]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("body"))
    rows = rows.select("id", "part", *[h.alias(n) for h, n in zip(key128(F.col("body")), ("h1", "h2"), strict=True)], sum(bits[1:], bits[0]).alias("own"))
    first = rows.groupBy(F.col("h1").alias("f1"), F.col("h2").alias("f2")).agg(F.min("id").alias("first"))
    at_first = (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & (F.col("id") == F.col("first"))
    judged = rows.join(first, at_first, "left")
    repeats = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << 4).otherwise(0)
    judged = judged.select("id", "part", (F.col("own") + repeats).alias("mask"))
    said = labels.groupBy(F.col(id_col).alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    known = judged.join(said, F.col("id") == F.col("label_id"), "left")
    return known.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )


class Diagram:
    """Levels of nodes ``(passes, fails)``, which point into the next level; the last level holds counts."""

    def __init__(self, filters: str, counts: dict[int, tuple[int, ...]], measures: int):
        none = (0,) * measures
        self.order = list(filters)
        self.ends: list[tuple[int, ...]] = sorted({*counts.values(), none})
        place = {c: i for i, c in enumerate(self.ends)}
        self.levels: list[list[tuple[int, int]]] = []
        # Bottom up: row m of a level stands for the outcomes of the filters above it, bit k for filter k.
        below = [place[counts.get(m, none)] for m in range(1 << len(filters))]
        for k in reversed(range(len(filters))):
            nodes: dict[tuple[int, int], int] = {}
            below = [nodes.setdefault((below[m], below[m | 1 << k]), len(nodes)) for m in range(1 << k)]
            self.levels.insert(0, list(nodes))
        self.weights = [[] for _ in self.levels] + [self.ends]
        for k in reversed(range(len(self.levels))):
            self._weigh(k)

    def _weigh(self, level: int) -> None:
        below = self.weights[level + 1]
        self.weights[level] = [tuple(a + b for a, b in zip(below[p], below[f], strict=True)) for p, f in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next; nodes above and below stay as they are."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        lower, nodes = self.levels[level + 1], {}
        turned = []
        for p, f in self.levels[level]:
            (pp, pf), (fp, ff) = lower[p], lower[f]
            turned.append((nodes.setdefault((pp, fp), len(nodes)), nodes.setdefault((pf, ff), len(nodes))))
        self.levels[level], self.levels[level + 1] = turned, list(nodes)
        self._weigh(level + 1)

    def steps(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """Each filter on the path of passes: what it keeps and what it removes."""
        node = 0
        for k, name in enumerate(self.order):
            passes, fails = self.levels[k][node]
            yield name, self.weights[k + 1][passes], self.weights[k + 1][fails]
            node = passes


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, so that all orders of ``n`` levels are met once (plain changes)."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    while True:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        move = next(inner, None)
        if move is None:
            return
        yield move + 1 if down else move
        down = not down


def interactions(filters: str, counts: dict[int, tuple[int, ...]]) -> list[dict]:
    """One row per order and step of a part with these counts ``(docs, good, toxic)`` by mask."""
    if not 0 < len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"1 to {MOST_FILTERS} different filters, not {filters!r}")
    diagram, moves = Diagram(filters, counts, len(MEASURES)), adjacent_swaps(len(filters))
    failing = {f: sum(c[0] for m, c in counts.items() if m >> k & 1) for k, f in enumerate(filters)}
    alone = {f: counts.get(1 << k, (0,))[0] for k, f in enumerate(filters)}
    rows, shares = [], dict.fromkeys(filters, 0)
    while True:
        order = "".join(diagram.order)
        for k, (f, kept, removed) in enumerate(diagram.steps(), 1):
            shares[f] += removed[0]
            rows.append(
                {"filter_order": order, "step": k, "kept": kept[0], "removed": removed[0], "redundant": failing[f] - removed[0],
                 "unique_fails": alone[f], "good_lost": removed[1], "toxic_lost": removed[2], "filter": f}
            )
        move = next(moves, None)
        if move is None:
            break
        diagram.swap(move)
    return [row | {"shapley": shares[row.pop("filter")]} for row in rows]


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, of ``counted`` as :func:`masks` gives it."""
    schema = pa.schema(
        [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
        + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
    )

    def run(table: pa.Table) -> pa.Table:
        found = table.to_pylist()
        counts = {row["mask"]: tuple(row[m] for m in MEASURES) for row in found}
        return pa.Table.from_pylist([{"part": found[0]["part"]} | row for row in interactions(filters, counts)], schema)

    kinds = ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'string' if f.type == pa.string() else 'long'}" for f in schema)
    return with_library(counted).groupBy("part").applyInArrow(run, kinds)


def interactions_of(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """Audit of the five filters over whole texts; ``columns`` are those of :func:`masks`."""
    return audit(masks(docs, labels, **columns))
