"""Hard negatives by coordinate pruning (after LEMP): length buckets, sorted coordinate lists, feasible ranges.

Vectors are rows of integers (components times a scale, rounded down), scores their inner products. Rows are dealt to
length buckets whose lengths differ by a bounded ratio, and a bucket to pages of bounded size. A page keeps, for each
coordinate, the sorted list of its directions' values. An anchor that needs a score of at least ``t`` needs a cosine of
``t / (its length x the bucket's greatest length)`` there: buckets that cannot reach it are skipped; in the others the
angle between anchor and candidate bounds the candidate's value in every coordinate. The ranges of a few focus
coordinates, the anchor's largest, are looked up in the sorted lists, and only what lies in all of them is scored,
exactly. The need rises as places fill.

Two rounds: an anchor's positives are its best rows of the same label; its negatives are, for each positive, the best
rows of other labels within a band of shares of the positive's score. Anchors meet pages in blocks of bounded size;
each meeting gives at most the wanted rows per anchor, of which the best remain, so no group grows with a label, a
length or the table. Every row is met: nothing is sampled and no candidate is dropped unscored but by the bound.

Cases: rows with a null id, label or vector, of another length than most vectors, or with a null or non-finite
component take no part; rows equal in id, label and vector are one; rows with the anchor's id are none of its
candidates, and of other rows that share an id each may be taken; ties go to the smaller id, then to the smaller label;
a vector of zeros scores 0; with fewer rows than wanted, all are returned; an empty table gives an empty one. Scores
are exact while they fit a long; beyond, the query fails.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import map_arrow, staged, with_library

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Shares of the positive's score, in hundredths, that a negative's score lies between.
BAND = (30, 90)
#: Lengths of a bucket are within this ratio.
RATIO = 1.1
#: Rows of a page and of a bucket's slice within it, anchors of a block.
PAGE, SLICE, BLOCK = 8192, 2048, 512
#: Coordinates whose lists are looked up.
FOCUS = 4


def whole(column: pa.ChunkedArray | pa.Array, dimensions: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their integer vectors (as doubles)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    good = (lengths == dimensions) & ~np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
    if not good.any():
        return good, np.zeros((0, dimensions))
    values = column.filter(pa.array(good)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    fine = np.isfinite(values).all(axis=1)
    good[np.flatnonzero(good)[~fine]] = False
    return good, np.floor(values[fine] * scale)


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every partial sum is a whole number below 2^53, else in Python's integers."""
    if not len(rows):
        return np.zeros(0, np.int64)
    if float(np.abs(rows).max()) * float(np.abs(vector).sum()) < 2.0**53:
        return (rows @ vector).astype(np.int64)
    big = [[int(x) for x in row] for row in rows]
    return np.array([sum(a * b for a, b in zip(row, map(int, vector), strict=True)) for row in big], dtype=object)


class Page:
    """Vectors of one length bucket, in slices by falling length, each with its sorted coordinate lists."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        self.order = np.argsort(-lengths, kind="stable")
        self.slices = []
        for low in range(0, len(vectors), SLICE):
            rows = self.order[low : low + SLICE]
            own = lengths[rows]
            unit = vectors[rows] / np.where(own > 0, own, 1)[:, None]
            by_value = np.argsort(unit, axis=0, kind="stable")
            self.slices.append((rows, own[0], own[-1], by_value, np.take_along_axis(unit, by_value, axis=0)))

    def candidates(self, vector: np.ndarray, need: float) -> Iterator[np.ndarray]:
        """Rows of each slice that may score ``need`` or more; ``send`` the need that holds from there on."""
        length = float(np.sqrt((vector * vector).sum()))
        focus = np.argsort(-np.abs(vector), kind="stable")[:FOCUS]
        for rows, most, least, by_value, values in self.slices:
            reach = length * (most if need > 0 else least)
            cosine = -1.0 if need == -np.inf else need / reach if reach > 0 else (2.0 if need > 0 else -1.0)
            if cosine > 1 + 1e-9:
                continue
            found = rows
            if cosine > -1 and length > 0 and least > 0:
                angle = np.arccos(min(1.0, cosine))
                marks = np.zeros(len(rows), np.int8)
                for f in focus:
                    own = np.arccos(np.clip(vector[f] / length, -1, 1))
                    low, high = np.cos(min(np.pi, own + angle)) - 1e-9, np.cos(max(0.0, own - angle)) + 1e-9
                    a, b = np.searchsorted(values[:, f], low, "left"), np.searchsorted(values[:, f], high, "right")
                    marks[by_value[a:b, f]] += 1
                found = rows[marks == len(focus)]
            if len(found):
                risen = yield found
                need = need if risen is None else max(need, risen)


def _best(scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by falling score, id and label."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        few = np.flatnonzero(scores >= edge)
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((labels[few], ids[few], -scores[few]))[:k]]


def _search(page: Page, ids, labels, anchor, *, same: bool, bands: list[tuple[int, int]], k: int) -> list[np.ndarray]:
    """For each band of scores (from, to) the first ``k`` rows of the page, with their scores."""
    number, label, vector = anchor
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in bands]
    floors = [low for low, _ in bands]
    search = page.candidates(vector, float(min(floors)))
    rows = next(search, None)
    while rows is not None:
        keep = (ids[rows] != number) & ((labels[rows] == label) == same)
        rows = rows[keep]
        scores = products(page.vectors[rows], vector)
        for n, (low, high) in enumerate(bands):
            fits = np.flatnonzero((scores >= floors[n]) & (scores <= high))
            if not len(fits):
                continue
            places, points = np.concatenate([held[n][0], rows[fits]]), np.concatenate([held[n][1], scores[fits]])
            top = _best(points, ids[places], labels[places], k)
            held[n] = places[top], points[top]
            if len(top) == k:
                floors[n] = max(low, points[top[-1]])
        try:
            rows = search.send(float(min(floors)))
        except StopIteration:
            rows = None
    return held


def _codes(column: pa.ChunkedArray, *others: pa.ChunkedArray) -> list[np.ndarray]:
    """Labels as numbers that keep their order, alike in all columns."""
    every = np.concatenate([c.to_numpy() for c in (column, *others)])
    known, codes = np.unique(every, return_inverse=True)
    cuts = np.cumsum([len(c) for c in (column, *others)])[:-1]
    return [*np.split(codes.reshape(-1), cuts), known]


def mine(
    table: DataFrame,
    anchors: DataFrame,
    *,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``anchors``."""
    spark = table.sparkSession

    def taken(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec")).where(
            "id is not null and label is not null and size(vec) > 0"
        )

    rows, asked = taken(table), taken(anchors)
    kind, label_kind = rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    result = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], result)
    dimensions = common["d"]
    schema = f"id {kind}, label {label_kind}, vec array<double>, bucket int"

    def integral(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, found = whole(batch.column(2), dimensions, scale)
            lengths = np.sqrt((found * found).sum(axis=1))
            bucket = np.where(lengths > 0, np.floor(np.log(np.maximum(lengths, 1)) / np.log(RATIO)), -1)
            kept = batch.filter(pa.array(good))
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), dimensions).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), vectors, pa.array(bucket, pa.int32())], names=["id", "label", "vec", "bucket"])

    placed = staged(map_arrow(rows, integral, schema).distinct(), "length_buckets")
    anchored = staged(map_arrow(asked, integral, schema).distinct(), "anchors")
    # One row per length bucket: with doubles for vectors there are below 8000 of them, whatever the table.
    sizes = {r["bucket"]: r["count"] for r in placed.groupBy("bucket").count().collect()}
    if not sizes:
        return spark.createDataFrame([], result)
    pages = F.broadcast(spark.createDataFrame([(b, -(-n // PAGE)) for b, n in sizes.items()], "bucket int, pages int"))
    blocks = max(1, -(-anchored.count() // BLOCK))
    part = lambda n: F.pmod(F.xxhash64("id", "label", "vec"), n).cast("int")
    paged = placed.join(pages, "bucket").withColumn("page", part(F.col("pages")))
    left = paged.select("id", "label", "vec", "bucket", "page", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    # A bounded list, one entry per length bucket; an anchor goes to every page of every bucket.
    every_bucket = F.from_json(F.lit(json.dumps([{"bucket": b, "pages": -(-n // PAGE)} for b, n in sizes.items()])), "array<struct<bucket:int,pages:int>>")

    def meeting(asking: DataFrame, run, kinds: str) -> DataFrame:
        """``asking`` (with ``id, label, vec``) against all pages, in blocks."""
        right = asking.withColumn("block", part(F.lit(blocks))).drop("bucket").withColumn("meet", F.explode(every_bucket))
        right = right.withColumn("bucket", F.col("meet.bucket")).withColumn("page", F.explode(F.sequence(F.lit(0), F.col("meet.pages") - 1))).drop("meet")
        keys = ["bucket", "page", "block"]
        return with_library(left).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, kinds)

    def opened(vectors: pa.Table, questions: pa.Table):
        _, v = whole(vectors.column("vec"), dimensions, 1)
        _, q = whole(questions.column("vec"), dimensions, 1)
        own, asking, known = _codes(vectors.column("label"), questions.column("label"))
        return Page(v), vectors.column("id").to_numpy(), own, list(zip(questions.column("id").to_numpy(), asking, q, strict=True)), known

    def find_positives(vectors: pa.Table, questions: pa.Table) -> pa.Table:
        out: list[dict] = []
        if len(vectors) and len(questions):
            page, ids, labels, asking, _ = opened(vectors, questions)
            label_of, vec_of = questions.column("label"), questions.column("vec")
            for n, anchor in enumerate(asking):
                ((places, scores),) = _search(page, ids, labels, anchor, same=True, bands=[(-np.inf, np.inf)], k=positives)
                out += [
                    {"anchor_id": anchor[0], "label": label_of[n].as_py(), "vec": vec_of[n].as_py(), "id": ids[p], "score": int(s)}
                    for p, s in zip(places, scores, strict=True)
                ]
        types = [("anchor_id", questions.schema.field("id").type), ("label", questions.schema.field("label").type)]
        types += [("vec", pa.list_(pa.float64())), ("id", vectors.schema.field("id").type), ("score", pa.int64())]
        return pa.Table.from_pylist(out, pa.schema(types))

    found = meeting(anchored, find_positives, f"anchor_id {kind}, label {label_kind}, vec array<double>, id {kind}, score long")
    by_anchor = W.partitionBy("anchor_id", "label", "vec").orderBy(F.desc("score"), "id")
    chosen = found.withColumn("place", F.row_number().over(by_anchor)).where(F.col("place") <= positives)
    chosen = chosen.groupBy("anchor_id", "label", "vec").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("chosen"))
    wanted = staged(chosen.select(F.col("anchor_id").alias("id"), "label", "vec", "chosen"), "positives")

    def find_negatives(vectors: pa.Table, questions: pa.Table) -> pa.Table:
        kept = {"anchor_id": [], "label": [], "anchor": [], "place": [], "negative_id": [], "negative_label": [], "negative_score": []}
        if len(vectors) and len(questions):
            page, ids, labels, asking, known = opened(vectors, questions)
            for n, anchor in enumerate(asking):
                own = questions.column("chosen")[n].as_py()
                # low * positive <= 100 * negative <= high * positive, in whole numbers.
                bands = [(-(-band[0] * p["score"] // 100), band[1] * p["score"] // 100) for p in own]
                for p, (places, scores) in zip(own, _search(page, ids, labels, anchor, same=False, bands=bands, k=negatives), strict=True):
                    kept["anchor_id"] += [anchor[0]] * len(places)
                    kept["label"] += [known[anchor[1]]] * len(places)
                    kept["anchor"] += [questions.column("anchor")[n].as_py()] * len(places)
                    kept["place"] += [p["place"]] * len(places)
                    kept["negative_id"] += ids[places].tolist()
                    kept["negative_label"] += known[labels[places]].tolist()
                    kept["negative_score"] += [int(s) for s in scores]
        of, label_of = questions.schema.field("id").type, questions.schema.field("label").type
        types = [("anchor_id", of), ("label", label_of), ("anchor", pa.int64()), ("place", pa.int32())]
        types += [("negative_id", vectors.schema.field("id").type), ("negative_label", label_of), ("negative_score", pa.int64())]
        return pa.table([pa.array(kept[name], t) for name, t in types], schema=pa.schema(types))

    # Anchors that share an id and a label are told apart by a hash of the vector; it is the same wherever it is computed.
    asking = wanted.withColumn("anchor", F.xxhash64("vec"))
    kinds = f"anchor_id {kind}, label {label_kind}, anchor long, place int, negative_id {kind}, negative_label {label_kind}, negative_score long"
    against = meeting(asking, find_negatives, kinds)
    keys = ["anchor_id", "label", "anchor", "place"]
    order = W.partitionBy(*keys).orderBy(F.desc("negative_score"), "negative_id", "negative_label")
    ranked = against.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = asking.select(F.col("id").alias("anchor_id"), "label", "anchor", F.explode("chosen").alias("p"))
    named = named.select("anchor_id", "label", "anchor", F.col("p.place").alias("place"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return ranked.join(named, keys).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
