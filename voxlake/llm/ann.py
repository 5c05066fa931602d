"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a bounded sample, halved again and again along the line between two means so that all parts stay of
one size. They are held in memory with a graph of near centroids, searched from a few entries with a beam. A vector
goes to the list of its nearest centroid and, near a boundary, to further ones: those not much farther away, unless a
centroid already chosen is nearer to them than the vector is. A query searches the graph and reads the lists whose
distance is within a ratio of the nearest one's, and more while these hold too few vectors.

Every vector is in a list, so the index is over all rows. Lists are read in pages of bounded size against queries in
blocks of bounded size, so neither a list with a third of all vectors nor one with many queries meets in one task. Rows
equal in id and vector are one; pages and blocks are dealt by both, so an id with many vectors is in many of them. A
page gives the best ids of each query, each with its best score, compared exactly in double precision.

Cases: vectors that are null, zero, of another length than most, or that hold null or non-finite components take no
part, nor do rows without an id; rows that share an id are candidates together, with the best score of them, and never
for that id; ties go to the smaller id; with fewer candidates than wanted, all are returned; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import hash_share, map_arrow, staged

#: Numbers of the sample that centroids are fitted to, on average at most (rows times dimensions).
SAMPLE_NUMBERS = 1 << 22
SAMPLE_ROWS = 60_000
#: Vectors of a list, on average, while there are fewer lists than ``MAX_LISTS``.
LIST_SIZE = 128
MAX_LISTS = 4096
NEIGHBOURS, ENTRIES = 24, 64
#: Lists of a vector, at most, and how much farther than the nearest they may be.
REPLICAS, BOUNDARY = 6, 1.12
#: Lists that a query considers: so many, or this share of all where that is more; and how much farther than the nearest
#: they may be. A fixed number loses recall as lists become more.
PROBES, PROBE_SHARE, PRUNE = 96, 0.125, 1.35
#: Queries that are searched for at once.
SEARCHED = 512
PAGE, QUERY_BLOCK = 4096, 1024
#: Pairs that are compared exactly at once.
TIES = 1 << 16


def matrix(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector that takes part, and these vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    good = (lengths == dimensions) & ~np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
    if not good.any():
        return good, np.zeros((0, dimensions))
    values = column.filter(pa.array(good)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    found = values.reshape(-1, dimensions)
    fine = np.isfinite(found).all(axis=1) & (np.where(np.isfinite(found), found, 0) != 0).any(axis=1)
    good[np.flatnonzero(good)[~fine]] = False
    return good, found[fine]


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; equal rows give equal results wherever they are computed."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


@dataclass(frozen=True)
class Centroids:
    """Unit vectors, the near ones of each, and where a search begins."""

    vectors: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    @staticmethod
    def of(vectors: np.ndarray, seed: int = 5) -> Centroids:
        """The graph has the nearest centroids of each, and a few at random that tie far parts together."""
        n, draw = len(vectors), np.random.default_rng(seed)
        near = min(NEIGHBOURS, n - 1)
        graph = np.zeros((n, near), np.int64)
        for low in range(0, n, 512):
            sims = vectors[low : low + 512] @ vectors.T
            sims[np.arange(len(sims)), np.arange(low, low + len(sims))] = -np.inf
            graph[low : low + 512] = np.argsort(-sims, axis=1, kind="stable")[:, :near]
        if n > ENTRIES:
            graph = np.concatenate([graph, draw.integers(0, n, (n, 4))], axis=1)
        entries = np.sort(draw.permutation(n)[:ENTRIES])
        return Centroids(vectors.astype(np.float32), graph, entries)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest found, nearest first, and their cosines; -1 where there are no more."""
        queries = queries.astype(np.float32)
        n = len(queries)
        sims = queries @ self.vectors[self.entries].T
        order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        ids = np.full((n, beam), -1, np.int64)
        best = np.full((n, beam), -np.inf, np.float32)
        ids[:, : order.shape[1]] = self.entries[order]
        best[:, : order.shape[1]] = np.take_along_axis(sims, order, axis=1)
        done = ids < 0
        active = np.arange(n)
        while len(active) and self.graph.shape[1]:
            at = (~done[active]).argmax(axis=1)
            done[active, at] = True
            new = np.sort(self.graph[ids[active, at]], axis=1)
            sim = np.einsum("ad,akd->ak", queries[active], self.vectors[new])
            sim[(new[:, :, None] == ids[active][:, None, :]).any(axis=2)] = -np.inf
            sim[:, 1:][new[:, 1:] == new[:, :-1]] = -np.inf
            all_sims = np.concatenate([best[active], sim], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            all_ids = np.where(np.isneginf(all_sims), -1, np.concatenate([ids[active], new], axis=1))
            all_done = np.concatenate([done[active], np.isneginf(sim)], axis=1)
            ids[active] = np.take_along_axis(all_ids, order, axis=1)
            best[active] = np.take_along_axis(all_sims, order, axis=1)
            done[active] = np.take_along_axis(all_done, order, axis=1) | (ids[active] < 0)
            active = active[~done[active].all(axis=1)]
        return ids, best


def balanced(vectors: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Means of ``parts`` parts of the vectors of about equal size, each halved along the line between two means."""
    draw = np.random.default_rng(seed)
    means = []
    todo = [(np.arange(len(vectors)), parts)]
    while todo:
        rows, k = todo.pop()
        if k == 1:
            mean = vectors[rows].mean(axis=0)
            means.append(mean if np.abs(mean).max() > 1e-9 else vectors[rows[0]])
            continue
        own, cut = vectors[rows], len(rows) * (k // 2) // k
        a, b = own[draw.choice(len(rows), 2, replace=False)]
        for _ in range(6):
            order = np.argsort(own @ (a - b), kind="stable")
            a, b = own[order[cut:]].mean(axis=0), own[order[:cut]].mean(axis=0)
        todo += [(rows[order[:cut]], k // 2), (rows[order[cut:]], k - k // 2)]
    return unit(np.array(means))


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosine.astype(np.float64)))


def homes(centroids: Centroids, vectors: np.ndarray) -> list[np.ndarray]:
    """The lists of each vector, the nearest first."""
    ids, sims = centroids.search(vectors, 3 * REPLICAS)
    near = _distance(sims)
    able = (ids >= 0) & (near <= BOUNDARY * near[:, :1] + 1e-9)
    chosen = np.zeros_like(able)
    chosen[:, 0] = True
    between = _distance(np.einsum("aid,ajd->aij", centroids.vectors[ids], centroids.vectors[ids]))
    for k in range(1, ids.shape[1]):
        shadowed = (chosen & (between[:, k, :] < near[:, k : k + 1])).any(axis=1)
        chosen[:, k] = able[:, k] & ~shadowed & (chosen.sum(axis=1) < REPLICAS)
    return [row[keep] for row, keep in zip(ids, chosen, strict=True)]


def probes(centroids: Centroids, queries: np.ndarray, sizes: np.ndarray, wanted: int) -> list[np.ndarray]:
    """The lists that each query reads: within the ratio, and on until their own ids are more than wanted."""
    if len(queries) > SEARCHED:
        return [x for low in range(0, len(queries), SEARCHED) for x in probes(centroids, queries[low : low + SEARCHED], sizes, wanted)]
    lists = len(centroids.vectors)
    ids, sims = centroids.search(queries, min(max(PROBES, int(PROBE_SHARE * lists)), max(1, lists)))
    near = _distance(sims)
    keep = (ids >= 0) & (near <= PRUNE * near[:, :1] + 1e-9)
    held = np.cumsum(np.where(ids >= 0, sizes[ids], 0), axis=1)
    keep |= (ids >= 0) & (np.concatenate([np.zeros((len(ids), 1), held.dtype), held[:, :-1]], axis=1) <= wanted)
    found = [row[k] for row, k in zip(ids, keep, strict=True)]
    for i in np.flatnonzero(held[:, -1] <= wanted):  # the beam is too short: all lists by distance
        order = np.argsort(-(centroids.vectors @ queries[i].astype(np.float32)), kind="stable")
        found[i] = order[: int(np.searchsorted(np.cumsum(sizes[order]), wanted, "right")) + 1]
    return found


def takes_part(vector: Column, dimensions: int) -> Column:
    """Whether a vector has this length, finite components, and one that is not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (F.size(vector) == dimensions) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def build(rows: DataFrame, dimensions: int) -> Centroids | None:
    """Centroids from a share of the rows; ``rows`` has ``id, vec``."""
    rows = rows.where(takes_part(F.col("vec"), dimensions))
    n = rows.count()
    room = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dimensions))
    drawn = rows.where(hash_share(room / max(1, n), F.col("id"))).dropDuplicates(["id"]).select("id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, found = matrix(batch.column(1), dimensions)
            data = pa.array([v.astype("<f4").tobytes() for v in unit(found)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), data], names=["id", "vec"])

    kind = rows.schema["id"].dataType.simpleString()
    sample = sorted(((r["id"], bytes(r["vec"])) for r in map_arrow(drawn, run, f"id {kind}, vec binary").collect()))
    if not sample and n:
        # A hash share of few rows can be empty: then the first of all, in the order of their hash, is the sample.
        first = rows.orderBy(F.xxhash64("id", "vec")).limit(1).select("id", "vec")
        sample = [(r["id"], bytes(r["vec"])) for r in map_arrow(first, run, f"id {kind}, vec binary").collect()]
    if not sample:
        return None
    vectors = np.array([np.frombuffer(v, "<f4") for _, v in sample], np.float32)
    lists = max(1, min(MAX_LISTS, n // LIST_SIZE, len(vectors) // 4))
    return Centroids.of(balanced(vectors, lists))


def dimensions_of(rows: DataFrame) -> int | None:
    """The commonest length; the smaller of equally common ones."""
    sizes = rows.where("vec is not null and size(vec) > 0").groupBy(F.size("vec").alias("d")).count()
    first = sizes.orderBy(F.desc("count"), "d").first()
    return first["d"] if first else None


def nearest(
    table: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest of ``table``, but its own id."""
    spark = table.sparkSession
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec")).where("id is not null")
    asked = queries.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec")).where("id is not null")
    kind, vector_kind = rows.schema["id"].dataType.simpleString(), rows.schema["vec"].dataType.simpleString()
    dimensions = dimensions_of(rows)
    centroids = build(rows, dimensions) if dimensions else None
    if centroids is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    shared = spark.sparkContext.broadcast(centroids)

    def listed(choose):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good, found = matrix(batch.column(1), dimensions)
                kept = batch.filter(pa.array(good))
                lists = choose(shared.value, unit(found)) if len(found) else []
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(lists, pa.list_(pa.int64()))], names=["id", "vec", "lists"])

        return run

    schema = f"id {kind}, vec {vector_kind}, lists array<long>"
    placed = staged(map_arrow(rows.distinct(), listed(homes), schema), "placed")
    # One row per list, of which there are at most MAX_LISTS. An id counts as own in one list, whatever its vectors.
    total, own = np.zeros(len(centroids.vectors), np.int64), np.zeros(len(centroids.vectors), np.int64)
    for row in placed.select(F.explode("lists").alias("list")).groupBy("list").count().collect():
        total[row["list"]] = row["count"]
    for row in placed.groupBy("id").agg(F.min(F.col("lists")[0]).alias("list")).groupBy("list").count().collect():
        own[row["list"]] = row["count"]
    reading = staged(map_arrow(asked.distinct(), listed(lambda c, v: probes(c, v, own, k)), schema), "probes")
    readers = np.zeros(len(total), np.int64)
    for row in reading.select(F.explode("lists").alias("list")).groupBy("list").count().collect():
        readers[row["list"]] = row["count"]
    pages, blocks = np.maximum(1, -(-total // PAGE)), np.maximum(1, -(-readers // QUERY_BLOCK))
    used = [i for i in range(len(total)) if readers[i] and total[i]]
    plan = F.broadcast(
        spark.createDataFrame([(i, int(pages[i]), int(blocks[i])) for i in used] or [(-1, 1, 1)], "list long, pages int, blocks int")
    )
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("id", "vec"), F.col(n)).cast("int")
    kept = placed.select("id", "vec", F.explode("lists").alias("list")).join(plan, "list")
    left = kept.select("id", "vec", "list", part("pages").alias("page"), each("blocks").alias("block"))
    probing = reading.select("id", "vec", F.explode("lists").alias("list")).join(plan, "list")
    right = probing.select("id", "vec", "list", each("pages").alias("page"), part("blocks").alias("block"))

    def best(vectors: pa.Table, questions: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        of = vectors.column("id").type
        out = [[], [], []]
        if len(vectors) and len(questions):
            _, v = matrix(vectors.column("vec"), dimensions)
            _, q = matrix(questions.column("vec"), dimensions)
            ids, asks = vectors.column("id").to_numpy(), questions.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            v, ids = v[order], ids[order]
            own, starts = np.unique(ids, return_index=True)
            of_row = np.repeat(np.arange(len(own)), np.diff(np.append(starts, len(ids))))
            near = unit(q) @ unit(v).T
            near[asks[:, None] == ids[None, :]] = -np.inf
            top = np.maximum.reduceat(near, starts, axis=1)
            count = min(k, len(own))
            edge = np.partition(top, len(own) - count, axis=1)[:, len(own) - count]
            # All that tie, up to rounding, with the last id or with the best row of their id are compared by the exact measure.
            i, j = np.nonzero((near >= np.maximum(edge[:, None], top[:, of_row]) - 1e-9) & np.isfinite(near))
            score = np.concatenate([np.zeros(0), *[cosines(q[i[a : a + TIES]], v[j[a : a + TIES]]) for a in range(0, len(i), TIES)]])
            order = np.lexsort((-score, of_row[j], i))
            i, j, score = i[order], j[order], score[order]
            first = np.ones(len(i), bool)
            first[1:] = (i[1:] != i[:-1]) | (of_row[j[1:]] != of_row[j[:-1]])
            i, j, score = i[first], j[first], score[first]
            order = np.lexsort((of_row[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            take = np.arange(len(i)) - np.searchsorted(i, i) < k
            out = [asks[i[take]], ids[j[take]], score[take]]
        return pa.table([pa.array(out[0], of), pa.array(out[1], of), pa.array(out[2], pa.float64())], names=names)

    keys = ["list", "page", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, f"query_id {kind}, vec_id {kind}, score double")
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
