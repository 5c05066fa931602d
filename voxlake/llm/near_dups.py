"""Near-duplicate documents by ProbMinHash, banding and verification.

The terms of a text are its shingles of five words (a shorter text is one shingle), weighted by ``1 + ln(count)``. Each
term is a Poisson process with its weight as rate; every arrival falls on one of ``REGISTERS`` registers, which keep the
term of their first arrival. Two texts agree in a register with a chance equal to their probability Jaccard likeness.
Arrivals are drawn in rounds, and a term ends once its next arrival is behind the last register's first: most terms of a
long text are drawn once or twice. A text that repeats terms has a second sketch with all weights 1, whose registers
agree with a chance equal to the plain Jaccard likeness; where no term repeats, the two sketches are the same.

Texts of equal words are one node. Nodes that agree in a band of registers, of either sketch, share a bucket. Each node is first compared
with the bucket's centre. Where a bucket then still holds several components, its texts meet in blocks under an
inverted index of their terms, and the links between components are found. Every link is verified on whole texts: its
probability Jaccard or plain Jaccard likeness is ``THRESHOLD`` or more. Classes are the connected components of links;
pairs within a component are not compared, nor given out.

Cases: null and empty texts, and rows without an id, have no terms: each is its own class; equal texts are one class,
whatever their ids; the class id is the smallest document id of the class, and where ids repeat the hash of the text tells
classes of one id apart; an empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import drop_folder, fresh, hashed_words, map_arrow, mix64, staged, texts, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
#: Pairs that a worker compares at a time, and terms of texts that it remembers from one to the next.
PAIRS, KNOWN_TERMS = 128, 1 << 20
#: Bytes of the texts of one bucket that meet those of another block in a task.
BLOCK_BYTES = 4 << 20
_STEPS = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64)) for i in range(SHINGLE)]
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ one text


def shingle_rows(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles in row order, the first of each row, and two keys of the words of each row."""
    starts, ends, first = words(raw, bounds)
    w = hashed_words(raw, starts, ends)
    counts = np.diff(first)
    n = len(w)
    place = np.arange(n, dtype=np.uint64) - np.repeat(first[:-1], counts).astype(np.uint64)
    keys = []
    for seed in (0x51, 0xA7):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(w + mix64(place * _GOLDEN + np.uint64(seed))), dtype=np.uint64)])
        keys.append(mix64((sums[first[1:]] - sums[first[:-1]]) + counts.astype(np.uint64) * _GOLDEN))
    grams = np.zeros(n, np.uint64)
    for i, step in enumerate(_STEPS):
        grams[: n - i] += mix64(w[i:] * step) if i else w * step
    grams = mix64(grams)
    left = counts[np.repeat(np.arange(len(counts)), counts)].astype(np.int64) - place.astype(np.int64)
    whole = left >= SHINGLE
    short = (counts > 0) & (counts < SHINGLE)
    grams[first[:-1][short]] = keys[0][short]
    whole[first[:-1][short]] = True
    at = np.flatnonzero(whole)
    return grams[at], np.searchsorted(at, first), keys[0], keys[1]


def weighted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    terms, counts = np.unique(grams, return_counts=True)
    return terms, 1 + np.log(counts)


def sketch(terms: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The term that arrives first in each register."""
    first = np.full(registers, np.inf)
    held = np.zeros(registers, np.uint64)
    active, at = np.arange(len(terms)), np.zeros(len(terms))
    draws = max(1, min(2048, int(7 * registers / max(1, len(terms)))))
    done = 0
    while len(active):
        turns = (np.arange(done, done + draws, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
        bits = mix64(terms[active][:, None] + turns)
        gaps = -np.log(((bits >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) / weights[active][:, None]
        times = at[active][:, None] + np.cumsum(gaps, axis=1)
        early = times < first.max()
        t, who = times[early], np.broadcast_to(terms[active][:, None], times.shape)[early]
        p = ((mix64(bits[early]) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        sooner = t < first[p]
        t, p, who = t[sooner], p[sooner], who[sooner]
        order = np.argsort(-t, kind="stable")  # of several arrivals in a register the earliest is written last
        first[p[order]] = t[order]
        held[p[order]] = who[order]
        at[active] = times[:, -1]
        active = active[times[:, -1] < first.max()]
        done += draws
    return held


def bands(held: np.ndarray) -> np.ndarray:
    """A hash for each band, its number included."""
    grid = held.reshape(BANDS, ROWS)
    out = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN)
    for i in range(ROWS):
        out = mix64(out + grid[:, i] * np.uint64(2 * i + 3))
    return out


def buckets(grams: np.ndarray) -> np.ndarray:
    """The bands of a text, by the weights of its terms and with all weights 1, each once."""
    terms, weights = weighted(grams)
    found = bands(sketch(terms, weights))
    if len(terms) < len(grams):
        found = np.unique(np.concatenate([found, bands(sketch(terms, np.ones(len(terms))))]))
    return found


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Probability Jaccard and plain Jaccard of two texts, each its terms in order and their weights.

    The first adds up, over common terms, ``1 / sum(max(x / x_t, y / y_t))`` over all terms. With common terms in the
    order of ``x / y``, the larger one is ``x`` for those behind ``t`` and ``y`` for those before, so running sums do.
    """
    (ta, wa), (tb, wb) = a, b
    if not len(ta) or not len(tb):
        return 0.0, 0.0
    _, ia, ib = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0, 0.0
    x, y = wa[ia], wb[ib]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    behind_x = np.concatenate([np.cumsum(x[::-1])[::-1][1:], [0.0]]) + (wa.sum() - x.sum())
    before_y = np.cumsum(y) - y + (wb.sum() - y.sum())
    # Terms of one text alone have x / y infinite or 0: behind, or before, all common ones.
    weighted_part = float((1 / (1 + behind_x / x + before_y / y)).sum())
    return weighted_part, len(ia) / (len(ta) + len(tb) - len(ia))


# ------------------------------------------------------------------ all texts


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, tie, k1, k2, buckets``: ``tie`` is a hash of the text, the keys and buckets are null without words."""
    chosen = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, raw, bounds in texts(batch.column(2)):
                grams, first, k1, k2 = shingle_rows(raw, bounds)
                filled = np.diff(first) > 0
                lists, seen = [], {}
                for row in range(end - at):
                    if not filled[row]:
                        lists.append(None)
                        continue
                    key = (int(k1[row]), int(k2[row]))
                    if key not in seen:
                        seen[key] = buckets(grams[first[row] : first[row + 1]]).astype(np.int64)
                    lists.append(seen[key])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, end - at),
                        batch.column(1).slice(at, end - at),
                        pa.array(k1.astype(np.int64), mask=~filled),
                        pa.array(k2.astype(np.int64), mask=~filled),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["doc", "tie", "k1", "k2", "buckets"],
                )

    return map_arrow(chosen, run, f"doc {kind}, tie long, k1 long, k2 long, buckets array<long>")


_NODE = "struct<k1:bigint,k2:bigint>"


def verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """``a, b, weighted, plain``: the likeness of pairs of nodes; ``contents`` has ``node, text``."""
    left = contents.select(F.col("node").alias("na"), F.col("text").alias("text_a"))
    right = contents.select(F.col("node").alias("nb"), F.col("text").alias("text_b"))
    joined = pairs.join(left, F.col("a") == F.col("na")).join(right, F.col("b") == F.col("nb")).select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        held = 0
        for whole in batches:
            for low in range(0, len(whole), PAIRS):
                batch = whole.slice(low, PAIRS)
                sides = []
                for column in (batch.column(2), batch.column(3)):
                    found = []
                    for at, end, raw, bounds in texts(column):
                        grams, first, k1, k2 = shingle_rows(raw, bounds)
                        for row in range(end - at):
                            key = (int(k1[row]), int(k2[row]))
                            if key not in known:
                                if held > KNOWN_TERMS:
                                    known, held = {}, 0
                                known[key] = weighted(grams[first[row] : first[row + 1]])
                                held += len(known[key][0])
                            found.append(known[key])
                    sides.append(found)
                out = np.array([likeness(x, y) for x, y in zip(*sides, strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b", "weighted", "plain"])

    return map_arrow(joined, run, f"a {_NODE}, b {_NODE}, weighted double, plain double")


def alike(threshold: float) -> Column:
    return (F.col("weighted") >= threshold) | (F.col("plain") >= threshold)


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of the component of every linked node.

    Rounds of large stars (greater neighbours to the smallest neighbour) and small stars (all to it), until the edges
    are stars around roots. A node with many neighbours is one minimum and a join that splits its rows.
    """
    spark = links.sparkSession
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "of")
        large = both.join(low, F.col("u") == F.col("of")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "of")
        small = large.join(low, F.col("u") == F.col("of"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("of").alias("u"), F.col("m").alias("v")))
        new = staged(small.distinct(), "edges")
        drop_folder(spark, edges)
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, which has none."""
    lower = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    roots = edges.select(F.col("v").alias("r")).distinct()
    return lower.join(roots, F.col("u") == F.col("r"), "left").where((F.col("n") > 1) | F.col("r").isNotNull()).isEmpty()


def _rooted(df: DataFrame, node: str, roots: DataFrame, name: str) -> DataFrame:
    at = roots.select(F.col("node").alias("at_node"), F.col("root").alias("at_root"))
    return df.join(at, F.col(node) == F.col("at_node"), "left").withColumn(name, F.coalesce("at_root", node)).drop("at_node", "at_root")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, tie, class_id, class_tie, first``: the class of every row, and whether the row stands for it.

    A class is told by the id and the hash of the text of its first row; where ids do not repeat, by the id alone. Rows
    of one class that share both all have ``first``.
    """
    marks = staged(sketches(docs, id_col, text_col), "sketches")
    filled = marks.where("k1 is not null and doc is not null")
    nodes = filled.groupBy(F.struct("k1", "k2").alias("node")).agg(F.any_value("buckets").alias("buckets"))
    spots = nodes.select("node", F.explode("buckets").alias("bucket"))
    crowds = spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).where("n > 1")
    members = staged(spots.join(crowds.select(F.col("bucket").alias("of"), "centre"), F.col("bucket") == F.col("of")).drop("of"), "members")
    near = members.select("node").distinct()
    carriers = filled.groupBy(F.struct("k1", "k2").alias("node")).agg(F.min(F.struct("doc", "tie")).alias("row"))
    carriers = carriers.join(near, "node", "left_semi").select("node", F.col("row.doc").alias("doc"), F.col("row.tie").alias("tie"))
    read = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).cast("string").alias("text"))
    contents = staged(read.join(carriers, ["doc", "tie"]).select("node", "text").dropDuplicates(["node"]), "contents")

    first = staged(verified(members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), contents), "first")
    links = first.where(alike(threshold)).select("a", "b")
    roots = components(links)

    placed = _rooted(_rooted(members, "node", roots, "root"), "centre", roots, "centre_root")
    links = links.unionByName(_links_in_buckets(placed, contents, threshold))
    roots = components(links)

    rooted = _rooted(filled.select("doc", "tie", F.struct("k1", "k2").alias("node")), "node", roots, "root")
    heads = rooted.groupBy("root").agg(F.min(F.struct("doc", "tie")).alias("head")).withColumnRenamed("root", "of")
    found = rooted.join(heads, F.col("root") == F.col("of"))
    found = found.select(F.col("doc").alias("doc_id"), "tie", F.col("head.doc").alias("class_id"), F.col("head.tie").alias("class_tie"), (F.struct("doc", "tie") == F.col("head")).alias("first"))
    alone = marks.where("k1 is null or doc is null").select(F.col("doc").alias("doc_id"), "tie", F.col("doc").alias("class_id"), F.col("tie").alias("class_tie"), F.lit(True).alias("first"))
    return found.unionByName(alone)


def _links_in_buckets(placed: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: links between the components that still meet in a bucket; ``placed`` has ``bucket, node, root, centre_root``.

    The texts of such a bucket are dealt out in blocks of about ``BLOCK_BYTES``, and each two blocks meet in a task.
    There an inverted index from terms to texts gives the overlap of a text with all others at once; only what can
    reach the threshold is compared, and only links that join two components are given.
    """
    apart = placed.where("root <> centre_root").select(F.col("bucket").alias("open")).distinct()
    rows = placed.join(apart, F.col("bucket") == F.col("open")).select("bucket", "node", "root")
    sizes = rows.join(contents.select(F.col("node").alias("of"), F.octet_length("text").alias("n")), F.col("node") == F.col("of"))
    blocks = sizes.groupBy(F.col("bucket").alias("sized")).agg(F.ceil(F.sum("n") / BLOCK_BYTES).cast("int").alias("blocks"))
    dealt = rows.join(blocks, F.col("bucket") == F.col("sized")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    meets = dealt.select("bucket", "node", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meets = meets.select("bucket", "node", "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    read = meets.join(contents.select(F.col("node").alias("of"), "text"), F.col("node") == F.col("of")).select("bucket", "low", "high", "node", "root", "text")

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        found = [None] * len(table)
        for at, end, raw, bounds in texts(table.column("text")):
            grams, first, _, _ = shingle_rows(raw, bounds)
            for row in range(end - at):
                found[at + row] = weighted(grams[first[row] : first[row + 1]])
        pairs = joining_pairs(found, [(r["k1"], r["k2"]) for r in table.column("root").to_pylist()], threshold)
        nodes = table.column("node").combine_chunks()
        ends = [nodes.take(pa.array([p[side] for p in pairs], pa.int64())) for side in (0, 1)]
        return pa.Table.from_arrays(ends, names=["a", "b"])

    return read.groupBy("bucket", "low", "high").applyInArrow(link, f"a {_NODE}, b {_NODE}")


def joining_pairs(found: list[tuple[np.ndarray, np.ndarray]], roots: list, threshold: float) -> list[tuple[int, int]]:
    """Pairs of texts that are alike and join two components; with the given roots they leave no alike pair apart.

    The probability Jaccard likeness is at most the sum of the smaller shares of common terms, which is what the
    index adds up beside their number.
    """
    parent = {r: r for r in roots}

    def top(r):
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    lengths = np.array([len(t) for t, _ in found])
    terms = np.concatenate([t for t, _ in found])
    shares = np.concatenate([w / w.sum() for _, w in found])
    who = np.repeat(np.arange(len(found)), lengths)
    order = np.argsort(terms, kind="stable")
    terms, shares, who = terms[order], shares[order], who[order]
    main = Counter(roots).most_common(1)[0][0]
    pairs = []
    for i, (mine, weights) in enumerate(found):
        if roots[i] == main:
            continue
        low, high = np.searchsorted(terms, mine, "left"), np.searchsorted(terms, mine, "right")
        each = high - low
        at = np.repeat(low - np.cumsum(each) + each, each) + np.arange(each.sum())
        common = np.bincount(who[at], minlength=len(found))
        least = np.bincount(who[at], np.minimum(shares[at], np.repeat(weights / weights.sum(), each)), len(found))
        plain = common / (lengths + len(mine) - common)
        for j in np.flatnonzero((plain >= threshold) | (least >= threshold - 1e-9)).tolist():
            if top(roots[i]) != top(roots[j]) and max(likeness(found[i], found[j])) >= threshold:
                parent[top(roots[i])] = top(roots[j])
                pairs.append((i, j))
    return pairs


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class; of rows equal in id and text, one. Rows without an id all stay."""
    found = staged(classes(docs, id_col=id_col, text_col=text_col, threshold=threshold), "classes").where("first")
    key, tie, n = fresh(docs, "kept_doc"), fresh(docs, "kept_tie"), fresh(docs, "kept_rows")
    kept = found.groupBy(F.col("doc_id").alias(key), F.col("tie").alias(tie)).agg(F.count(F.lit(1)).alias(n))
    joined = docs.join(kept, docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(docs[text_col]) == F.col(tie)))
    once = joined.where((F.col(n) == 1) | F.col(key).isNull()).select(*[docs[c] for c in docs.columns])
    several = joined.where((F.col(n) > 1) & F.col(key).isNotNull()).select(*[docs[c] for c in docs.columns], F.col(tie))
    return once.unionByName(several.dropDuplicates([id_col, tie]).drop(tie))
