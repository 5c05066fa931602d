"""Suffix dedup, filter audit and hard negatives against brute force and on edge cases."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.llm import ann, audit, hard_negatives, queries, suffix_dedup

TEXTS = "doc_id long, text string, lang string, size int, chunk int, bounds int, kept string, mask int"


def padded(rows):
    """Rows ``(id, text, lang)`` with columns whose names the operators use themselves."""
    return [(*row, 1, 2, 3, "x", 4) for row in rows]


# ------------------------------------------------------------------ 11 suffixes


def repeats(rows, length):
    """Spans and kept bytes of each row, every string looked up among all earlier ones."""
    seen, out = set(), {}
    for number, text in rows:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                covered[k : k + length] = b"\1" * length
            seen.add(raw[k : k + length])
        spans, at = [], 0
        for gone, run in itertools.groupby(covered):
            n = len(list(run))
            if gone:
                spans.append((at, at + n))
            at += n
        out[number] = (len(raw), spans, bytes(b for b, gone in zip(raw, covered, strict=True) if not gone))
    return out


def told(df):
    return {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()}


def test_covers_hold_every_distance():
    for period, residues in suffix_dedup.COVERS.items():
        assert {(a - b) % period for a in residues for b in residues} == set(range(period))


@pytest.mark.parametrize("seed,length,chunk,bucket,piece", [(0, 100, 2000, 500, 300), (1, 30, 500, 1 << 20, 1 << 20), (2, 5, 1 << 20, 50, 700), (3, 100, 1, 300, 1000)])
def test_repeats_by_brute_force(spark, monkeypatch, seed, length, chunk, bucket, piece):
    for name, value in (("CHUNK", chunk), ("BUCKET", bucket), ("PIECE", piece)):
        monkeypatch.setattr(suffix_dedup, name, value)
    draw = random.Random(seed)
    letters = ["ab", "abcdé", "abcdefghij klm", "xyz"][seed]
    passages = ["".join(draw.choice(letters) for _ in range(draw.randint(20, 400))) for _ in range(6)]

    def piece_of():
        if draw.random() < 0.6:
            return draw.choice(passages)[draw.randint(0, 30) :]
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(1, 150)))

    rows = [(i, "".join(piece_of() for _ in range(draw.randint(0, 6)))) for i in range(40)]
    rows += [(40, None), (41, "x" * 777), (42, "xy" * 300), (43, rows[7][1]), (44, "y" + "x" * 600)]
    want = repeats(rows, length)
    assert sum(len(w[1]) for w in want.values()) > 10
    assert told(suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=length)) == want


def test_repeats_on_edge_cases(spark):
    long = "".join(random.Random(9).choices("abcdefghijklmnopqrstuvwxyz ", k=300_000))
    rows = [(1, long, "en"), (1, long, "en"), (1, long[:150] + "!", "de"), (2, None, None), (3, "", "en"), (4, long[500:600], "en"), (5, long[500:599], "en"), (None, long[1000:1200], None)]
    out = suffix_dedup.without_repeats(spark.createDataFrame(padded(rows), TEXTS)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["n_bytes"], [tuple(s) for s in r["spans"]]))
    assert by[None] == [(200, [])]  # a null id comes first
    assert by[2] == by[3] == [(0, [])] and by[4] == [(100, [(0, 100)])] and by[5] == [(99, [])]
    whole = [x for x in by[1] if x[0] == len(long)]
    assert len(whole) == 2 and whole[0] == whole[1]  # equal rows are one document
    assert suffix_dedup.without_repeats(spark.createDataFrame([], TEXTS)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_a_passage_in_every_document_makes_no_large_group(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 4000)
    passage = "".join(random.Random(5).choices("abcdefgh ", k=240))
    rows = [(i, f"{i} " * 20 + passage + f" {i}" * 20) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = told(suffix_dedup.without_repeats(docs))
    assert found == repeats(rows, 100) and sum(bool(f[1]) for f in found.values()) == 299
    chunks = suffix_dedup.packed(docs, "doc_id", "text")
    # Of each document a name is sent once, and no bucket grows with the documents alone.
    sampled = suffix_dedup._sampled(chunks, 100, 5, 4)
    assert sampled.select("bucket").distinct().count() == 4


# ------------------------------------------------------------------ 12 filters


def test_orders_are_all_met_by_adjacent_swaps():
    for n in range(1, 7):
        order, met = list(range(n)), {tuple(range(n))}
        for k in audit.adjacent_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            assert tuple(order) not in met
            met.add(tuple(order))
        assert len(met) == len(list(itertools.permutations(range(n))))


@pytest.mark.parametrize("filters", ["A", "AB", "XYZ", "ABCDE"])
def test_interactions_by_brute_force(filters):
    draw = random.Random(len(filters))
    docs = [(sum(draw.random() < 0.4 and 1 << k for k in range(len(filters))), draw.random() < 0.3, draw.random() < 0.2) for _ in range(300)]
    counts = {m: tuple(np.sum([(1, g, t) for x, g, t in docs if x == m], axis=0).tolist()) for m in {d[0] for d in docs}}
    found = {(r["filter_order"], r["step"]): r for r in audit.interactions(filters, counts)}
    removed_by = dict.fromkeys(filters, 0)
    orders = ["".join(p) for p in itertools.permutations(filters)]
    assert len(found) == len(orders) * len(filters)
    for order in orders:
        left = docs
        for step, f in enumerate(order, 1):
            bit = 1 << filters.index(f)
            out = [d for d in left if d[0] & bit]
            row = found[order, step]
            removed_by[f] += len(out)
            assert (row["kept"], row["removed"]) == (len(left) - len(out), len(out))
            assert row["redundant"] == sum(bool(d[0] & bit) for d in docs) - len(out)
            assert row["unique_fails"] == sum(d[0] == bit for d in docs)
            assert (row["good_lost"], row["toxic_lost"]) == (sum(d[1] for d in out), sum(d[2] for d in out))
            left = [d for d in left if not d[0] & bit]
    for (order, step), row in found.items():
        assert row["shapley"] == removed_by[order[step - 1]]


def test_equal_nodes_are_shared_and_swaps_keep_the_counts():
    counts = {m: (1, 0, 0) for m in range(32)}
    diagram = audit.Diagram("ABCDE", counts, 3)
    assert [len(level) for level in diagram.levels] == [1] * 5
    for k in (0, 3, 2, 2):
        diagram.swap(k)
    assert diagram.weights[0] == [(32, 0, 0)] and diagram.order == list("BACED")


def test_masks_on_edge_cases(spark):
    long = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (3, long, None), (None, long, "en"), (None, long, "en"), (4, None, None),
        (5, "", "de"), (6, "a " * 200, "de"), (7, "ABC " * 40 + "$", "de"), (8, "w x " * 100, ""), (9, "word " * 90_000, "fr"),
    ]
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (6, 0, 1)], "doc_id long, quality int, toxic int")
    found = {(r["part"], r["mask"]): (r["docs"], r["good"], r["toxic"]) for r in audit.masks(spark.createDataFrame(padded(rows), TEXTS), labels).collect()}
    # 1: first of its text; both rows of 2 and row 3 are repeats; rows without an id are neither.
    assert found[("en", 0)] == (3, 0, 0) and found[("en", 16)] == (2, 2, 2)
    assert found[("", 16)] == (1, 0, 0) and found[("", 1)] == (1, 0, 0)  # 3; 4
    assert found[("de", 1 | 16)] == (1, 0, 0)  # 5 is as empty as 4
    assert found[("de", 2)] == (1, 0, 1) and found[("de", 1 | 2 | 4 | 8)] == (1, 0, 0)
    assert found[("", 2)] == (1, 0, 0) and found[("fr", 2)] == (1, 0, 0)
    none = spark.createDataFrame([], TEXTS)
    assert audit.interactions_of(none, labels).count() == 0
    out = audit.interactions_of(spark.createDataFrame(padded(rows), TEXTS), labels)
    assert out.count() == 4 * 120 * 5 and out.agg(F.min("kept")).first()[0] == 0


# ------------------------------------------------------------------ 13 hard negatives


def mined(rows, anchors, k=5, n=10):
    """All scores of all rows; ``rows`` of ``(id, label, vector)``, equal ones once."""
    whole = {(i, lab, tuple(int(np.floor(256 * float(x))) for x in v)) for i, lab, v in rows if lab is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for anchor, label, vector in sorted(w for w in whole if w[0] in anchors):
        scored = [(-sum(a * b for a, b in zip(vector, v, strict=True)), i, lab) for i, lab, v in whole if i != anchor]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:k]:
            band = sorted(s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score)[:n]
            out += [(anchor, positive, r, i, -score, -s) for r, (s, i, _) in enumerate(band, 1)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<double>, id int, vec int, bucket int, page int, block int, place int"


def with_clashes(rows):
    return [(*r, 1, 2, 3, 4, 5, 6) for r in rows]


@pytest.mark.parametrize("seed,page,piece,block,spread", [(0, 8192, 2048, 512, 0.0), (1, 40, 16, 3, 1.0), (2, 100, 7, 2, 3.0)])
def test_negatives_by_brute_force(spark, monkeypatch, seed, page, piece, block, spread):
    for name, value in (("PAGE", page), ("SLICE", piece), ("BLOCK", block)):
        monkeypatch.setattr(hard_negatives, name, value)
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, 12))
    rows = []
    for i in range(400):
        label = int(draw.integers(4)) if i % 3 else 1
        vector = (centres[label] + draw.normal(size=12) * 0.8) * np.exp(spread * draw.normal())
        rows.append((i, label, [float(x) for x in vector]))
    rows += [(400 + i, i % 4, rows[7][2]) for i in range(60)]  # one vector many times
    rows += [(500, 1, [0.0] * 12), (501, None, rows[3][2]), (502, 2, None), (503, 2, [float("nan")] * 12), (504, 2, [1.0] * 11 + [None]), (505, 3, [])]
    rows += [rows[10], (rows[11][0], 3, rows[12][2]), (0, 2, rows[5][2])]
    frame = spark.createDataFrame(with_clashes(rows), VECTORS)
    out = hard_negatives.mine(frame, frame.where(F.col("vec_id") % 25 == 0))
    found = sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert found == mined(rows, {i for i in range(0, 600, 25)})


def test_negatives_of_few_rows_and_none(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(none, none).count() == 0
    bad = spark.createDataFrame(with_clashes([(100, 1, [float("inf"), 1.0]), (None, 1, [1.0, 2.0])]), VECTORS)
    assert hard_negatives.mine(bad, bad).count() == 0
    few = [(100, 1, [1.0, 0.0]), (101, 1, [1.0, 0.1]), (102, 2, [0.5, 0.0]), (103, 2, [0.95, 0.0]), (104, 3, [-1.0, 0.0])]
    frame = spark.createDataFrame(with_clashes(few), VECTORS)
    out = hard_negatives.mine(frame, frame.where("vec_id = 100")).collect()
    assert [(r["positive_id"], r["negative_id"], r["rank"]) for r in out] == [(101, 102, 1)]


def test_bounds_prune_but_never_a_match(monkeypatch):
    monkeypatch.setattr(hard_negatives, "SLICE", 256)
    draw = np.random.default_rng(3)
    vectors = np.floor(draw.normal(size=(3000, 8)) * draw.uniform(1, 400, size=(3000, 1)))
    page = hard_negatives.Page(vectors)
    looked = 0
    for anchor in np.floor(draw.normal(size=(20, 8)) * 100):
        scores = vectors @ anchor
        for need in (float(np.sort(scores)[-5]), 0.0, -1000.0):
            found = np.concatenate([*page.candidates(anchor, need), np.zeros(0, np.int64)])
            looked += len(found) if need > 0 else 0
            assert set(np.flatnonzero(scores >= need)) <= set(found.tolist())
    assert looked < 20 * 3000 * 0.5


def test_large_components_stay_exact():
    big = np.array([[2.0**40, -3.0], [2.0**20, 5.0]])
    assert hard_negatives.products(big, np.array([2.0**20, 1.0])).tolist() == [2**60 - 3, 2**40 + 5]


def test_registered():
    for name in ("op11_suffix_dedup", "op12_filter_audit", "op13_hard_negatives"):
        assert name in queries.QUERIES and name in queries.SQL


# ------------------------------------------------------------------ 2 vectors, on the cases that grew this round


def test_nearest_on_many_equal_vectors_and_clashing_names(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)] + [(3000 + i, [float(x) for x in draw.normal(size=4)]) for i in range(50)]
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (9001, None), (9002, [0.0] * 4), (9003, [float("nan"), 1.0, 1.0, 1.0]), (9004, [1.0, None, 1.0, 1.0])]
    names = "vec_id long, embedding array<double>, id int, vec int, list int, page int, block int, lists int"
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], names)
    out = ann.nearest(frame, frame.where("vec_id < 600 or vec_id > 9000"))
    found = out.groupBy("query_id").agg(F.collect_list("vec_id").alias("near"), F.max("score").alias("score")).collect()
    assert len(found) == 600
    for r in found:
        assert sorted(r["near"]) == [i for i in range(6) if i != r["query_id"]][:5] and abs(r["score"] - 1) < 1e-12


def test_few_valid_vectors_behind_many_others(spark):
    bad = spark.range(70_000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(0.0)] * 3).alias("embedding"))
    good = spark.createDataFrame([(100_000 + i, [1.0, float(i), 0.5]) for i in range(8)], "vec_id long, embedding array<double>")
    out = ann.nearest(bad.unionByName(good), good)
    assert out.count() == 8 * 5


def test_probes_grow_with_the_lists():
    draw = np.random.default_rng(2)
    vectors = ann.unit(draw.normal(size=(4000, 16)))
    centroids = ann.Centroids.of(ann.balanced(vectors.astype(np.float32), 1000))
    found = ann.probes(centroids, vectors[:600], np.full(1000, 4), 5)
    assert max(len(f) for f in found) > ann.PROBES and len(found) == 600
