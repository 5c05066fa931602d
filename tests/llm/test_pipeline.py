"""Each stage of the pipeline against brute force on what the stage before it kept."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from voxlake.llm import bpe, langid, lines, near_dups

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    """The documents, and the rows of every stage; some texts are copied over sources, whole and nearly."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    some = docs.where("doc_id % 9 = 0")
    copies = [
        some.withColumn("doc_id", F.col("doc_id") + 10_000 * k).withColumn("source", F.lit(f"copy{k}")).withColumn(
            "text", F.concat("text", F.lit(f"\nshared notice {k % 2} on many sites\nown{k} words{k} here{k}")))
        for k in range(1, 7)
    ]
    for copy in copies:
        docs = docs.unionByName(copy)
    noise = spark.createDataFrame([(90_001, "12345 !!!", None, "src0", 9), (90_002, None, "en", "src1", None)], docs.schema)
    docs = docs.unionByName(noise).cache()
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return [rows.collect() for rows in out]


def test_language_stage_keeps_what_is_told(spark, stages):
    before, after = stages[0], stages[1]
    kept = {r["doc_id"] for r in after}
    lost = {r["doc_id"] for r in before} - kept
    assert {90_001, 90_002} <= lost and len(lost) <= 2 + 0.01 * len(before)
    assert [r for r in after] == [r for r in before if r["doc_id"] in kept] or len(after) == len(kept)


def test_line_stage(stages):
    before, after = stages[1], {r["doc_id"]: r for r in stages[2]}
    sites, first = {}, {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        for place, line in enumerate(r["text"].split("\n")):
            bare = line.strip(" \t\r")
            if bare:
                sites.setdefault(bare, set()).add(r["source"])
                first.setdefault(bare, (r["doc_id"], place))
    gone = 0
    for r in before:
        kept = [x for p, x in enumerate(r["text"].split("\n")) if len(sites.get(x.strip(" \t\r"), ())) < lines.MIN_SITES or first[x.strip(" \t\r")] == (r["doc_id"], p)]
        text = "\n".join(kept)
        if text != r["text"] and not text.strip():
            gone += 1
            assert r["doc_id"] not in after
        else:
            assert (after[r["doc_id"]]["text"], after[r["doc_id"]]["n_chars"]) == (text, len(text))
    assert len(after) == len(before) - gone


def test_near_stage(stages):
    before, after = stages[2], stages[3]
    grams = []
    for r in before:
        words = r["text"].split()
        found = [int.from_bytes(hashlib.md5(" ".join(words[i : i + 5]).encode()).digest()[:8], "little") for i in range(max(1, len(words) - 4))]
        grams.append(near_dups.weighted(np.array(found, np.uint64)))
    root = list(range(len(before)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(before)):
        for j in range(i):
            if min(len(grams[i][0]), len(grams[j][0])) >= 0.1 * max(len(grams[i][0]), len(grams[j][0])) and max(near_dups.likeness(grams[i], grams[j])) >= near_dups.THRESHOLD:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(before):
        least[find(i)] = min(least.get(find(i), r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())
    assert {r["doc_id"]: r for r in after} == {r["doc_id"]: r for r in before if r["doc_id"] in set(least.values())}


def test_mix_stage(stages):
    before, after = {r["doc_id"]: r for r in stages[3]}, stages[4]
    times = {}
    for r in after:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert r == before[r["doc_id"]]
    assert max(times.values()) <= 3
    size = {d: len(r["text"].split()) for d, r in before.items()}
    names = sorted({r["source"] for r in before.values()})
    sums = {n: sum(size[d] for d, r in before.items() if r["source"] == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    full = {}
    while True:
        free = [n for n in names if n not in full]
        share = (sum(sums.values()) - sum(full.values())) / sum(weight[n] for n in free)
        over = [n for n in free if weight[n] * share > 3 * sums[n]]
        if not over:
            break
        full |= {n: 3 * sums[n] for n in over}
    for n in names:
        target = full.get(n, weight[n] * share)
        taken = sum(k * size[d] for d, k in times.items() if before[d]["source"] == n)
        # The stage reads the one document that is taken in part as a whole.
        assert target - 1 <= taken <= target + 1 + max(size[d] for d, r in before.items() if r["source"] == n)


def test_encoding_stage(stages):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in stages[4]}
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_equals_its_stages(spark, stages, tmp_path):
    spark.createDataFrame(stages[0]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in stages[5])
    assert langid.UNKNOWN == "und"
