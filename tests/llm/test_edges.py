"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from voxlake.llm import bpe, langid, lines, mixing, near_dups, rans, secret_scan, simhash

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000
ROWS = [
    (1, "the cat and the dog sat on the warm mat in the sun", "en", "a"),
    (1, "the cat and the dog sat on the warm mat in the sun", "en", "a"),
    (1, "a second text under one id, with other words in it", "en", "b"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \n\t ", "de", None),
    (5, LONG, "en", None),
    (6, "der Hund und die Katze lagen auf der warmen Matte", "de", "b"),
    (7, "12345 --- !!!", None, "c"),
    (None, "a row without an id but with some words in it", "en", "a"),
    (None, None, None, None),
    (8, "été naïve \U0001f600 café", "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHES = "size taken copies start node key tie place site h1 h2 w1 first mix_key mix_times kept_doc gone_places part query rank bucket doc".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.withColumns({name: F.lit(1) for name in CLASHES}).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def tables(folder, docs):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)


BPE = (public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
RANS = public_tokenizers.path(rans.VOCABULARY)
OPERATORS = {
    "lines": lambda d: lines.dedup_lines(d),
    "mix": lambda d: mixing.mix(d),
    "simhash": lambda d: simhash.compare_with_edits(d),
    "near": lambda d: near_dups.classes(d),
    "bpe": lambda d: bpe.encode(d, *BPE),
    "langid": lambda d: langid.identify(d, langid.fit(d)),
    "rans": lambda d: rans.written_and_read(d, RANS),
    "secrets": lambda d: secret_scan.scan(d, secret_scan.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(docs, name):
    assert OPERATORS[name](docs).count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_keeps_columns(spark, docs, none, name, stage):
    for frame in (docs, none):
        out = stage(spark, frame, "")
        assert out.count() <= 3 * len(ROWS)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]


def test_whole_pipeline(spark, docs, tmp_path):
    out = corpus_pipeline.run(spark, tables(tmp_path, docs))
    assert {r["doc_id"] for r in out.collect()} >= {6}


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_defined_results(docs):
    sizes = by_id(mixing.mix(docs), "size", "taken")
    assert sizes[2] == (0, 0) and sizes[4] == (0, 0) and sizes[5][0] == 32000
    told = by_id(langid.identify(docs, langid.fit(docs)), "lang_pred", "score")
    assert told[2] == told[3] == told[4] == told[7] == ("und", 0.0)
    ids = by_id(bpe.encode(docs, *BPE), "n_tokens", "n_bytes")
    assert ids[2] == ids[3] == (0, 0) and ids[5][1] == len(LONG)
    files = by_id(rans.written_and_read(docs, RANS), "n_tokens")
    assert files[2] == files[3] == files[4] == (1,)
    prints = by_id(simhash.compare_with_edits(docs), "fingerprint", "n_chars")
    assert prints[2] == prints[3] == ("0" * 16, 0) and prints[5][1] == len(LONG)
    classes = by_id(near_dups.classes(docs), "class_id")
    assert classes[2] == (2,) and classes[3] == (3,) and classes[None] == (None,)
    texts = by_id(lines.dedup_lines(docs), "text")
    assert texts[2] == (None,) and texts[3] == ("",) and texts[5] == (LONG,)


def test_near_stage_keeps_one_of_equal_rows(spark, docs):
    out = corpus_pipeline.without_near_copies(spark, docs, "")
    assert sorted(str(r["doc_id"]) for r in out.collect() if r["doc_id"] == 1) == ["1", "1"]  # two texts under one id
    assert out.where("doc_id is null").count() == 2


def test_near_stage_keeps_every_text_of_an_id(spark):
    """A, A, B, B under one id: one A and one B stay, and their classes are told apart."""
    a, b = "the cat and the dog sat on the warm mat in the sun", "a second text under one id, with other words in it"
    docs = spark.createDataFrame([(1, a, "x"), (1, a, "y"), (1, b, "x"), (1, b, "y"), (2, a, "x")], "doc_id long, text string, source string")
    out = corpus_pipeline.without_near_copies(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted([(1, a), (1, b)])
    told = near_dups.classes(docs)
    assert told.select("class_id", "class_tie").distinct().count() == 2 and told.count() == 5


def test_all_mixed_rows_of_one_id_share_their_copies(spark, docs):
    taken = mixing.mix(docs.where("doc_id = 1"), cap=3.0, weights=(1,))
    again = mixing.resample(docs.where("doc_id = 1"), weights=(1,))
    assert taken.agg(F.sum("taken")).first()[0] == 13 * 2 + 11
    assert again.count() == taken.agg(F.sum(F.ceil(F.col("taken") / F.col("size")))).first()[0]
