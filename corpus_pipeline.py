"""A training corpus from raw documents, in five stages, each written and read again before the next.

Language ID drops what the model rejects; line dedup removes lines that many sources share; near-dedup keeps one
document of each group of near copies; the mix repeats or leaves documents so that sources meet their weights; the last
stage encodes what is left.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import bpe, langid, lines, mixing, near_dups
from voxlake.llm.common import fresh, read_table, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def told(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is told; the model is fitted to a bounded sample of the labelled ones."""
    return langid.keep_identified(docs, langid.fit(docs))


def without_boilerplate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the lines that many sources share, but for the first place of each; ``n_chars`` is counted anew.

    A document that loses all it had goes; it is found whole where its lines occur first.
    """
    count = fresh(docs, "lines_removed")
    cleaned = lines.dedup_lines(docs, removed_col=count)
    cleaned = cleaned.where((F.col(count) == 0) | F.col("text").rlike(r"\S")).drop(count)
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast("long"))


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return near_dups.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them; every source comes near its share of all words."""
    return mixing.resample(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The ids of every document, with digests of the ids and of what they decode to."""
    return bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", told),
    ("line dedup", without_boilerplate),
    ("near-dedup", without_near_copies),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

#: Stages train models, sketch sets and tilt rates, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, folder)
