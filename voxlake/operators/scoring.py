"""Sentiment enrichment: lexicon scorer in the JVM, or a pluggable batch classifier in Python workers."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions.columns import int_or_zero
from voxlake.functions.sentiment import (
    LABEL_NAMES,
    Lexicon,
    hits_score,
    lexicon_hits,
    lexicon_tokens,
    probability_columns,
    score_label,
)
from voxlake.functions.text import token_count
from voxlake.operators.silver import keep_last

# Columns the enrichment needs and passes on.
REQUIRED = (
    "run_id collection_date ingested_at platform ingestion_type query_id query_text topic genre video_id "
    "video_title channel_title comment_id comment_text comment_like_count reply_count comment_published_at "
    "author_display_name"
).split()

Scores = list[dict[str, float]]
ScorerFactory = Callable[[], Callable[[list[str]], Sequence[Scores]]]


def score_with_lexicon(df: DataFrame, lexicon: Lexicon | None = None, text: str = "comment_text") -> DataFrame:
    """Score, label, hits and token count per row; the label looks at the unrounded score."""
    lex = lexicon or Lexicon()
    tokens = df.withColumn("_tokens", lexicon_tokens(F.col(text)))
    hits = tokens.withColumn("_hits", lexicon_hits(F.col(text), F.col("_tokens"), lex))
    scored = hits.withColumn("_score", hits_score(F.col("_hits")))
    return scored.withColumns(
        {
            "sentiment_score": F.round("_score", 4),
            "sentiment_label": score_label(F.col("_score"), lex.threshold),
            "positive_hits": F.col("_hits.positive_hits").cast("bigint"),
            "negative_hits": F.col("_hits.negative_hits").cast("bigint"),
            "token_count": F.col("_hits.token_count").cast("bigint"),
        }
    ).drop("_tokens", "_hits", "_score")


def _lexicon_columns(df: DataFrame, lexicon: Lexicon | None) -> DataFrame:
    """Lexicon result in the shape of a classifier's: the score is split into class shares."""
    scored = score_with_lexicon(df, lexicon)
    score = F.col("sentiment_score")
    up, down = F.greatest(score, F.lit(0.0)), F.greatest(-score, F.lit(0.0))
    rest = F.round(1 - F.abs(score), 4)
    return scored.withColumns(
        {
            "sentiment_confidence": F.greatest(up, down, rest),
            "positive_probability": up,
            "neutral_probability": rest,
            "negative_probability": down,
            "sentiment_model": F.lit("lexicon"),
        }
    )


def classify(factory: ScorerFactory, batch_size: int = 32) -> Callable[[Column], Column]:
    """An Arrow iterator UDF from text to class probabilities.

    ``factory`` runs once per Python worker process and returns the scorer, which gets lists of at most
    ``batch_size`` non-blank whole texts and returns label/score pairs for each. Only the text column travels
    to Python; everything that follows from the probabilities is computed in the JVM.
    """
    key = uuid.uuid4().hex
    known = dict(LABEL_NAMES)
    parts = {"NEG": "negative", "NEU": "neutral", "POS": "positive"}

    def label_name(label: str) -> str:
        cleaned = str(label).strip().upper()
        return known.get(cleaned) or next((name for part, name in parts.items() if part in cleaned), "neutral")

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Workers are reused by later tasks; the last model stays loaded in a module that only holds it.
        held = sys.modules.setdefault("_voxlake_scorer", types.ModuleType("_voxlake_scorer"))
        if getattr(held, "key", None) != key:
            held.scorer, held.key = factory(), key
        for texts in series:
            filled = texts.fillna("").tolist()
            found = {name: [0.0] * len(filled) for name in ("positive", "neutral", "negative")}
            active = [i for i, text in enumerate(filled) if text.strip()]
            for start in range(0, len(active), batch_size):
                places = active[start : start + batch_size]
                for place, scores in zip(places, held.scorer([filled[i] for i in places])):
                    for item in scores:
                        found[label_name(item["label"])][place] = float(item["score"])
            yield pd.DataFrame(found, index=texts.index)

    return F.pandas_udf(run, "struct<positive: double, neutral: double, negative: double>")


def score_with_classifier(
    df: DataFrame, factory: ScorerFactory, model_name: str, batch_size: int = 32, text: str = "comment_text"
) -> DataFrame:
    scored = df.withColumn("_p", classify(factory, batch_size)(F.col(text)))
    result = probability_columns(F.col(text), F.col("_p.positive"), F.col("_p.neutral"), F.col("_p.negative"))
    return scored.withColumns(
        {
            **result,
            "sentiment_model": F.lit(model_name),
            "token_count": token_count(F.col(text)).cast("bigint"),
        }
    ).drop("_p")


def enrich_sentiment(
    comments: DataFrame,
    factory: ScorerFactory | None = None,
    model_name: str = "lexicon",
    lexicon: Lexicon | None = None,
    batch_size: int = 32,
    processed_at: str | None = None,
    deduplicated: bool = False,
) -> DataFrame:
    """The scored comment table.

    Duplicates go before the scoring, so each comment is scored once; with ``deduplicated`` (the silver table is
    keyed by comment id) there is no shuffle at all.
    """
    missing = [name for name in REQUIRED if name not in comments.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    language = F.col("language_target") if "language_target" in comments.columns else F.lit("unknown")
    counts = ("comment_like_count", "reply_count")
    df = comments.select(
        *[
            (
                int_or_zero(comments, name)
                if name in counts
                else F.coalesce(name, F.lit("")).cast("string") if name == "comment_text" else F.col(name)
            ).alias(name)
            for name in REQUIRED
        ],
        language.alias("language_target"),
    )
    if not deduplicated:
        df = keep_last(df)
    if factory is None:
        scored = _lexicon_columns(df, lexicon)
    else:
        scored = score_with_classifier(df, factory, model_name, batch_size).withColumns(
            {
                "positive_hits": F.round(F.col("positive_probability") * 100).cast("bigint"),
                "negative_hits": F.round(F.col("negative_probability") * 100).cast("bigint"),
            }
        )
    columns = [
        *REQUIRED,
        *"language_target sentiment_score sentiment_label sentiment_confidence positive_probability".split(),
        *"neutral_probability negative_probability sentiment_model positive_hits negative_hits token_count".split(),
    ]
    out = scored.select(*columns)
    return out if processed_at is None else out.withColumn("processed_at", F.lit(processed_at))
