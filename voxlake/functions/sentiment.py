"""Lexicon scorer and the rules that turn class probabilities into a result."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlake.functions.columns import WHITESPACE

# The sentiment lexicon.
POSITIVE_WORDS = (
    "good great awesome amazing best love loved excellent fantastic super nice cool worth perfect impressive "
    "favorite favourite strong smooth premium useful helpful beautiful fast powerful happy wow fire"
).split()
NEGATIVE_WORDS = (
    "bad worst waste poor hate hated boring fake useless slow lag laggy issue problem overpriced expensive cheap "
    "disappointing disappointed terrible awful broken bug bugs cringe mid weak class trash scam"
).split()
NEGATION_WORDS = "not no never hardly dont don't isnt isn't wasnt wasn't".split()
POSITIVE_EMOJIS = "🔥 😍 ❤️ ❤ 💕 💯 👏 🙌 🥳 😊 😁 🤩 👌 👍 🎉".split()
NEGATIVE_EMOJIS = "😡 🤮 👎 💩 😒 😞 😠 😭 🤦 🙄 😤".split()

# Classifier labels.
LABEL_NAMES = {
    "LABEL_0": "negative",
    "LABEL_1": "neutral",
    "LABEL_2": "positive",
    "NEGATIVE": "negative",
    "NEUTRAL": "neutral",
    "POSITIVE": "positive",
}


@dataclass(frozen=True)
class Lexicon:
    """Words and thresholds of the lexicon scorer."""

    positive: Iterable[str] = field(default_factory=lambda: tuple(POSITIVE_WORDS))
    negative: Iterable[str] = field(default_factory=lambda: tuple(NEGATIVE_WORDS))
    negations: Iterable[str] = field(default_factory=lambda: tuple(NEGATION_WORDS))
    positive_emojis: Iterable[str] = field(default_factory=lambda: tuple(POSITIVE_EMOJIS))
    negative_emojis: Iterable[str] = field(default_factory=lambda: tuple(NEGATIVE_EMOJIS))
    threshold: float = 0.2


def lexicon_text(text: Column) -> Column:
    """The text as it is tokenized: lower case, typographic apostrophes made plain."""
    return F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("’"), F.lit("'"))


def _emoji_hits(text: Column, emojis: Iterable[str]) -> Column:
    """How many of the emojis the text holds; a text of ASCII alone is not searched for others."""
    found = list(emojis)
    total = F.lit(0)
    for emoji in found:
        total = total + F.when(F.contains(text, F.lit(emoji)), 1).otherwise(0)
    if any(emoji.isascii() for emoji in found):
        return total
    return F.when(F.octet_length(text) > F.length(text), total).otherwise(0)


def word_pattern(words: Iterable[str]) -> str:
    """A regular expression for any of the words with shared prefixes written once, so that matching a position
    costs its common prefix and not one attempt per word."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def branch(node: dict) -> str:
        ways = [letter + branch(rest) for letter, rest in sorted(node.items()) if letter]
        if not ways:
            return ""
        body = "(?:" + "|".join(ways) + ")"
        return body + "?" if "" in node else body

    return branch(tree) or "(?!)"


def lexicon_tokens(text: Column) -> Column:
    """The tokens of a text, which are its runs of ``[a-z']``, in order."""
    return F.regexp_extract_all(lexicon_text(text), F.lit("[a-z']+"), 0)


def lexicon_hits(text: Column, tokens: Column, lexicon: Lexicon) -> Column:
    """struct(positive_hits, negative_hits, token_count) of a text and its ``lexicon_tokens``.

    A word counts for the other side right after a negation. ``tokens`` should be a column of an earlier projection: an
    expression inside a lambda's input is evaluated anew wherever it stands, so that the text would be scanned for each.
    """
    positive, negative = list(lexicon.positive), list(lexicon.negative)
    known, negations = [*positive, *negative], list(lexicon.negations)

    def number(kept: list[str], turned: list[str]) -> Column:
        def counts(token: Column, place: Column) -> Column:
            negated = (place > 0) & F.get(tokens, place - 1).isin(negations)
            return token.isin(known) & ((token.isin(kept) & ~negated) | (token.isin(turned) & negated))

        return F.size(F.filter(tokens, counts))

    raw = F.coalesce(text, F.lit(""))
    return F.struct(
        (number(positive, negative) + _emoji_hits(raw, lexicon.positive_emojis)).alias("positive_hits"),
        (number(negative, positive) + _emoji_hits(raw, lexicon.negative_emojis)).alias("negative_hits"),
        F.size(tokens).alias("token_count"),
    )


def hits_score(hits: Column) -> Column:
    """Unrounded score of a ``lexicon_hits`` struct."""
    return (hits.positive_hits - hits.negative_hits) / F.greatest(hits.token_count, F.lit(1))


def score_label(score: Column, threshold: float = 0.2) -> Column:
    return F.when(score > threshold, "positive").when(score < -threshold, "negative").otherwise("neutral")


def normalize_label(label: Column) -> Column:
    """One of the three label names, from classifier label text."""
    cleaned = F.upper(F.btrim(label, F.lit(WHITESPACE)))
    out = None
    for text, name in LABEL_NAMES.items():
        out = F.when(cleaned == text, name) if out is None else out.when(cleaned == text, name)
    for part, name in (("NEG", "negative"), ("NEU", "neutral"), ("POS", "positive")):
        out = out.when(F.contains(cleaned, F.lit(part)), name)
    return out.otherwise("neutral")


def top_label(positive: Column, neutral: Column, negative: Column) -> Column:
    """Most probable label; ties go to positive, then neutral."""
    return (
        F.when((positive >= neutral) & (positive >= negative), "positive")
        .when(neutral >= negative, "neutral")
        .otherwise("negative")
    )


def probability_columns(text: Column, positive: Column, neutral: Column, negative: Column) -> dict[str, Column]:
    """Result columns of a classifier; blank text is neutral with full confidence."""
    blank = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE)) == ""
    p = F.when(blank, F.lit(0.0)).otherwise(F.coalesce(positive, F.lit(0.0)))
    u = F.when(blank, F.lit(1.0)).otherwise(F.coalesce(neutral, F.lit(0.0)))
    n = F.when(blank, F.lit(0.0)).otherwise(F.coalesce(negative, F.lit(0.0)))
    return {
        "sentiment_score": F.round(p - n, 4),
        "sentiment_label": top_label(p, u, n),
        "sentiment_confidence": F.round(F.greatest(p, u, n), 4),
        "positive_probability": F.round(p, 4),
        "neutral_probability": F.round(u, 4),
        "negative_probability": F.round(n, 4),
    }
