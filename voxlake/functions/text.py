"""Text normalising, display forms, slugs, ids and the keyword tokenizer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlake.functions.columns import WHITESPACE

# Stop words of the keyword mart.
MART_STOP_WORDS = (
    "the and for that this with you your are was were have has had from into about after before they them "
    "their there here what when where which while would could should will just than then very more most such "
    "also only still much many some over under again once best good great nice video videos comment comments "
    "review reviews youtube channel please watch watching today tomorrow first second third one two three lol "
    "omg bro sir"
).split()

# Stop words of the diagnostic driver words.
DRIVER_STOP_WORDS = (
    "the and for that this with you your are was were have has had from they their but not too very all can "
    "just out about into what when where how why will would could should there here then than them his her she "
    "him our its it's dont didnt doesnt im ive ill one two get got really also because after before over under "
    "more most much many some movie movies video review shorts youtube watch watching"
).split()


def normalized(value: Column) -> Column:
    """Trimmed lower-case text, null as blank: the form in which filters compare."""
    return F.lower(F.btrim(F.coalesce(value.cast("string"), F.lit("")), F.lit(WHITESPACE)))


def collapse_spaces(value: Column) -> Column:
    return F.regexp_replace(F.btrim(value, F.lit(WHITESPACE)), r"\s+", " ")


def slug(value: Column, max_length: int = 40) -> Column:
    """Lower-case words joined by ``_``, at most ``max_length`` long, ``custom`` when nothing is left."""
    joined = F.btrim(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), F.lit("_"))
    cut = F.btrim(F.substring(joined, 1, max_length), F.lit("_"))
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("custom"))


def custom_query_id(platform: Column, topic: Column, query_text: Column) -> Column:
    prefix = F.when(F.lower(platform) == "youtube", F.lit("yt")).otherwise(slug(platform, 8))
    return F.concat(prefix, F.lit("-custom-"), slug(topic, 20), F.lit("-"), slug(query_text, 24))


def safe_name(value: Column, default: str = "query") -> Column:
    """Letters, digits, ``-`` and ``_`` only, without outer ``_``."""
    cleaned = F.btrim(F.regexp_replace(value, r"[^\p{L}\p{N}_-]", "_"), F.lit("_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(default))


def display_text(value: Column) -> Column:
    """Underscores as spaces, every run of letters capitalised (``4-NOT x`` gives ``4-Not X``)."""
    runs = F.regexp_extract_all(F.replace(value.cast("string"), F.lit("_"), F.lit(" ")), F.lit(r"\p{L}+|[^\p{L}]+"), 0)
    return F.array_join(F.transform(runs, F.initcap), "")


def shorten(value: Column, max_length: int = 58) -> Column:
    """At most ``max_length`` characters, the dots included."""
    return F.when(
        F.length(value) > max_length, F.concat(F.substring(value, 1, max_length - 3), F.lit("..."))
    ).otherwise(value)


def truncate_text(value: Column, limit: int = 42) -> Column:
    """At most ``limit`` characters, right-stripped, with the dots after them."""
    cut = F.rtrim(F.substring(value, 1, limit), F.lit(WHITESPACE))
    return F.when(F.length(value) > limit, F.concat(cut, F.lit("..."))).otherwise(value)


def word_runs(value: Column, min_length: int = 3) -> Column:
    """All runs of at least ``min_length`` ASCII letters and digits in the lower-cased text."""
    pattern = "[a-z0-9]{%d,}" % min_length
    return F.regexp_extract_all(F.lower(F.coalesce(value, F.lit(""))), F.lit(pattern), 0)


def is_keyword(token: Column, stop_words: Iterable[str]) -> Column:
    """Neither a stop word nor a number."""
    return ~token.isin(list(stop_words)) & ~token.rlike("^[0-9]+$")


def keyword_tokens(value: Column, stop_words: Iterable[str] = MART_STOP_WORDS, min_length: int = 3) -> Column:
    """The keywords of a text in order, repeats kept."""
    words = list(stop_words)
    return F.filter(word_runs(value, min_length), lambda token: is_keyword(token, words))


def token_count(value: Column) -> Column:
    """Number of whitespace-separated pieces."""
    return F.size(F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(r"\S+"), 0))
