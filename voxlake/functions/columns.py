"""Optional columns, typing of untidy values, dates and JSON fragments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\f\x0b"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or a typed null when the frame does not have it (decided while planning).

    The null's type is what the caller's union or contract expects, so that an absent column costs no cast later.
    """
    absent = F.lit(None).cast(dtype)
    return {n: F.col(n) for n in present(df, [name])}.get(name, absent)


def first_present(df: DataFrame, names: Sequence[str], dtype: str = "double") -> Column:
    """The first of several alternative columns that the frame has, else a typed null."""
    for name in names:
        if name in df.columns:
            return F.col(name).try_cast(dtype)
    return F.lit(None).cast(dtype)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def first_filled(*cols: Column, default: Column | None = None) -> Column:
    """First value that is neither null nor the empty string."""
    parts = [F.nullif(c.cast("string"), F.lit("")) for c in cols]
    if default is not None:
        parts.append(default)
    return F.coalesce(*parts)


def pick(df: DataFrame, names: Sequence[str]) -> Column:
    """``first_filled`` over those of the named columns that exist."""
    found = present(df, names)
    if not found:
        return F.lit(None).cast("string")
    return first_filled(*[text_of(df, name) for name in found])


def text_of(df: DataFrame, name: str) -> Column:
    """A column as text; structs, arrays and maps become JSON."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(F.col(name))
    return F.col(name).cast("string")


def safe_text(value: Column, default: Column | str | None = "") -> Column:
    """Text without surrounding whitespace; null and blank become the default."""
    if isinstance(default, str) and default == "":
        return F.coalesce(F.btrim(value.cast("string"), F.lit(WHITESPACE)), F.lit(""))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(F.btrim(value.cast("string"), F.lit(WHITESPACE)), F.lit("")), fallback)


def safe_int(value: Column, default: Column | int = 0) -> Column:
    """Long from text, through a float where needed (``3.7`` gives 3); bad values give the default."""
    fallback = default if isinstance(default, Column) else F.lit(default).cast("bigint")
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"), fallback)


def strict_int(value: Column, default: int = 0) -> Column:
    """Long from integer text only (``3.7`` gives the default)."""
    return F.coalesce(value.try_cast("bigint"), F.lit(default).cast("bigint"))


def int_or_zero(df: DataFrame, name: str) -> Column:
    """Mart input rule: missing column, null and bad text are all 0."""
    if name not in df.columns:
        return F.lit(0).cast("bigint")
    if isinstance(df.schema[name].dataType, _INTEGRAL):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))
    return safe_int(F.col(name))


def double_or_zero(df: DataFrame, *names: str) -> Column:
    """Mart input rule for floats, over the first of several names the frame has."""
    return F.coalesce(first_present(df, names, "double"), F.lit(0.0))


def resolve_limit(value: Column, default: int) -> Column:
    """Per-row limit when set, else the default."""
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")).try_cast("int"), F.lit(default))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """UTC timestamp from text or any date/time column; unparseable text is null."""
    if name not in df.columns:
        return F.lit(None).cast("timestamp")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("timestamp")
    return F.col(name).cast("timestamp")


def as_date(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("date")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("date")
    return F.col(name).cast("date")


def date_label(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def extended_date(value: Column) -> Column:
    """``{"$date": x}`` (as JSON text) gives x, other JSON objects null, plain text itself."""
    is_object = F.ltrim(value).startswith("{")
    return F.when(is_object, F.get_json_object(value, "$.$date")).otherwise(value)


def date_part(value: Column) -> Column:
    """The date prefix of an ISO text."""
    return F.substring(value, 1, 10)


def language_parts(value: Column) -> tuple[Column, Column]:
    """``["Other", {"LangDetect": "en"}]`` (as JSON text) gives label and code."""
    has_two = F.get_json_object(value, "$[1]").isNotNull()
    label = F.when(has_two & F.btrim(value).rlike(r'^\[\s*"'), F.get_json_object(value, "$[0]"))
    code = F.when(has_two, F.get_json_object(value, "$[1].LangDetect"))
    return label, code


def watch_url(video_id: Column, existing: Column | None = None) -> Column:
    """The given address, else the one that follows from the video id, else blank."""
    cleaned = F.nullif(F.btrim(video_id.cast("string"), F.lit(WHITESPACE)), F.lit(""))
    derived = F.coalesce(F.concat(F.lit("https://www.youtube.com/watch?v="), cleaned), F.lit(""))
    return derived if existing is None else safe_text(existing, derived)


def published_after(ts: Column, as_of: Column, days: Column) -> Column:
    """Whether ``ts`` lies within the last ``days`` days before ``as_of``."""
    return ts >= as_of - F.make_interval(days=days)
