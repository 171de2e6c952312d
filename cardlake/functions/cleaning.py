"""Cleaning of single values."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# Texts that stand for a missing value.
NULL_WORDS = ("nan", "", "na")
SENTINELS = ("nan", "None", "NaN")
NO_ERROR = "No error"


def snake_case(name: str) -> str:
    """``Per Capita Income - Zipcode`` → ``per_capita_income__zipcode``; runs of blanks are not merged."""
    return re.sub(r"[^\w\s]", "", name.strip()).replace(" ", "_").lower()


def snake_case_value(c: Column) -> Column:
    """The same rule for text in a column; ``(?U)`` makes the classes Unicode-aware."""
    trimmed = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.lower(F.replace(F.regexp_replace(trimmed, r"(?U)[^\w\s]", ""), F.lit(" "), F.lit("_")))


def strip(c: Column) -> Column:
    """Drop white space of every kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def null_if_blank(c: Column, kind: T.DataType) -> Column:
    """Null for NaN and for text that only says that nothing is there."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, T.StringType):
        return F.when(~F.lower(strip(c)).isin(*NULL_WORDS), c)
    return c


def null_if_sentinel(c: Column, words: Iterable[str] = SENTINELS) -> Column:
    """Null for exactly the given words."""
    return F.when(~c.isin(*words), c)


def money(c: Column) -> Column:
    """``$1,200.50`` → 1200.5; null for text that is no number."""
    return F.regexp_replace(c, "[$,]", "").try_cast("double")


def yes_flag(c: Column) -> Column:
    """1 for exactly ``Yes``, else 0."""
    return F.when(c == "Yes", 1).otherwise(0)


def or_default(c: Column, default: str = NO_ERROR) -> Column:
    return F.coalesce(c, F.lit(default))


def prefixed(word: str, c: Column) -> Column:
    """``user`` and 7 → ``user7``."""
    return F.concat(F.lit(word), c.cast("long").cast("string"))


def card_key(user: Column, card: Column) -> Column:
    """``user_card``; null when either part is."""
    return F.concat(user.cast("string"), F.lit("_"), card.cast("string"))


def event_time(year: Column, month: Column, day: Column, time: Column) -> Column:
    """The timestamp behind year, month, day and an ``H:mm`` text; null if there is no such moment."""
    text = F.format_string("%04d-%02d-%02d %s", year, month, day, time)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm"))


def text_field(content: Column, message: Column) -> Column:
    """``content`` unless it is null or empty, else ``message``."""
    return F.coalesce(F.nullif(content, F.lit("")), message)
