"""Cleaning of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cardlake.functions import cleaning as fn


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[fn.snake_case(c) for c in df.columns])


def canonical_nulls(df: DataFrame) -> DataFrame:
    """Apply :func:`cardlake.functions.cleaning.null_if_blank` to every column."""
    return df.select(*[fn.null_if_blank(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of ``columns`` that exist, in the order asked for."""
    return df.select(*[c for c in columns if c in df.columns])


def prefix_ids(df: DataFrame, **sources: str) -> DataFrame:
    """``prefix_ids(df, user="idx")`` sets ``user`` to ``user<idx>``."""
    return df.withColumns({word: fn.prefixed(word, F.col(source)) for word, source in sources.items()})
