"""Equi-joins that look a row up in a table of unique keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOT_SHARE = 1 / 256
SALTS = 64
BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64
_TRACKED = 1 << 14  # entries of a frequent-items sketch; its counts are off by at most 3.5 / 2**14 of the rows


def hot_keys(counted: DataFrame, key: str, count: str = "n", share: float = HOT_SHARE) -> list:
    """Keys that hold at least ``share`` of all rows; there are at most ``1 / share`` of them."""
    total = counted.agg(F.sum(count)).first()[0] or 0
    return [r[0] for r in counted.where(F.col(key).isNotNull() & (F.col(count) >= total * share)).select(key).collect()]


def heavy_keys(facts: DataFrame, columns: Mapping[str, Column], share: float = HOT_SHARE) -> dict[str, list]:
    """Per name the values that hold at least ``share`` of the rows of ``facts`` (null not among them).

    They are counted where they matter, in the rows to be joined: a value that the other table does not know is found too. Every
    task keeps a frequent-items sketch of fixed size and the sketches are merged, so no key is shuffled, whatever their number.
    """
    names = list(columns)
    seen = facts.select(*[columns[n].alias(f"k{i}") for i, n in enumerate(names)])
    found = seen.agg(F.count("*").alias("n"), *[F.expr(f"approx_top_k(k{i}, {int(4 / share)}, {_TRACKED})").alias(f"top{i}")
                                                for i in range(len(names))]).first()
    least = found["n"] * (share - 3.5 / _TRACKED)
    return {n: [e["item"] for e in found[f"top{i}"] or [] if e["item"] is not None and e["count"] >= least] for i, n in enumerate(names)}


def _value_bytes(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(8 * F.size(c), F.lit(0))
    if isinstance(kind, T.StructType):
        return sum((_value_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def row_bytes(df: DataFrame) -> Column:
    """About the memory a row takes, from the true lengths of its texts and arrays."""
    return sum((_value_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(_ROW_OVERHEAD).cast("long"))


def table_bytes(df: DataFrame) -> int:
    """The size of a table in memory, measured by a scan."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def lookup(facts: DataFrame, table: DataFrame, key: str, how: str = "left", size: int | None = None,
           hot: Sequence | Callable[[], Sequence] | None = None, spread: Sequence[str] | None = None,
           salts: int = SALTS) -> DataFrame:
    """Join ``table`` (one row per ``key``) to ``facts``.

    A table of a measured ``size`` up to ``BROADCAST_BYTES`` is broadcast. A greater one is joined by a shuffle, in which
    the rows of the ``hot`` keys are spread over ``salts`` tasks by a hash of the ``spread`` columns, and the few hot rows
    of the table are repeated for it. The hash depends on the row alone, so a task that runs again places rows the same
    way. ``hot`` may be a function, which is only called for a shuffle; by default the keys are counted in ``facts``.
    Rows whose key is null can meet no row: an inner join drops them before the shuffle, a left join spreads them too.
    """
    if size is not None and size <= BROADCAST_BYTES:
        return facts.join(F.broadcast(table), key, how)
    if hot is None:
        hot = partial(heavy_keys, facts, {key: F.col(key)})
    found = hot() if callable(hot) else hot
    keys = list(found[key] if isinstance(found, Mapping) else found)
    if how == "inner":
        facts = facts.where(F.col(key).isNotNull())
    loose = F.col(key).isNull() if how == "left" else F.lit(False)
    if not keys and how != "left":
        return facts.join(table, key, how)
    zero = F.lit(0).cast("long")
    is_hot = F.col(key).isin(keys) if keys else F.lit(False)
    salt = F.when(loose | is_hot, F.pmod(F.xxhash64(*(spread or facts.columns)), F.lit(salts))).otherwise(zero)
    copies = F.when(is_hot, F.sequence(zero, F.lit(salts - 1).cast("long"))).otherwise(F.array(zero))
    return (facts.withColumn("__salt", salt)
            .join(table.withColumn("__salt", F.explode(copies)), [key, "__salt"], how)
            .drop("__salt"))
