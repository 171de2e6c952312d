"""Category codes, scaling and the edge attribute vector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cardlake.functions import cleaning as fn
from cardlake.operators import lookups
from cardlake.operators.lookups import heavy_keys, lookup, row_bytes
from cardlake.operators.ordering import ROWS_PER_RANGE, dense_index
from cardlake.session import stage

SCALED = ("year", "month", "day", "amount")
CODED = ("merchant_city", "use_chip", "errors")
# Fixed value: the order of the attributes in an edge's vector.
EDGE_ATTRIBUTES = ("amount", "merchant_city", "use_chip", "year", "month", "day", "errors")


@dataclass(frozen=True)
class LabelCodes:
    """The code of each value of one column, ``table(code, value, n)``, and the table's size in bytes."""

    table: DataFrame
    size: int


@dataclass(frozen=True)
class MinMax:
    """Least and greatest value of each column."""

    low: Mapping[str, float]
    high: Mapping[str, float]


def fit_label_codes(df: DataFrame, columns: Sequence[str]) -> dict[str, LabelCodes]:
    """Number the distinct values of each column from 0, in the order of the column's own type."""
    # One pass for all columns: a row per column with its value in a field of the column's own type.
    slots = [f"v{i}" for i in range(len(columns))]
    entries = [F.struct(F.lit(i).alias("which"), *[
        (F.col(c) if j == i else F.lit(None).cast(df.schema[c].dataType)).alias(slots[j]) for j, c in enumerate(columns)])
        for i in range(len(columns))]
    known = [F.when(F.col(c).isNotNull(), entry) for c, entry in zip(columns, entries)]
    seen = df.select(F.explode(F.array_compact(F.array(*known))).alias("e")).select("e.*")
    counted = stage(seen.groupBy("which", *slots).agg(F.count("*").alias("n")), "values")
    sizes = {r[0]: (r[1], r[2]) for r in
             counted.groupBy("which").agg(F.count("*"), F.sum(row_bytes(counted))).collect()}
    fitted = {}
    for i, c in enumerate(columns):
        rows, size = sizes.get(i, (0, 0))
        values = counted.where(F.col("which") == i).select(F.col(slots[i]).alias("value"), "n")
        table = dense_index(values, ["value"], "code", rows=rows)
        fitted[c] = LabelCodes(table if rows <= ROWS_PER_RANGE else stage(table, f"codes-{c}"), size)
    return fitted


def _falsy(c: Column, kind: str) -> Column:
    return c.isNull() | (c == "") if kind == "string" else c.isNull() | (c == 0)


def apply_label_codes(df: DataFrame, codes: Mapping[str, LabelCodes], unseen: str = "error", falsy_zero: bool = False,
                      suffix: str = "", spread: Sequence[str] | None = None) -> DataFrame:
    """Replace each column of ``codes`` by its code (or add ``<column><suffix>``).

    ``falsy_zero`` gives code 0 to null, empty text and 0, as scoring does; otherwise null stays null. A value without a
    code raises (``unseen="error"``), becomes 0 (``"zero"``), or becomes null and is named in the added array column
    ``unseen`` (``"reject"``).
    """
    if unseen not in ("error", "zero", "reject"):
        raise ValueError(f"unknown unseen policy {unseen!r}")
    out, missing = df, []
    large = [c for c in codes if codes[c].size > lookups.BROADCAST_BYTES]
    hot = heavy_keys(df, {c: F.col(c) for c in large}) if large else {}  # one pass over the rows for all columns
    for c, fitted in codes.items():
        key = f"__key_{c}"
        table = fitted.table.select(F.col("value").alias(key), F.col("code").alias(f"__code_{c}"))
        out = lookup(out.withColumn(key, F.col(c)), table, key, size=fitted.size, hot=hot.get(c, ()), spread=spread or df.columns)
        code, falsy = F.col(f"__code_{c}"), _falsy(F.col(key), df.schema[c].dataType.simpleString())
        no_code = code.isNull() & F.col(key).isNotNull() & (~falsy if falsy_zero else F.lit(True))
        value = F.when(falsy, F.lit(0).cast("long")) if falsy_zero else F.when(F.col(key).isNull(), F.lit(None))
        if unseen == "error":
            value = value.when(no_code, F.raise_error(F.concat(F.lit(f"no code for {c}: "), F.col(key).cast("string"))))
        elif unseen == "zero":
            value = value.when(no_code, F.lit(0).cast("long"))
        else:
            missing.append(F.when(no_code, F.lit(c)))
        out = out.withColumn(f"{c}{suffix}", value.otherwise(code))
        if missing:
            out = out.withColumn(f"__missing_{c}", missing[-1])
        out = out.drop(key, f"__code_{c}")
    if missing:
        flags = [f"__missing_{c}" for c in codes]
        out = out.withColumn("unseen", F.filter(F.array(*flags), lambda m: m.isNotNull())).drop(*flags)
    return out


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> MinMax:
    """One pass, one row to the driver."""
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).first()
    return MinMax({c: row[f"low_{c}"] for c in columns}, {c: row[f"high_{c}"] for c in columns})


def apply_minmax(df: DataFrame, fitted: MinMax, suffix: str = "") -> DataFrame:
    """``(x - low) / (high - low)``; a column that was constant gives ``x - low``. Nothing is clipped."""
    def scaled(c: str) -> Column:
        low, high = fitted.low[c], fitted.high[c]
        if low is None:
            return F.lit(None).cast("double")
        width = float(high) - float(low) or 1.0
        return (F.col(c).cast("double") - F.lit(float(low))) / F.lit(width)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in fitted.low})


def prepare(transactions: DataFrame) -> DataFrame:
    """Transactions as model rows: numeric amount, 0/1 label, filled errors, card key."""
    return transactions.select(
        "idx", fn.card_key(F.col("user"), F.col("card")).alias("card_id"), "merchant_name", "merchant_city", "use_chip",
        F.col("year").cast("double").alias("year"), F.col("month").cast("double").alias("month"),
        F.col("day").cast("double").alias("day"), fn.money(F.col("amount")).alias("amount"),
        fn.or_default(F.col("errors")).alias("errors"), "mcc", fn.yes_flag(F.col("is_fraud")).alias("label"))


def edge_attr(columns: Sequence[str] = EDGE_ATTRIBUTES) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])
