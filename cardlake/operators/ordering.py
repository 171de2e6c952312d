"""Row positions and running totals over a whole table, without putting it in one task.

A global order is cut into ranges of bounded rows and bytes by sampled key values. The cuts are literals in the plan, so a task that is run again
after a lost executor puts each row in the same range. Rows are numbered or summed inside each range, and the totals of
the ranges before it (one small number each) are added.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cardlake.operators.lookups import hot_keys, lookup, row_bytes, table_bytes
from cardlake.session import stage

ROWS_PER_RANGE = 1 << 18
BYTES_PER_RANGE = 256 << 20
MAX_RANGES = 1 << 14
_SAMPLES_PER_RANGE = 32
_RANGE = "__range"
_BYTES = "__bytes"


@dataclass(frozen=True)
class Ranges:
    """The range number of a row, as a column, and how many ranges there are."""

    number: Column
    count: int


def order_ranges(df: DataFrame, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE, rows: int | None = None,
                 size: str | None = None, bytes_per_range: int = BYTES_PER_RANGE) -> Ranges:
    """Cut the order by ``keys`` (ascending, nulls first) into ranges of about ``rows_per_range`` rows.

    ``size`` names a column with the bytes of each row; then a range holds about ``bytes_per_range`` at most, too. Rows are sampled
    in proportion to their part of all rows and all bytes, so the cuts are quantiles of both together, and a few wide rows are not
    missed. ``rows`` saves the counting pass where the number of rows is known and there is no ``size``.
    """
    total = 0
    if size is not None:
        rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    elif rows is None:
        rows = df.count()
    count = 1
    while (count * rows_per_range < rows or count * bytes_per_range < total) and count < MAX_RANGES:
        count *= 2
    if count == 1:
        return Ranges(F.lit(0), 1)
    key = F.struct(*keys)
    # About MAX_RANGES * _SAMPLES_PER_RANGE keys reach the driver at most, whatever the size of the table.
    wanted = _SAMPLES_PER_RANGE * count
    part = F.lit(1 / rows) if not total else (F.lit(1 / rows) + F.col(size) / F.lit(float(total))) / 2
    sample = (df.select(*keys, part.alias("__part")).where(F.rand(7) < F.col("__part") * wanted).orderBy(*keys)
              .select(F.to_json(key, {"ignoreNullFields": "false"}), F.greatest("__part", F.lit(1 / wanted))).collect())
    if not sample:
        return Ranges(F.lit(0), 1)
    # A row taken for certain counts as its part, the others as what they stand for.
    whole, so_far, chosen = sum(r[1] for r in sample), 0.0, []
    for at, weight in sample:
        while len(chosen) < count - 1 and so_far >= whole * (len(chosen) + 1) / count:
            chosen.append(at)
        so_far += weight
    chosen += [sample[-1][0]] * (count - 1 - len(chosen))
    cuts = "[" + ",".join(chosen) + "]"
    kind = T.ArrayType(T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys]))
    bounds = F.from_json(F.lit(cuts), kind)
    # Binary search: each step decides one bit of the range number.
    steps = [1 << b for b in reversed(range(count.bit_length() - 1))]
    number = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at))
    return Ranges(number, count)


def _literal(values: Sequence, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def _before(per_range: dict[int, float], count: int) -> list:
    """The sum over all ranges before each range."""
    out, total = [], 0
    for i in range(count):
        out.append(total)
        total += per_range.get(i, 0)
    return out


def dense_index(df: DataFrame, order_by: Sequence[str], name: str = "idx", start: int = 0,
                rows_per_range: int = ROWS_PER_RANGE, rows: int | None = None,
                bytes_per_range: int = BYTES_PER_RANGE) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … in the order of ``order_by``; the index is the first column.

    ``order_by`` must order the rows totally. ``df`` is evaluated once, into a written table; the cuts and the range sizes come
    from scans of its key columns, and one shuffle follows. ``rows`` tells that there are so many rows: few enough for one range
    are numbered right away.
    """
    if rows is not None and rows <= rows_per_range:
        ranged, ranges = df.withColumn(_RANGE, F.lit(0)), Ranges(F.lit(0), 1)
    else:
        staged = stage(df.withColumn(_BYTES, row_bytes(df)), "to-number")
        ranges = order_ranges(staged, order_by, rows_per_range, size=_BYTES, bytes_per_range=bytes_per_range)
        ranged = staged.drop(_BYTES).withColumn(_RANGE, ranges.number)
    position = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order_by)).cast("long") - 1 + start
    if ranges.count > 1:
        sizes = {r[0]: r[1] for r in ranged.groupBy(_RANGE).count().collect()}
        position = position + F.get(_literal(_before(sizes, ranges.count), "bigint"), F.col(_RANGE))
    return ranged.withColumn(name, position).select(name, *[c for c in df.columns if c != name])


def index_within(df: DataFrame, by: Sequence[str], order_by: Sequence[str], name: str = "pos",
                 rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number the rows of each group of ``by`` from 0 in the order of ``order_by``.

    The rows are numbered as a whole, group after group, and the first number of its group is taken off each. So a group
    that holds a great part of the table is still numbered by many tasks.
    """
    whole = stage(dense_index(df, [*by, *order_by], name, 0, rows_per_range), "numbered")
    # As one text, groups with nulls are equal too, and frequent ones can be named in the join.
    grouped = whole.withColumn("__group", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))
    starts = stage(grouped.groupBy("__group").agg(F.min(name).alias("__start"), F.count("*").alias("__n")), "starts")
    found = lookup(grouped, starts.select("__group", "__start"), "__group", "inner", table_bytes(starts),
                   partial(hot_keys, starts, "__group", "__n"), [name])
    return found.select((F.col(name) - F.col("__start")).alias(name), *df.columns)


def running_totals(df: DataFrame, order_by: Sequence[str], values: Sequence[str],
                   rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, dict[str, int]]:
    """Add ``cum_<v>``, the inclusive running total of each whole-number column, and ``next_<v>``, its value in the next
    row (null in the last). Returns the table and the grand totals. ``order_by`` must be unique."""
    ranges = order_ranges(df, order_by, rows_per_range)
    ranged = df.withColumn(_RANGE, ranges.number)
    per_range = ranged.groupBy(_RANGE).agg(
        *[F.sum(v).alias(f"sum_{i}") for i, v in enumerate(values)],
        F.min_by(F.struct(*values), F.struct(*order_by)).alias("first")).collect()
    by_range = {r[_RANGE]: r for r in per_range}
    window = Window.partitionBy(_RANGE).orderBy(*order_by)
    added, totals = {}, {}
    for i, v in enumerate(values):
        sums = {n: r[f"sum_{i}"] for n, r in by_range.items()}
        totals[v] = sum(sums.values())
        running = F.sum(v).over(window.rowsBetween(Window.unboundedPreceding, 0))
        following = F.lead(v).over(window)
        if ranges.count > 1:
            heads, head = [None] * ranges.count, None
            for n in reversed(range(ranges.count)):
                heads[n] = head
                head = by_range[n]["first"][v] if n in by_range else head
            running = running + F.get(_literal(_before(sums, ranges.count), "bigint"), F.col(_RANGE))
            following = F.coalesce(following, F.get(_literal(heads, "bigint"), F.col(_RANGE)))
        added[f"cum_{v}"], added[f"next_{v}"] = running, following
    return ranged.withColumns(added).drop(_RANGE), totals
