"""CSV records cut out of lines, so that a file with line breaks inside quotes is still read by many tasks.

A line break ends a record unless a quoted field is open there. Whether one is open at the start of a split depends on all that
stands before it, so every split first tells what it makes of either state: where a field is open at its start, and where none is.
A running composition over the splits of a file, one small row each, gives the true state, and the splits then cut their lines by
themselves. Only the ends of records that reach over a split go through a grouping. Where no record has a line break, and that is
known after the first pass, Spark's own reader takes over.

A quote opens a field only at the field's start; two quotes inside a quoted field are one. Lines end with a line feed, or a carriage
return and a line feed; either stays as it is inside quotes. An unclosed quote takes in the rest of its file.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cardlake.operators.lookups import BROADCAST_BYTES, table_bytes
from cardlake.session import stage, staged_until_done

PLACE = ("__file", "__block", "__row")  # where a record starts: file, start of the split, number in the split
_RECORDS = "__file string, __block long, __row long, record string, goes_on boolean, is_open boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open behind ``line``, if one is open before it or not."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            at = line.find(",", at + 1)  # what follows the closing quote belongs to the field
            if at < 0:
                return False
            at, inside = at + 1, False
        if line.startswith('"', at):
            at, inside = at + 1, True
        else:
            at = line.find(',"', at)
            if at < 0:
                return False
            at, inside = at + 2, True


def read_lines(reader, path: str | list[str]) -> DataFrame:
    """Lines with their file and the start of their split; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    return reader.format("text").option("lineSep", "\n").load(path).select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), "value")


def _segments(batch: pa.RecordBatch):
    """(file, block, first row, row behind the last) of the splits in a batch."""
    blocks = batch.column("__block").to_numpy(zero_copy_only=False)
    files = pc.dictionary_encode(batch.column("__file"))
    codes = files.indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
        yield files.dictionary[int(codes[a])].as_py(), int(blocks[a]), a, b


def _fold(batches):
    """Per split, from its lines with quotes: the state behind it for both states before it, and if a line ends in a field."""
    def row():
        return pa.RecordBatch.from_pylist([{"__file": at[0], "__block": at[1], "after_outside": outside, "after_inside": inside,
                                            "spans": spans}])
    at, outside, inside, spans = None, False, True, False
    for batch in batches:
        if not batch.num_rows:
            continue
        for file, block, a, b in _segments(batch):
            if (file, block) != at:
                if at:
                    yield row()
                at, outside, inside, spans = (file, block), False, True, False
            for line in batch.column("value").slice(a, b - a).to_pylist():
                same = outside == inside
                outside = ends_inside(line, outside)
                inside = outside if same else ends_inside(line, inside)
                spans |= outside
    if at:
        yield row()


def split_states(lines: DataFrame) -> DataFrame:
    """__file, __block, starts_inside, ends_inside, spans of every split that has a quote.

    A split turns both states into one, keeps them or swaps them: the state before a split is what the last split that makes
    them one leaves, swapped as often as the splits between them do.
    """
    told = lines.where(F.contains("value", F.lit('"'))).mapInArrow(
        _fold, "__file string, __block long, after_outside boolean, after_inside boolean, spans boolean")
    order = Window.partitionBy("__file").orderBy("__block")
    one, swaps = F.col("after_outside") == F.col("after_inside"), F.col("after_outside") & ~F.col("after_inside")
    counted = told.withColumns({"swaps": F.sum(F.when(swaps, 1).otherwise(0)).over(order)})
    known = F.when(one, F.struct(F.col("after_outside").alias("state"), "swaps"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    last, so_far = F.last(known, True).over(before), F.coalesce(F.max("swaps").over(before), F.lit(0))
    odd = (so_far - F.coalesce(last["swaps"], F.lit(0))) % 2 == 1
    starts = F.coalesce(last["state"], F.lit(False)) != odd
    return counted.select("__file", "__block", starts.alias("starts_inside"),
                          F.when(starts, F.col("after_inside")).otherwise(F.col("after_outside")).alias("ends_inside"), "spans")


def _cut(header: bool, parts: bool):
    """Records of each split: those it holds whole, or with ``parts`` the end of one that began before it and the start of its last."""
    def run(batches):
        at, number, held, inside, went_on, first = None, 0, [], False, False, False

        def out(records, goes_on, is_open):
            n = len(records)
            cols = [pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array(range(number, number + n), pa.int64()),
                    records, pa.array([goes_on] * n), pa.array([is_open] * n)]
            return pa.RecordBatch.from_arrays(cols, [*PLACE, "record", "goes_on", "is_open"])

        def whole(lines):
            """Records that start and end here; empty ones and the header do not count."""
            nonlocal first, number
            lines = pc.replace_substring_regex(lines, r"\r\z", "")
            lines = lines.filter(pc.match_substring_regex(lines, r"[^\x00-\x20]"))
            if first and len(lines):
                lines, first = lines.slice(1), False
            if len(lines):
                if not parts:
                    yield out(lines, False, False)
                number += len(lines)

        def close(is_open):
            nonlocal went_on, held
            record = pa.array(["\n".join(held)])
            if went_on or is_open:
                if parts:
                    yield out(record, went_on, is_open)
            else:
                yield from whole(record)
            held, went_on = [], False

        for batch in batches:
            if not batch.num_rows:
                continue
            starts = batch.column("starts_inside").to_numpy(zero_copy_only=False) if "starts_inside" in batch.schema.names else None
            values = batch.column("value")
            quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
            for file, block, a, b in _segments(batch):
                if (file, block) != at:
                    if at and inside:
                        yield from close(True)
                    at, number, held = (file, block), 0, []
                    inside = went_on = bool(starts is not None and starts[a])
                    first = header and block == 0
                done = a
                for i in quoted[np.searchsorted(quoted, a):np.searchsorted(quoted, b)].tolist():
                    line = values[i].as_py()
                    if not inside:
                        if ends_inside(line, False):
                            yield from whole(values.slice(done, i - done))
                            held, inside, done = [line], True, i + 1
                    else:
                        held += values.slice(done, i + 1 - done).to_pylist()
                        done = i + 1
                        if not ends_inside(line, True):
                            inside = False
                            yield from close(False)
                if inside:
                    held += values.slice(done, b - done).to_pylist()
                else:
                    yield from whole(values.slice(done, b - done))
        if at and inside:
            yield from close(True)
    return run


def _joined_parts(parts: DataFrame) -> DataFrame:
    """Records put together from their parts: one that is not a continuation starts each. One or two rows per split."""
    order = Window.partitionBy("__file").orderBy("__block", F.desc("goes_on"))
    owner = F.last(F.when(~F.col("goes_on"), F.struct("__block", "__row")), True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    pieces = F.sort_array(F.collect_list(F.struct("__block", "record")))
    return (parts.withColumn("owner", owner).groupBy("__file", "owner").agg(pieces.alias("pieces"))
            .select("__file", F.col("owner.__block").alias("__block"), F.col("owner.__row").alias("__row"),
                    F.regexp_replace(F.array_join("pieces.record", "\n"), r"\r\z", "").alias("record")))


def _inside(lines: DataFrame, states: DataFrame) -> DataFrame:
    """The splits that a record reaches into or out of; one without a quote has the state of those before it."""
    if states.where("starts_inside or ends_inside").isEmpty():
        return states.where("false")
    every = lines.select("__file", "__block").distinct().join(states, ["__file", "__block"], "left")
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce("starts_inside", F.last("ends_inside", True).over(before), F.lit(False))
    filled = every.withColumn("starts_inside", start).withColumn("ends_inside", F.coalesce("ends_inside", "starts_inside"))
    return stage(filled.where("starts_inside or ends_inside"), "open-splits")


def cut_records(lines: DataFrame, states: DataFrame, header: bool = True) -> DataFrame:
    """__file, __block, __row, record from lines and the staged states of their splits."""
    known = _inside(lines, states).select("__file", "__block", "starts_inside")
    if known.isEmpty():
        return lines.mapInArrow(_cut(header, False), _RECORDS).select(*PLACE, "record")
    if table_bytes(known) <= BROADCAST_BYTES:
        told = lines.join(F.broadcast(known), ["__file", "__block"], "left")
        some = lines.join(F.broadcast(known), ["__file", "__block"])
    else:  # very many splits: the lines follow them through a shuffle and are put back in order
        numbered = lines.withColumn("__line", F.monotonically_increasing_id())
        told, some = (numbered.join(known, ["__file", "__block"], how).sortWithinPartitions("__file", "__block", "__line").drop("__line")
                      for how in ("left", "inner"))
    told, some = (df.withColumn("starts_inside", F.coalesce("starts_inside", F.lit(False))) for df in (told, some))
    parts = stage(some.mapInArrow(_cut(header, True), _RECORDS), "record-parts")
    return told.mapInArrow(_cut(header, False), _RECORDS).select(*PLACE, "record").unionByName(_joined_parts(parts))


def parse_records(records: DataFrame, schema: T.StructType, corrupt: str | None = None) -> DataFrame:
    """The fields of each record beside its place."""
    options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true"} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(*PLACE, F.from_csv("record", declared, options).alias("__fields")).select(*PLACE, "__fields.*")


def stream_csv(spark: SparkSession, path: str, schema: T.StructType, write: Callable[[DataFrame, int], None], checkpoint: str,
               max_files: int = 1) -> StreamingQuery:
    """A folder of CSV files as a stream: ``write`` gets the rows of each batch and its number.

    Large files are read by many tasks, line breaks inside quotes or not; a batch is read again if it is repeated.
    """
    def batch(lines: DataFrame, number: int) -> None:
        with staged_until_done(lines.sparkSession):
            states = stage(split_states(lines), "split-states")
            write(parse_records(cut_records(lines, states), schema).drop(*PLACE), number)

    return (read_lines(spark.readStream.option("maxFilesPerTrigger", max_files), path).writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
