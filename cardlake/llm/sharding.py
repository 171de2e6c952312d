"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by (hash of the text, row number), so that equal texts stand together and every row has a place of its own. Cuts of
this order are found without moving a row: each round counts, over all partitions, the exact bytes and rows below a few thousand
candidate boundaries; a cut is done when a boundary is near enough to its target, else the next round looks between the two
boundaries around the target. A boundary is put between two texts as long as one is near enough; a group of equal texts that reaches
over a target by more than that is cut between its rows. Cuts of two kinds are looked for at once: the fifteen between shards (by
bytes), and those between ranges (by rows), which keep a shard or a hot text from being one task's work. Then the rows are exchanged
once, by range, and numbered; a shard's numbers go on from range to range by the counts that are known already.

Defined cases: a null text has no bytes and is like an empty one (size 1, crc32 0); repeated rows and ids, and null ids, are rows like
others; with fewer rows than shards some shards stay empty; an empty table gives no rows; kept columns named like an added one give
way to it. No cut is further from its target than ``tolerance`` of a shard, or half of the row on the target where that is more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardlake.session import stage

SHARDS = 16
TOLERANCE = 1 / 500  # of a shard's bytes
RANGE_ROWS, MAX_RANGES = 1 << 18, 1 << 14
PROBES = 1 << 16  # candidate boundaries of a round, for all cuts together
_LOW = -(1 << 63)
_ADDED = ("size", "text_crc32", "shard", "slot")


@dataclass
class _Cut:
    """A boundary looked for: the place below which ``target`` bytes or rows lie, between two known places."""

    by_rows: bool
    target: int
    slack: float
    low: int
    high: int
    found: int | None = None


@dataclass(frozen=True)
class Splitters:
    """Places (ascending, hash and row number) where ranges begin, the rows below each, and the shard of each range."""

    hashes: np.ndarray
    numbers: np.ndarray
    rows_below: list[int]
    shard: list[int]


def _slots(hashes: np.ndarray, numbers: np.ndarray, h: np.ndarray, r: np.ndarray) -> np.ndarray:
    """How many of the sorted places are at or below each row's place."""
    first, last = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
    out, tied = first.copy(), first < last
    for value in np.unique(h[tied]):
        own = np.flatnonzero(h == value)
        a, b = first[own[0]], last[own[0]]
        out[own] = a + np.searchsorted(numbers[a:b], r[own], "right")
    return out


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _histogram(hashes: np.ndarray, numbers: np.ndarray):
    """Bytes and rows between neighbouring places, summed up over a partition."""
    def run(batches):
        size, rows = np.zeros(len(hashes) + 1, np.int64), np.zeros(len(hashes) + 1, np.int64)
        for batch in batches:
            at = _slots(hashes, numbers, _ints(batch, "h"), _ints(batch, "r"))
            np.add.at(size, at, _ints(batch, "size"))
            rows += np.bincount(at, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(size[used]), pa.array(rows[used])], ["slot", "bytes", "rows"])
    return run


def _below(keys: DataFrame, places: list[int], bits: int) -> list[tuple[int, int]]:
    """(bytes, rows) below each place; at most PROBES numbers reach the driver."""
    hashes = np.array([(p >> bits) + _LOW for p in places], np.int64)
    numbers = np.array([p & ((1 << bits) - 1) for p in places], np.int64)
    counted = (keys.select("h", "r", "size").mapInArrow(_histogram(hashes, numbers), "slot long, bytes long, rows long")
               .groupBy("slot").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect())
    by_slot = {r["slot"]: (r["bytes"], r["rows"]) for r in counted}
    out, size, rows = [], 0, 0
    for i in range(len(places)):
        more = by_slot.get(i, (0, 0))
        size, rows = size + more[0], rows + more[1]
        out.append((size, rows))
    return out


def _candidates(cut: _Cut, n: int, bits: int) -> list[int]:
    """Places spread evenly inside a cut's bounds, before the first row of a text where the bounds are wide."""
    width = cut.high - cut.low
    inner = {cut.low + width * i // (n + 1) for i in range(1, n + 1)}
    if width > 1 << bits:
        inner |= {-(-cut.low >> bits) << bits, cut.high >> bits << bits}
    if width >= (n + 1) << bits:
        inner = {p >> bits << bits for p in inner}
    return [p for p in inner if cut.low < p < cut.high]


def find_splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, range_rows: int = RANGE_ROWS) -> Splitters:
    """``keys`` holds h (long), r (long, from 0, unique) and size. Each round is one pass over these three columns."""
    total, rows, most = keys.agg(F.sum("size"), F.count("*"), F.max("r")).first()
    if not rows:
        return Splitters(np.zeros(0, np.int64), np.zeros(0, np.int64), [0], [0])
    bits, ranges = max(1, most.bit_length()), min(MAX_RANGES, max(2 * shards, -(-rows // range_rows)))
    end = 1 << (64 + bits)
    cuts = [_Cut(False, total * i // shards, total / shards * tolerance, 0, end) for i in range(1, shards)]
    cuts += [_Cut(True, rows * i // ranges, rows / ranges / 4, 0, end) for i in range(1, ranges)]
    known = {0: (0, 0), end: (total, rows)}
    while some := [c for c in cuts if c.found is None]:
        places = sorted({p for c in some for p in _candidates(c, max(1, PROBES // len(some)), bits)} - known.keys())
        known.update(zip(places, _below(keys, places, bits)))
        order = sorted(known)
        for c in some:
            weights = [known[p][c.by_rows] for p in order]
            at = int(np.searchsorted(np.array(weights, np.int64), c.target, "right"))
            c.low, c.high = order[at - 1], order[min(at, len(order) - 1)]
            near = [p for p in (c.low, c.high) if abs(known[p][c.by_rows] - c.target) <= c.slack]
            if near or known[c.high][1] - known[c.low][1] <= 1 or c.high - c.low <= 1:
                between_texts = [p for p in near if not p & ((1 << bits) - 1)]
                c.found = min(between_texts or near or (c.low, c.high), key=lambda p: abs(known[p][c.by_rows] - c.target))
    by_bytes = sorted(c.found for c in cuts if not c.by_rows)
    places = [p for p in sorted({c.found for c in cuts}) if 0 < p < end]
    shard = [int(np.searchsorted(np.array(by_bytes, object), p, "right")) for p in [0, *places]]
    return Splitters(np.array([(p >> bits) + _LOW for p in places], np.int64),
                     np.array([p & ((1 << bits) - 1) for p in places], np.int64), [known[p][1] for p in [0, *places]], shard)


def _with_range(splitters: Splitters, names: Sequence[str]):
    def run(batches):
        for batch in batches:
            at = _slots(splitters.hashes, splitters.numbers, _ints(batch, "h"), _ints(batch, "r"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], [*names, "range"])
    return run


def shard_documents(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), shards: int = SHARDS,
                    tolerance: float = TOLERANCE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The kept columns with size (UTF-8 bytes and 1), text_crc32, shard and slot (place in the shard, from 0).

    Keep the text too to write whole shards; only then is it exchanged.
    """
    body, keep = F.coalesce(F.col(text), F.lit("")), [c for c in keep if c not in _ADDED]
    kept = F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)], F.lit(0).alias("_")).alias("kept")
    rows = docs.select(kept, F.octet_length(body).cast("long").alias("octets"), F.crc32(body.cast("binary")).alias("text_crc32"),
                       F.xxhash64(body).alias("h"), F.monotonically_increasing_id().alias("r"))
    rows = stage(rows.select("kept", (F.col("octets") + 1).alias("size"), "text_crc32", "h", "r"), "shard-keys")
    cuts = find_splitters(rows, shards, tolerance, range_rows)
    starts = [cuts.rows_below[cuts.shard.index(s)] for s in cuts.shard]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = rows.mapInArrow(_with_range(cuts, rows.columns), f"{kinds}, range int")
    before = F.get(F.array(*[F.lit(a - b).cast("long") for a, b in zip(cuts.rows_below, starts)]), F.col("range"))
    slot = F.row_number().over(Window.partitionBy("range").orderBy("h", "r")) - 1 + before
    return placed.withColumn("slot", slot).select(
        *[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], "size", "text_crc32",
        F.get(F.array(*[F.lit(s) for s in cuts.shard]), F.col("range")).alias("shard"), "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its files in the order of their slots; no task holds more than a range."""
    sharded.write.partitionBy("shard").parquet(path)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
