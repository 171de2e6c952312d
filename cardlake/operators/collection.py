"""A vector collection in buckets of ids, each with Bloom filters, so that an insertion reads only what it might collide with.

``<path>/rows/bucket=<b>`` holds the rows whose id hashes to ``b``; ``<path>/filters/bucket=<b>`` one filter per insertion that added
to the bucket. The filters are tried first: an id that none of them knows is new for certain, and only the buckets of the others are
read. Filters are written before the rows they stand for. An insertion that breaks off between the two leaves filters that know too
much, which costs a look at the rows and nothing else, so it may simply be run again. One insertion runs at a time.

Choose the number of buckets so that the ids of a bucket stay within some millions; it is fixed when the collection is created.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.operators.vectors import first_of_ids
from cardlake.session import stage

BUCKETS = 256
BITS_PER_ID, PROBES = 16, 4
_SEED_BUCKET = 17


def _hash(c: str) -> Column:
    return F.xxhash64(F.col(c).cast("string"))


def _bucket(c: str, buckets: int) -> Column:
    return F.pmod(F.hash(F.lit(_SEED_BUCKET), F.col(c).cast("string")), F.lit(buckets)).cast("int")


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit numbers per hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * high[:, None]) % np.uint64(bits)).astype(np.int64)


def _hashes(table: pa.Table) -> np.ndarray:
    return table.column("h").to_numpy().astype(np.int64).view(np.uint64)


def build_filter(hashes: np.ndarray) -> bytes:
    bits = 64 * -(-BITS_PER_ID * len(hashes) // 64)
    marked = np.zeros(bits, np.uint8)
    marked[_places(hashes, bits).reshape(-1)] = 1
    return np.packbits(marked, bitorder="little").tobytes()


def may_hold(known: bytes, hashes: np.ndarray) -> np.ndarray:
    """False: none of the ids that the filter was built from has this hash."""
    bits, marked = 8 * len(known), np.frombuffer(known, np.uint8)
    at = _places(hashes, bits)
    return (marked[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool).all(axis=1)


def _suspects(asked: pa.Table, filters: pa.Table) -> pa.Table:
    hashes = _hashes(asked)
    found = np.zeros(len(hashes), bool)
    for known in filters.column("bits").to_pylist():
        found |= may_hold(known, hashes)
    return asked.select(["bucket", "h"]).filter(pa.array(found))


def _filters_of(table: pa.Table) -> pa.Table:
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "bits": pa.array([build_filter(_hashes(table))], pa.binary())})


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the collection at ``path``; none if there is no collection."""
    row = _read(spark, f"{path}/layout", "buckets int").first()
    return row and row[0]


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("bucket")


def insert_bucketed(path: str, incoming: DataFrame, order_by: str | None = None, buckets: int = BUCKETS) -> list[int]:
    """Create the collection or add the rows whose ``id`` it lacks; returns the buckets whose rows were read to tell.

    Of equal incoming ids the first by ``order_by`` counts; a row without an id is left out. ``buckets`` matters for a new collection only.
    """
    spark, columns = incoming.sparkSession, [c for c in incoming.columns if c != order_by]
    known = buckets_of(spark, path)
    if known is None:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/layout")
    number = known or buckets
    named = incoming.where(F.col("id").isNotNull())
    once = (first_of_ids(named, order_by) if order_by else named.dropDuplicates(["id"])).select(*columns)
    rows = stage(once.withColumns({"bucket": _bucket("id", number), "h": _hash("id")}), "incoming")
    filters = _read(spark, f"{path}/filters", "bits binary, bucket int")
    thin = rows.select("bucket", "h")
    suspects = stage(thin.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_suspects, "bucket int, h long"), "suspects")
    read = sorted(r[0] for r in suspects.select("bucket").distinct().collect())
    fresh = rows
    if read:
        kind = incoming.schema["id"].dataType.simpleString()
        there = _read(spark, f"{path}/rows", f"id {kind}, bucket int").where(F.col("bucket").isin(read))
        held = stage(there.join(suspects.select("bucket", "h").withColumnRenamed("h", "sh"),
                                (there["bucket"] == suspects["bucket"]) & (_hash("id") == F.col("sh")), "left_semi").select("id").distinct(), "held")
        fresh = stage(rows.join(held, "id", "left_anti"), "fresh")
    fresh.select("bucket", "h").groupBy("bucket").applyInArrow(_filters_of, "bucket int, bits binary") \
        .write.mode("append").partitionBy("bucket").parquet(f"{path}/filters")
    fresh.select(*columns, "bucket").repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/rows")
    return read
