"""Exact top-k inner products with vector-approximation files.

Vectors are packed into blocks that hold two files: cells (each component in one of 64 steps of its range in the block, one byte)
and exact integers. Query blocks are broadcast in parts of a measured size and meet every vector block of their length, one pass over
the blocks for each part. Of a block the cells are scanned first: they bound each product from both sides, with room for rounding. Vectors whose upper bound is below the k-th largest lower bound are out; the exact vectors of the
others are read in order of their upper bound until the k-th result is at least the next bound. The best k of each block meet in a
window that keeps k per query before the shuffle.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part; vectors of different lengths are
not compared; a row with the query's id is not its candidate; candidates that share an id are candidates each, and equal queries are
one; ties go to the smaller id; empty tables give no rows. Components that are no 64-bit integers when scaled, and scores among a
query's best that are none, raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardlake.session import stage

K, SCALE, EVERY = 5, 256, 50
BLOCK, QUERIES = 4096, 1024  # vectors and queries per block
STEPS = 64
PART_BYTES = 32 << 20  # query blocks that are broadcast at a time; one block more may end a part
_BLOCK_TYPE = "dim int, ids binary, low binary, step binary, cells binary, exact binary"


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)) & F.col(vec_id).isNotNull())
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(vector, lambda x: _floor(x.cast("double") * scale)).alias("v")))


def _floor(x: Column) -> Column:
    far = F.raise_error(F.concat(F.lit("component beyond 64 bits: "), x.cast("string"))).cast("long")
    return F.when(F.abs(x) < 2.0 ** 63, F.floor(x)).otherwise(far)


def _blocks(size: int):
    def pack(dim, ids, rows):
        exact = np.asarray(rows, np.int64).reshape(len(ids), dim)
        low = exact.min(0)
        step = (exact.max(0) - low) // STEPS + 1
        cells = ((exact - low) // step).astype(np.uint8)
        cols = [dim, np.asarray(ids, np.int64).tobytes(), low.tobytes(), step.tobytes(), cells.tobytes(), exact.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(cols)],
                                          ["dim", "ids", "low", "step", "cells", "exact"])

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                ids, rows = held.setdefault(len(v), ([], []))
                ids.append(i)
                rows.append(v)
                if len(ids) >= size:
                    yield pack(len(v), ids, rows)
                    held.pop(len(v))
        for dim, (ids, rows) in held.items():
            yield pack(dim, ids, rows)
    return run


def block_top(q: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray,
              exact: np.ndarray, k: int):
    """(query row, id, score) of the k best vectors of one block for each query."""
    bottom = low + cells.astype(np.int64) * step
    top = bottom + step - 1
    plus, minus = np.maximum(q, 0).astype(np.float64), np.minimum(q, 0).astype(np.float64)
    bottom, top = bottom.T.astype(np.float64), top.T.astype(np.float64)
    upper, lower = plus @ top + minus @ bottom, plus @ bottom + minus @ top
    most = np.abs(q).astype(np.float64) @ np.maximum(np.abs(bottom), np.abs(top))
    wide = most.max(initial=0.0) >= 2.0 ** 62  # then products are added up as integers of any length
    slack = most * 2.0 ** -40
    upper, lower = upper + slack, lower - slack
    own = q_ids[:, None] == ids[None, :]
    upper[own] = lower[own] = -np.inf
    out = []
    for i in range(len(q)):
        some = min(k, int((~own[i]).sum()))
        if not some:
            continue
        bound = np.partition(lower[i], len(ids) - some)[len(ids) - some]
        order = np.flatnonzero((upper[i] >= bound) & ~own[i])
        order = order[np.argsort(-upper[i][order], kind="stable")]
        best_score, best_id, at, batch = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 4 * k
        while at < len(order):
            if len(best_score) == some and upper[i][order[at]] < best_score[-1]:
                break  # nothing further can reach the k-th result
            near = order[at:at + batch]
            best_score = np.concatenate([best_score, (exact[near].astype(object) @ q[i].astype(object)) if wide else exact[near] @ q[i]])
            best_id = np.concatenate([best_id, ids[near]])
            first = np.lexsort((best_id, -best_score))[:some] if not wide else np.array(
                sorted(range(len(best_id)), key=lambda j: (-best_score[j], best_id[j]))[:some])
            best_score, best_id, at, batch = best_score[first], best_id[first], at + batch, 2 * batch
        if wide and any(abs(int(x)) >= 1 << 63 for x in best_score):
            raise ValueError("a score is beyond 64 bits")
        out.append((np.full(len(best_id), i), best_id, best_score.astype(np.int64)))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def _search(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                dim, ints = row["dim"], lambda name: np.frombuffer(row[name], np.int64)
                ids, q_ids = ints("ids"), ints("q_ids")
                at, found, score = block_top(ints("q").reshape(-1, dim), q_ids, ids, ints("low"), ints("step"),
                                             np.frombuffer(row["cells"], np.uint8).reshape(-1, dim), ints("exact").reshape(-1, dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])
    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest integer inner products for each query."""
    blocks = stage(integer_vectors(vectors, vec_id, vector, scale).mapInArrow(_blocks(BLOCK), _BLOCK_TYPE), "vector-blocks")
    asked = (integer_vectors(queries, vec_id, vector, scale).distinct().mapInArrow(_blocks(QUERIES), _BLOCK_TYPE)
             .select("dim", F.col("ids").alias("q_ids"), F.col("exact").alias("q")))
    asked = stage(asked.withColumn("part", F.monotonically_increasing_id()), "query-blocks")
    parts, held = [[]], 0
    for number, size in asked.select("part", F.octet_length("q")).collect():  # two numbers per block
        if parts[-1] and held + size > PART_BYTES:
            parts.append([])
            held = 0
        parts[-1].append(number)
        held += size
    found = None
    for part in parts:
        told = F.broadcast(asked.filter(F.col("part").isin(part)).drop("part"))
        one = blocks.join(told, "dim").mapInArrow(_search(k), "query_id long, vec_id long, score long")
        found = one if found is None else found.unionByName(one)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows.filter(F.col("vec_id") % EVERY == 0), rows)
