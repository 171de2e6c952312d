"""Embeddings, the vector collection and exact top-k retrieval."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cardlake.functions.text import tokens
from cardlake.operators import lookups
from cardlake.operators.lookups import table_bytes
from cardlake.operators.ordering import dense_index
from cardlake.session import stage

BATCH = 100
MAX_QUERIES = 1024
TOP_K = 4
METRICS = ("l2", "cosine", "ip")
_BLOCK = 4096  # vectors of a block


def hashed_embedding(text: Column, dim: int) -> Column:
    """Counts of words per hash slot, scaled to length 1; a text without words gives zeros.

    The default provider, with no service behind it. A word's slot comes from the first 32 bits of its MD5. Spark makes the
    words; of each Arrow batch only the distinct ones are hashed.
    """
    @F.arrow_udf("array<double>")
    def count(v: pa.Array) -> pa.Array:
        words = v.flatten().dictionary_encode()
        slots = np.array([int.from_bytes(md5(w.encode()).digest()[:4], "big") % dim for w in words.dictionary.to_pylist()],
                         dtype=np.int64)
        slot = slots[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, dtype=np.int64)
        owner = np.repeat(np.arange(len(v)), np.diff(v.offsets.to_numpy()))
        counts = np.bincount(owner * dim + slot, minlength=len(v) * dim).reshape(len(v), dim).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        values = np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, dim, dtype=np.int32)),
                                        pa.array(values.reshape(-1)))

    return count(F.coalesce(tokens(text), F.array().cast("array<string>")))


def embed_with(df: DataFrame, provider: Callable[[list[str]], list[list[float]]], dim: int, text: str = "text",
               batch: int = BATCH) -> DataFrame:
    """Add ``embedding`` and ``failed`` with an outside provider, called once per ``batch`` texts.

    When a call fails, or a text is null, its rows get zeros and ``failed``.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("failed", T.BooleanType())])

    def call(texts: list) -> tuple[list, list]:
        asked = [i for i, t in enumerate(texts) if t is not None]
        vectors, failed = [[0.0] * dim for _ in texts], [True] * len(texts)
        for start in range(0, len(asked), batch):
            part = asked[start:start + batch]
            try:
                got = provider([texts[i] for i in part])
            except Exception:  # the provider is outside code; its failure must not end the job
                continue
            for i, vector in zip(part, got):
                vectors[i], failed[i] = [float(x) for x in vector], False
        return vectors, failed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors, failed = call(b.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(vectors, pa.list_(pa.float64())), pa.array(failed, pa.bool_())],
                names=[*b.schema.names, "embedding", "failed"])

    return df.mapInArrow(run, schema)


def first_of_ids(incoming: DataFrame, order_by: str) -> DataFrame:
    """One row per id, the first by ``order_by``."""
    rest = [c for c in incoming.columns if c != "id"]
    return incoming.groupBy("id").agg(F.min_by(F.struct(*rest), F.col(order_by)).alias("row")).select("id", "row.*")


def insert_new(collection: DataFrame, incoming: DataFrame, order_by: str | None = None) -> DataFrame:
    """The rows of ``incoming`` to append: ids the collection lacks. Of equal ids the first by ``order_by`` stays."""
    if order_by is not None:
        incoming = first_of_ids(incoming, order_by)
    return incoming.join(collection.select("id"), "id", "left_anti")


def known_ids(spark: SparkSession, path: str, ids: Sequence[str]) -> set:
    """Those of ``ids`` that the collection at ``path`` holds; none if there is no collection yet."""
    try:
        collection = spark.read.schema("id string").parquet(path)
    except AnalysisException:
        return set()
    return {r[0] for r in collection.where(F.col("id").isin(list(ids))).distinct().collect()}


def add_to_collection(path: str, incoming: DataFrame, order_by: str | None = None) -> None:
    """Get or create the collection at ``path`` and append the rows whose ids it lacks; rows it has stay as they are."""
    incoming.limit(0).write.mode("append").parquet(path)
    collection = incoming.sparkSession.read.schema(incoming.schema).parquet(path)
    fresh = insert_new(collection, incoming, order_by)
    fresh.select(*[c for c in incoming.columns if c != order_by]).write.mode("append").parquet(path)


def insert_batch(incoming: DataFrame, fields: Sequence[str], order_by: Sequence[str], start: int = 0,
                 auto_id: str = "id") -> DataFrame:
    """The declared fields of ``incoming`` under new ids that continue from ``start``."""
    kept = dense_index(incoming.select(*dict.fromkeys([*fields, *order_by])), order_by, auto_id, start)
    return kept.select(auto_id, *fields)


def _packed(size: int, kind: pa.DataType):
    """Rows of (id, v) as blocks: ids, the vectors of all as one matrix, and their length. Rows without a vector have no place."""
    def pack(ids, parts, width):
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(kind)), pa.array([np.concatenate(parts).tobytes()], pa.binary()),
                                           pa.array([width], pa.int32())], ["ids", "matrix", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, width = [], [], None
        for b in batches:
            b = b.filter(b.column("v").is_valid())  # here: a filter before would compute an embedding function twice
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                values = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                width = len(values) // part.num_rows if width is None else width
                if len(values) != part.num_rows * width:
                    raise ValueError(f"vectors of length {width} expected")
                ids += part.column("id").to_pylist()
                parts.append(values)
                while len(ids) >= size:
                    whole = np.concatenate(parts)
                    yield pack(ids[:size], [whole[:size * width]], width)
                    ids, parts = ids[size:], [whole[size * width:]]
        if ids:
            yield pack(ids, parts, width)
    return run


def _blocks(df: DataFrame, id_column: str, vector: str, size: int, name: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type
    kind = df.schema[id_column].dataType
    slim = df.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return stage(slim.mapInArrow(_packed(size, to_arrow_type(kind)), f"ids array<{kind.simpleString()}>, matrix binary, width int"), name)


def top_k(queries: DataFrame, collection: DataFrame, k: int = TOP_K, metric: str = "l2", query_id: str = "query_id",
          vector: str = "embedding", decimals: int = 9, max_queries: int = MAX_QUERIES) -> DataFrame:
    """``(query_id, rank, id, distance)`` of the ``k`` nearest rows of ``collection(id, embedding)`` for each query.

    The search is exact: every vector is compared, as matrix products of blocks, and each task passes on only its
    ``k`` best per query. Distances are rounded to ``decimals`` and ties go to the smaller id, so neither block sizes nor
    partitions show in the result. ``ip`` is the negative inner product. A zero vector has cosine distance 1.

    Both sides are tables of blocks, ``max_queries`` and 4,096 vectors each. Query blocks are broadcast in parts of a measured
    size, one pass over the collection for each part; no query passes through the driver by itself.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    spark, id_type, query_type = queries.sparkSession, collection.schema["id"].dataType, queries.schema[query_id].dataType
    schema = T.StructType([T.StructField(query_id, query_type), T.StructField("id", id_type), T.StructField("distance", T.DoubleType())])
    asked = _blocks(queries, query_id, vector, max_queries, "query-blocks").select(
        F.monotonically_increasing_id().alias("block"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q"), F.col("width").alias("q_width"))
    asked = stage(asked, "numbered-query-blocks")
    passes, held = [[]], 0
    for number, size in asked.select("block", F.octet_length("q") + 64 * F.size("q_ids")).collect():  # two numbers per block
        if passes[-1] and held + size > lookups.BROADCAST_BYTES:
            passes.append([])
            held = 0
        passes[-1].append(number)
        held += size
    vectors = _blocks(collection, "id", vector, _BLOCK, "vector-blocks").withColumn("one", F.lit(0))
    out = spark.createDataFrame([], schema)
    for part in passes:
        told = F.broadcast(asked.where(F.col("block").isin(part)).withColumn("one", F.lit(0)))
        out = out.unionByName(vectors.join(told, "one").mapInArrow(_nearest(k, metric, decimals, query_id, schema), schema))
    best = F.row_number().over(Window.partitionBy(query_id).orderBy("distance", "id"))
    return out.withColumn("rank", best).where(F.col("rank") <= k).select(query_id, "rank", "id", "distance")


def block_distances(q: np.ndarray, v: np.ndarray, metric: str, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the places of vectors that can be among its k nearest, and their distances.

    For ``l2`` a matrix product gives each squared distance up to a bound on its rounding; the few vectors within that bound of
    the k-th are then measured by differences, which keep all digits for near copies too.
    """
    dot = q @ v.T
    if metric == "ip":
        values = -dot
    elif metric == "cosine":
        scale = np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((v * v).sum(axis=1))[None, :]
        values = 1.0 - np.divide(dot, scale, out=np.zeros_like(dot), where=scale > 0)
    else:
        square, slack = (v * v).sum(axis=1), 8 * (v.shape[1] + 4) * np.finfo(np.float64).eps
    for i, row in enumerate(q):
        if metric != "l2":
            cut = np.partition(values[i], k - 1)[k - 1] if len(v) > k else np.inf
            near = np.flatnonzero(values[i] <= cut + 2e-9)  # rounding may make a tie of what lies just beyond
            yield near, values[i][near]
            continue
        own = row @ row
        rough, off = own + square - 2 * dot[i], slack * (own + square)
        least = np.partition(rough + off, k - 1)[k - 1] if len(v) > k else np.inf
        near = np.flatnonzero(np.sqrt(np.maximum(rough - off, 0.0)) <= np.sqrt(np.maximum(least, 0.0)) + 2e-9)
        yield near, np.sqrt(((v[near] - row) ** 2).sum(axis=1))


def _nearest(k: int, metric: str, decimals: int, query_id: str, schema: T.StructType):
    """The k best per query over all blocks of a task."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[list, list]] = {}
        for b in batches:
            for i in range(b.num_rows):
                number, width = b.column("block")[i].as_py(), b.column("width")[i].as_py()
                if width != b.column("q_width")[i].as_py():
                    raise ValueError(f"vectors of length {b.column('q_width')[i].as_py()} expected")
                ids, v, q = b.column("ids")[i].values, *(np.frombuffer(b.column(c)[i].as_buffer(), np.float64).reshape(-1, width)
                                                         for c in ("matrix", "q"))
                if number not in best:
                    asked = b.column("q_ids")[i].as_py()
                    best[number] = asked, [[] for _ in asked]
                for mine, (near, d) in zip(best[number][1], block_distances(q, v, metric, k)):
                    found = zip((np.round(d, decimals) + 0.0).tolist(), ids.take(pa.array(near)).to_pylist())
                    mine[:] = sorted([*mine, *found])[:k]
        for asked, groups in best.values():
            rows = [(asked[i], found, dist) for i, group in enumerate(groups) for dist, found in group]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    return run


def retrieve(questions: DataFrame, collection: DataFrame, provider: Callable[[Column], Column], k: int = TOP_K,
             metric: str = "l2", question_id: str = "query_id", text: str = "text") -> DataFrame:
    """The ``k`` documents nearest to each question as its context: ``(query_id, rank, id, distance, document)``."""
    asked = questions.select(question_id, provider(F.col(text)).alias("embedding"))
    found = stage(top_k(asked, collection, k, metric, question_id), "nearest")
    if table_bytes(found) <= lookups.BROADCAST_BYTES:  # the documents need not move
        found = F.broadcast(found)
    return collection.select("id", "document").join(found, "id").select(question_id, "rank", "id", "distance", "document")
