"""Requests are scored as they arrive, go back to the transaction topic and raise alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from cardlake import schemas
from cardlake.functions.cleaning import event_time
from cardlake.operators.ordering import dense_index
from cardlake.operators.report import FIRST_SCORED_IDX as FIRST_IDX, FRAUD, LAST_SCORED_IDX as LAST_IDX
from cardlake.schemas import Enforced
from cardlake.session import staged_until_done
from cardlake.sources.sinks import batch_key, drop_batch, read_batch, write_batch
from cardlake.streaming import leases
from cardlake.streaming.topics import TOPICS, publish_batch

# Columns that a scorer may add to its prediction; they are kept beside the transaction, by its id.
SCORES = ("prediction", "confidence", "prob0", "prob1", "src_known", "dst_known", "model_version")


def _parsed(messages: DataFrame, value: str) -> DataFrame:
    """The fields of JSON texts as texts, and ``_fault`` where a text is no JSON.

    All fields are read as text first, so that numbers may come quoted and 64-bit ids never pass through a double. The
    parsed record goes through a generator: a filter on its fields then stays above it, and each text is parsed once.
    """
    fields = [T.StructField(f.name, T.StringType()) for f in schemas.REQUEST.fields]
    parsed = F.from_json(value, T.StructType([*fields, T.StructField("_bad", T.StringType())]),
                         {"columnNameOfCorruptRecord": "_bad"})
    rows = messages.select(F.col(value).isNull().alias("_none"), F.inline(F.array(parsed)))
    fault = F.when(F.col("_bad").isNotNull() | F.col("_none"), F.lit("not JSON"))
    return rows.select(*schemas.REQUEST.fieldNames(), fault.alias("_fault"))


def parse_requests(messages: DataFrame, value: str = "value") -> Enforced:
    """JSON texts as typed requests, and those that are not with the reasons."""
    return schemas.enforce(_parsed(messages, value), schemas.REQUEST, F.col("_fault"))


def assign_idx(rows: DataFrame, order_by: list[str], high: int | None = None) -> DataFrame:
    """New ids above ``high``, the greatest one in use, within the range for scored rows."""
    start = max(FIRST_IDX, (high or 0) + 1)
    numbered = dense_index(rows, order_by, "idx", start)
    spent = F.raise_error(F.lit(f"ids above {LAST_IDX} are not allowed")).cast("int")
    return numbered.withColumn("idx", F.when(F.col("idx") > LAST_IDX, spent).otherwise(F.col("idx").cast("int")))


# Fixed value: the wording of an alert.
ALERT = "*FRAUD DETECTED!*\nUser: %s\nCard: %s\nAmount: %s\nTime: %d-%02d-%02d %s\nMerchant: %s"


def alert_text() -> Column:
    """The alert message of a transaction row; a missing merchant reads ``None``."""
    merchant = F.coalesce(F.col("merchant_name").cast("string"), F.lit("None"))
    return F.format_string(ALERT, "user", "card", "amount", "year", "month", "day", "time", merchant)


def alerts(transactions: DataFrame) -> DataFrame:
    """One message per transaction predicted as fraud."""
    return transactions.where(F.col("is_fraud") == FRAUD).select("idx", "user", alert_text().alias("message"))


def as_transactions(scored: DataFrame, prediction: str = "prediction", keep: Sequence[str] = ()) -> DataFrame:
    """Scored requests as transaction records, marked ``scored`` so that they are not scored or counted as truth again."""
    names = [f.name for f in schemas.TRANSACTION.fields if f.name not in ("idx", "is_fraud")]
    return scored.select(*names, F.col(prediction).alias("is_fraud"), F.lit(True).alias("scored"), *keep)


def _high_before(spark: SparkSession, root: str, key: str, batch_id: int) -> int | None:
    """The greatest id in use when the batch begins, whichever stream gave it. Of each stream only the marks of its last
    batches are kept, one row each, so the history is not read."""
    try:
        left = spark.read.schema("high int, batch_id string").parquet(f"{root}/high_water")
        return left.where(F.col("batch_id") != key).agg(F.max("high")).first()[0]
    except AnalysisException:
        if batch_id == 0:
            return None
        raise


def as_transactions_schema() -> T.StructType:
    """Scored transactions as they are stored."""
    return T.StructType([*schemas.TRANSACTION.fields, T.StructField("scored", T.BooleanType()),
                         T.StructField("batch_id", T.StringType())])


def publish_scored(transactions: DataFrame, root: str, key: str) -> None:
    """Send the scored rows of batch ``key`` back to the transaction topic; a repeated batch adds nothing."""
    publish_batch(transactions.select(*schemas.TRANSACTION.fieldNames()), TOPICS["transaction-topic"], root, key)


def score_stream(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame], root: str, checkpoint: str,
                 value: str = "value", topic_root: str | None = None, ids: str = "ordered", **trigger) -> StreamingQuery:
    """Score a stream of JSON requests.

    ``scorer`` adds a ``prediction`` of ``Yes`` / ``No`` (:class:`cardlake.operators.model.ModelScorer` is one). Each batch writes
    ``transactions``, ``alerts`` and ``rejects`` under ``root``, into partitions of its own, so a repeated batch leaves
    the same rows and ids, and a stream with a new checkpoint adds to what others left. What a scorer adds besides (:data:`SCORES`)
    stands in ``scores``, by ``idx``. With ``topic_root`` the scored rows also go to the transaction topic there.

    ``ids="ordered"`` numbers the rows of a batch in the order of their columns, behind the greatest id in use; streams on one root
    must then run one after the other. ``ids="leased"`` numbers them as they come, in blocks that the stream leases
    (:mod:`cardlake.streaming.leases`); any number of streams may run at once.
    """
    if ids not in ("ordered", "leased"):
        raise ValueError(f"unknown ids {ids!r}")

    def number(rows: DataFrame, key: str, batch_id: int) -> tuple[DataFrame, int | None]:
        if ids == "leased":
            before = batch_key(rows.sparkSession, checkpoint, batch_id - 1) if batch_id else None
            return leases.number_rows(rows, root, key, before), None
        high = _high_before(rows.sparkSession, root, key, batch_id)
        return assign_idx(rows, [f.name for f in schemas.TRANSACTION.fields if f.name != "idx"], high), high

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = _parsed(batch, value).persist()  # read for what is scored and for the rejects
        requests = schemas.enforce(parsed, schemas.REQUEST, F.col("_fault"))
        key, names = batch_key(spark, checkpoint, batch_id), as_transactions_schema().fieldNames()[:-1]
        scored = scorer(requests.valid)
        extra = [c for c in SCORES if c in scored.columns]
        rows = as_transactions(scored, keep=extra)  # evaluated once: numbering writes them first
        try:
            numbered, high = number(rows, key, batch_id)
            if len(extra) > 1:
                write_batch(numbered, f"{root}/scored", key)  # ids are given once, for both tables
                numbered = read_batch(spark, f"{root}/scored", key, numbered.schema)
                write_batch(numbered.select("idx", *extra), f"{root}/scores", key)
            write_batch(numbered.select(*names), f"{root}/transactions", key)
            written = read_batch(spark, f"{root}/transactions", key, as_transactions_schema())
            write_batch(alerts(written), f"{root}/alerts", key)
            if topic_root:
                publish_scored(written, topic_root, key)
            write_batch(requests.rejects, f"{root}/rejects", key)
            if ids == "ordered":
                last = written.agg(F.coalesce(F.max("idx"), F.lit(high).cast("int")).alias("high"))
                write_batch(last, f"{root}/high_water", key)
            for table in ("scored",) if batch_id < 2 else ("scored", "high_water", "lease_state"):
                drop_batch(spark, f"{root}/{table}", key if table == "scored" else batch_key(spark, checkpoint, batch_id - 2))
        finally:
            parsed.unpersist()

    def batch(messages: DataFrame, batch_id: int) -> None:
        with staged_until_done(messages.sparkSession):
            write(messages, batch_id)

    return (messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def with_event_time(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("event_time", event_time(*[F.col(c) for c in ("year", "month", "day", "time")]))


def _first_of_each(df: DataFrame, key: str) -> DataFrame:
    """Drop copies that stand in one Arrow batch, before any row is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = b.column(key).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                yield b.take(pa.array(np.sort(np.unique(codes, return_index=True)[1])))

    return df.mapInArrow(run, df.schema)


def dedupe(transactions: DataFrame, key: str = "idx", delay: str = "7 days") -> DataFrame:
    """Keep one row per ``key`` in a stream; the watermark only bounds how long keys are remembered.

    Copies are thinned out where they are read, so that many copies of one row do not all meet in one task.
    """
    thinned = _first_of_each(with_event_time(transactions), key)
    return thinned.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])
