"""Topics, ingest, scoring on arrival and alerts, driven to their end on file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardlake import schemas
from cardlake.functions import cleaning as fn
from cardlake.operators import features, model, sampling
from cardlake.plans.registry import TXN, query
from cardlake.session import scratch_path
from cardlake.sources import adapters, csv_records, readers, sinks
from cardlake.streaming import ingest, scoring, topics

_TXN = topics.TOPICS["transaction-topic"]
_FIELDS = ('idx, "user", card, "year", "month", "day", "time", amount, use_chip, merchant_name, merchant_city, '
           'merchant_state, zip, mcc, errors, is_fraud')


def _published(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = scratch_path(spark, name)
    topics.publish(adapters.transactions(spark, sf_dir), _TXN, f"{root}/source")
    return root


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = adapters.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query(f"WITH {TXN} SELECT {_FIELDS} FROM txn")
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _published(spark, sf_dir, "bronze")
    records = topics.read_topic_stream(spark, f"{root}/source", _TXN)
    ingest.sink_bronze(records, _TXN, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return readers.read_topic(spark, f"{root}/bronze", _TXN.name, schemas.TRANSACTION)


@query(f"""WITH {TXN} SELECT {_FIELDS} FROM txn WHERE is_fraud = 'Yes'""")
def topic_scan_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _published(spark, sf_dir, "bronze")
    records = topics.read_topic_stream(spark, f"{root}/source", _TXN)
    ingest.sink_bronze(records, _TXN, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return readers.read_topic(spark, f"{root}/bronze", _TXN.name, schemas.TRANSACTION,
                              predicate=F.col("is_fraud") == "Yes")


@query(f"WITH {TXN} SELECT {_FIELDS} FROM txn")
def stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per batch; started twice on one checkpoint, which adds nothing."""
    root = _published(spark, sf_dir, "table")
    for _ in range(2):
        records = topics.read_topic_stream(spark, f"{root}/source", _TXN, max_files=1)
        ingest.sink_table(records, _TXN, f"{root}/tables", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/tables/{_TXN.table}").drop("batch_id")


def _requests(rows: DataFrame) -> DataFrame:
    """Transactions as request texts; some numbers are quoted, some texts are torn and some lack a field."""
    names = [c for c in rows.columns if c not in ("idx", "is_fraud")]
    quoted = rows.withColumns({"year": F.col("year").cast("string"), "mcc": F.when(F.col("mcc") > 4, F.col("mcc"))})
    text = F.to_json(F.struct(*names))
    return quoted.select(F.when(F.pmod("idx", F.lit(40)) == 39, F.substring(text, 1, 30)).otherwise(text).alias("value"))


def _scorer(requests: DataFrame) -> DataFrame:
    return requests.withColumn("prediction", F.when(fn.money(F.col("amount")) > 60.0, "Yes").otherwise("No"))


_ARRIVED = f"""{TXN}, fine AS (SELECT * FROM txn WHERE idx % 40 <> 39 AND mcc > 4),
judged AS (SELECT * REPLACE (CASE WHEN CAST(replace(amount, '$', '') AS DOUBLE) > 60 THEN 'Yes' ELSE 'No' END AS is_fraud)
  FROM fine),
numbered AS (SELECT * REPLACE (CAST(26000000 + row_number() OVER (ORDER BY "user", card, "year", "month", "day", "time",
  amount, use_chip NULLS FIRST, merchant_name, merchant_city, merchant_state NULLS FIRST, zip NULLS FIRST, mcc,
  errors NULLS FIRST, is_fraud) AS INT) AS idx) FROM judged)"""


def _scored(spark: SparkSession, sf_dir: str, checkpoints: int = 1) -> str:
    root = scratch_path(spark, "scores")
    for i in range(checkpoints):
        messages = _requests(adapters.transactions_of(_events_stream(spark, sf_dir)))
        scoring.score_stream(messages, _scorer, root, f"{root}/checkpoint{i}").awaitTermination()
    return root


@query(f"WITH {_ARRIVED} SELECT {_FIELDS}, 1 AS scored FROM numbered")
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = spark.read.parquet(f"{_scored(spark, sf_dir)}/transactions")
    return scored.drop("batch_id").withColumn("scored", F.col("scored").cast("int"))


@query(f"""WITH {_ARRIVED} SELECT idx, "user", amount, is_fraud FROM numbered
UNION ALL SELECT CAST(idx + (SELECT count(*) FROM numbered) AS INT), "user", amount, is_fraud FROM numbered""")
def stream_second_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with a new checkpoint on the same root adds its rows under ids of its own."""
    return spark.read.parquet(f"{_scored(spark, sf_dir, 2)}/transactions").select("idx", "user", "amount", "is_fraud")


@query(f"""WITH {_ARRIVED} SELECT "user", amount, is_fraud, 2 AS n, 2 AS n_ids, 1 AS in_range, count(*) OVER () * 2 AS all_ids FROM numbered
""")
def stream_concurrent_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams score the same requests on one root at the same time; every row gets an id of its own."""
    root, running = scratch_path(spark, "scores"), []
    for i in range(2):
        messages = _requests(adapters.transactions_of(_events_stream(spark, sf_dir)))
        running.append(scoring.score_stream(messages, _scorer, root, f"{root}/checkpoint{i}", ids="leased"))
    for q in running:
        q.awaitTermination()
    rows = spark.read.parquet(f"{root}/transactions").drop("batch_id", "scored")
    names = [c for c in rows.columns if c != "idx"]
    # Requests that agree in every field are told apart by their number among each other: the first and second belong together.
    place = Window.partitionBy(*names).orderBy("idx")
    grouped = rows.withColumns({"nth": F.row_number().over(place), "next": F.lead("idx").over(place)}).where(F.col("nth") % 2 == 1).select(
        "*", F.when(F.col("next").isNull(), 1).otherwise(2).alias("n"), F.when(F.col("next") != F.col("idx"), 2).otherwise(1).alias("n_ids"),
        F.col("idx").alias("least"), F.coalesce("next", "idx").alias("greatest"))
    ids = rows.agg(F.count_distinct("idx").alias("all_ids"))
    return grouped.crossJoin(F.broadcast(ids)).select(
        "user", "amount", "is_fraud", F.col("n").cast("int").alias("n"), F.col("n_ids").cast("int").alias("n_ids"),
        ((F.col("least") > 26_000_000) & (F.col("greatest") <= 10 ** 9)).cast("int").alias("in_range"), "all_ids")


@query(f"""WITH {TXN}, fine AS (SELECT * FROM txn WHERE idx % 40 <> 39 AND mcc > 4)
SELECT "user", card, "time", amount, mcc, 0 AS model_version, 1 AS in_range, 1 AS follows, 1 AS as_batch, count(*) AS n FROM fine GROUP BY ALL""")
def stream_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored on arrival by a stored model. Its probabilities stand beside the transactions, and equal those of a batch."""
    root = scratch_path(spark, "model-stream")
    rows = adapters.transactions(spark, sf_dir)
    fitted, _ = model.train_edge_classifier(sampling.stratified_split(features.prepare(rows), "label"), "logistic", iterations=5)
    model.save_version(fitted, f"{root}/model")
    messages = _requests(adapters.transactions_of(_events_stream(spark, sf_dir)))
    scoring.score_stream(messages, model.ModelScorer(spark, f"{root}/model"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    scores, moved = (spark.read.parquet(f"{root}/out/{t}").drop("batch_id") for t in ("scores", "transactions"))
    both = scores.join(moved, "idx")
    requests = [f.name for f in schemas.REQUEST.fields if f.name != "is_fraud"]
    again = model.score(moved.select("idx", *requests), fitted).select("idx", F.col("prob1").alias("batch_prob1"))
    told = both.join(again, "idx")
    flags = {"in_range": F.col("prob1").between(0.0, 1.0) & (F.abs(F.col("prob0") + F.col("prob1") - 1.0) < 1e-9),
             "follows": (F.col("prediction") == F.col("is_fraud")) & ((F.col("prediction") == "Yes") == (F.col("prob1") > F.col("prob0"))),
             "as_batch": F.abs(F.col("prob1") - F.col("batch_prob1")) < 1e-9}
    told = told.select("user", "card", "time", "amount", "mcc", "model_version", *[c.cast("int").alias(n) for n, c in flags.items()])
    return told.groupBy(*told.columns).agg(F.count("*").alias("n"))


@query(f"""WITH {_ARRIVED} SELECT {_FIELDS} FROM numbered""")
def stream_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows sent back to the transaction topic by a stream whose only batch runs twice."""
    root = scratch_path(spark, "scores")
    for _ in range(2):
        messages = _requests(adapters.transactions_of(_events_stream(spark, sf_dir)))
        scoring.score_stream(messages, _scorer, root, f"{root}/checkpoint", topic_root=f"{root}/topic").awaitTermination()
        sinks.forget_commit(spark, f"{root}/checkpoint", 0)
    records = spark.read.schema(topics.record_schema(_TXN)).parquet(f"{root}/topic/topics/{_TXN.name}")
    return records.select("value.*")


_MESSAGE = """'*FRAUD DETECTED!*' || chr(10) || 'User: ' || "user" || chr(10) || 'Card: ' || card || chr(10) || 'Amount: '
  || amount || chr(10) || 'Time: ' || "year" || '-' || lpad(CAST("month" AS VARCHAR), 2, '0') || '-'
  || lpad(CAST("day" AS VARCHAR), 2, '0') || ' ' || "time" || chr(10) || 'Merchant: ' || """


@query(f"""WITH {_ARRIVED} SELECT idx, "user", {_MESSAGE} merchant_name AS message FROM numbered WHERE is_fraud = 'Yes'""")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_scored(spark, sf_dir)}/alerts").drop("batch_id")


@query(f"""WITH {TXN} SELECT CASE WHEN idx % 40 = 39 THEN 'not JSON' ELSE 'mcc: null' END AS reasons, count(*) AS n FROM txn
WHERE idx % 40 = 39 OR mcc <= 4 GROUP BY 1""")
def request_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = scoring.parse_requests(_requests(adapters.transactions(spark, sf_dir))).rejects
    return rejects.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count("*").alias("n"))


@query(f"""WITH {TXN} SELECT idx, "user", {_MESSAGE}
  CASE WHEN use_chip = 'Online Transaction' THEN 'None' ELSE CAST(merchant_name AS VARCHAR) END AS message FROM txn
WHERE is_fraud = 'Yes'""")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir)
    missing = F.when(F.col("use_chip") != "Online Transaction", F.col("merchant_name"))
    return scoring.alerts(rows.withColumn("merchant_name", missing))


@query("""SELECT CAST(26000000 + row_number() OVER (ORDER BY event_id) AS INT) AS idx, CAST(event_id AS INT) AS event
FROM events""")
def scored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir).select(F.col("idx").alias("event"))
    return scoring.assign_idx(rows, ["event"])


@query(f"""WITH {TXN} SELECT idx, "user", amount, is_fraud FROM txn""")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction arrives twice."""
    root = _published(spark, sf_dir, "dedupe")
    topics.publish(adapters.transactions(spark, sf_dir), _TXN, f"{root}/source")
    records = topics.read_topic_stream(spark, f"{root}/source", _TXN).select("value.*")
    once = scoring.dedupe(records, delay="40 days").select("idx", "user", "amount", "is_fraud")
    (once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
     .start(f"{root}/once").awaitTermination())
    return spark.read.parquet(f"{root}/once")


@query(f"""WITH {TXN} SELECT "user" AS key, count(*) AS n, 1 AS n_partitions FROM txn GROUP BY 1""")
def topic_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per key, and in how many partitions of the topic they are."""
    records = topics.to_topic(adapters.transactions(spark, sf_dir), _TXN)
    return records.groupBy("key").agg(F.count("*").alias("n"),
                                      F.count_distinct("partition").cast("int").alias("n_partitions"))


@query("""SELECT event_id FROM events WHERE epoch_ms(ts) >= (SELECT max(epoch_ms(ts)) FROM events) - 604800000""")
def topic_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events").select("event_id", F.to_utc_timestamp("ts", "UTC").alias("timestamp"))
    now = events.agg(F.max("timestamp")).first()[0]
    return topics.apply_retention(events, F.lit(now)).select("event_id")


@query(f"WITH {TXN} SELECT {_FIELDS} FROM txn")
def chunked_csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files read as a stream, one per batch."""
    root = scratch_path(spark, "chunks")
    rows = adapters.transactions(spark, sf_dir).repartition(4, "idx")
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/csv")
    stream = topics.read_file_stream(spark, f"{root}/csv", schemas.TRANSACTION)
    (stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
     .start(f"{root}/rows").awaitTermination())
    return spark.read.parquet(f"{root}/rows")


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN chr(10) || 'a "b",' || chr(13) || chr(10) || text WHEN 1 THEN '"' || lang || chr(10)
  WHEN 2 THEN NULL ELSE text END AS text, CASE WHEN doc_id % 3 > 0 THEN source END AS source FROM documents""")
def stream_csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks as a stream of CSV files, two per batch, each file read by its splits."""
    root = scratch_path(spark, "chunks")
    rows = adapters.texts_for_csv(spark, sf_dir)
    sinks.write_csv(rows.repartition(4, "doc_id"), f"{root}/csv")
    csv_records.stream_csv(spark, f"{root}/csv", rows.schema, lambda df, number: sinks.write_batch(df, f"{root}/rows", number),
                           f"{root}/checkpoint", max_files=2).awaitTermination()
    return spark.read.parquet(f"{root}/rows").drop("batch_id")
