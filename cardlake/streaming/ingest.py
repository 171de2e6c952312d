"""Each topic flows unchanged to bronze files and to its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from cardlake.sources.sinks import batch_key, write_batch
from cardlake.streaming.topics import TOPICS, Topic, read_topic_stream


def sink_bronze(records: DataFrame, topic: Topic, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Record values to ``topics/<topic>/partition=<n>/``, files of at most the topic's number of records."""
    return (records.select("value.*", "partition").writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("maxRecordsPerFile", topic.max_records_per_file)
            .partitionBy("partition").trigger(**(trigger or {"availableNow": True}))
            .start(f"{root}/topics/{topic.name}"))


def sink_table(records: DataFrame, topic: Topic, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Record values to the topic's table, one ``batch_id`` partition per batch and checkpoint, so a repeated batch adds
    nothing."""
    path = f"{root}/{topic.table}"

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.select("value.*"), path, batch_key(batch.sparkSession, checkpoint, batch_id))

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_ingest(spark: SparkSession, source: str, bronze: str, tables: str, checkpoints: str,
               topics: dict[str, Topic] | None = None, max_files: int | None = None, **trigger) -> list[StreamingQuery]:
    """Start both sinks of every topic, each with its own checkpoint. ``max_files`` holds a batch to what the sinks
    can take."""
    started = []
    for topic in (topics or TOPICS).values():
        for kind, sink, root in (("bronze", sink_bronze, bronze), ("table", sink_table, tables)):
            records = read_topic_stream(spark, source, topic, max_files)
            started.append(sink(records, topic, root, f"{checkpoints}/{topic.name}-{kind}", **trigger))
    return started
