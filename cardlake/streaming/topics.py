"""Keyed record topics: layout, publishing and reading.

Without a broker a topic is a folder ``topics/<topic>/partition=<n>/`` of records ``(key, value, timestamp)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cardlake import schemas
from cardlake.sources.sinks import _folder


@dataclass(frozen=True)
class Topic:
    name: str
    partitions: int
    key: str
    schema: T.StructType
    table: str
    max_records_per_file: int


# Topic names, partition counts, key fields, tables and file sizes.
TOPICS = {t.name: t for t in (
    Topic("transaction-topic", 4, "user", schemas.TRANSACTION, "transaction_topic", 1_000_000),
    Topic("user-topic", 2, "idx", schemas.USER, "user_topic", 1_000),
    Topic("card-topic", 3, "user", schemas.CARD, "card_topic", 1_000),
)}
RETENTION_MS = 604_800_000


def partition_of(key: Column, partitions: int) -> Column:
    """Rows of one key share a partition. A null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def to_topic(df: DataFrame, topic: Topic, timestamp: Column | None = None) -> DataFrame:
    """Records ``(key, value, topic, partition, timestamp)``."""
    key = F.col(topic.key).cast("string")
    return df.select(key.alias("key"), F.struct(*df.columns).alias("value"), F.lit(topic.name).alias("topic"),
                     partition_of(key, topic.partitions).alias("partition"),
                     (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"))


def topic_layout(df: DataFrame, topic: Topic) -> DataFrame:
    """Rows with the partition their key belongs to."""
    return df.withColumn("partition", partition_of(F.col(topic.key).cast("string"), topic.partitions))


def publish(df: DataFrame, topic: Topic, root: str, timestamp: Column | None = None, fmt: str = "parquet",
            **options: str) -> None:
    """Append records to a topic: files, or ``fmt="kafka"`` where that package is deployed (values as JSON)."""
    records = to_topic(df, topic, timestamp)
    if fmt == "kafka":
        records.select("key", F.to_json("value").alias("value"), "topic").write.format("kafka").options(**options).save()
        return
    records.drop("topic").write.format(fmt).mode("append").partitionBy("partition").save(f"{root}/topics/{topic.name}")


def publish_batch(df: DataFrame, topic: Topic, root: str, key: str, timestamp: Column | None = None) -> None:
    """Append the records of a stream's batch ``key`` once, however often the batch is repeated.

    They are written aside and moved into the topic under names made from the key; a file that is there already stays, so that a
    reader which has seen it does not see its rows under another name. A mark, written last, tells that the batch is complete.
    """
    spark, base = df.sparkSession, f"{root}/topics/{topic.name}"
    fs, mark = _folder(spark, f"{root}/published/{topic.name}/{key}")
    if fs.exists(mark):
        return
    aside = f"{root}/staging/{topic.name}/{key}"
    records = to_topic(df, topic, timestamp).drop("topic").repartition("partition")
    records.write.mode("overwrite").partitionBy("partition").parquet(aside)
    for part in fs.globStatus(_folder(spark, f"{aside}/partition=*")[1]) or []:
        target = f"{base}/{part.getPath().getName()}"
        fs.mkdirs(_folder(spark, target)[1])
        for i, file in enumerate(sorted(str(f.getPath()) for f in fs.listStatus(part.getPath()))):
            to = _folder(spark, f"{target}/batch-{key}-{i:05d}.parquet")[1]
            if not fs.exists(to):
                fs.rename(_folder(spark, file)[1], to)
    fs.mkdirs(mark)
    fs.delete(_folder(spark, aside)[1], True)


def record_schema(topic: Topic) -> T.StructType:
    return T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", topic.schema),
        T.StructField("timestamp", T.TimestampType()), T.StructField("partition", T.IntegerType())])


def read_topic_stream(spark: SparkSession, root: str, topic: Topic, max_files: int | None = None,
                      fmt: str = "parquet", **options: str) -> DataFrame:
    """The topic as a stream of ``(key, value, timestamp, partition)``; ``max_files`` bounds a batch.

    ``fmt="kafka"`` reads a broker where that package is deployed (``root`` is unused, values are JSON); bound a batch with
    ``maxOffsetsPerTrigger`` there.
    """
    if fmt == "kafka":
        records = spark.readStream.format("kafka").options(**options).option("subscribe", topic.name).load()
        return records.select(F.col("key").cast("string").alias("key"),
                              F.from_json(F.col("value").cast("string"), topic.schema).alias("value"), "timestamp",
                              "partition")
    reader = spark.readStream.format(fmt).schema(record_schema(topic))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(f"{root}/topics/{topic.name}")


def read_file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", max_files: int = 1,
                     **options: str) -> DataFrame:
    """A folder of files as a stream, ``max_files`` per batch. A CSV file is one task; ``csv_records.stream_csv`` splits large ones."""
    csv = {"header": "true", "escape": '"', "multiLine": "true"} if fmt == "csv" else {}
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).options(**csv, **options).load(path)


def apply_retention(records: DataFrame, now: Column, retention_ms: int = RETENTION_MS) -> DataFrame:
    """Records that are not older than the retention time."""
    return records.where(F.unix_millis("timestamp") >= F.unix_millis(now) - retention_ms)


def compact(spark: SparkSession, topic: Topic, source_root: str, target_root: str, now: Column,
            retention_ms: int = RETENTION_MS) -> None:
    """Write the retained records of a file topic to a new root."""
    records = spark.read.schema(record_schema(topic)).parquet(f"{source_root}/topics/{topic.name}")
    (apply_retention(records, now, retention_ms).write.option("maxRecordsPerFile", topic.max_records_per_file)
     .partitionBy("partition").parquet(f"{target_root}/topics/{topic.name}"))
