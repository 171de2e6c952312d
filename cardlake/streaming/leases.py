"""Ranges of ids that streams lease, so that several can write to one root at the same time.

A lease is a block of ids, claimed by creating a file that only one writer can create. Rows get ids without an order between them:
their place is the rows of the tasks before theirs and the number in their task, counted on the written rows. What a stream has not
used of its last block it uses in its next batch; a repeated batch finds the blocks it claimed before.

The claim needs a file system that creates a file exclusively, as HDFS and local ones do.
"""

from __future__ import annotations

from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.operators.report import FIRST_SCORED_IDX as FIRST_IDX, LAST_SCORED_IDX as LAST_IDX
from cardlake.session import stage
from cardlake.sources.sinks import drop_batch, read_batch, write_batch

BLOCK = 1 << 20
_STATE = "next long, end long"
_TASK_BITS = 33  # monotonically_increasing_id: the task's number stands above these


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def claim(spark: SparkSession, path: str) -> bool:
    """Create ``path``; false if somebody else did."""
    fs, file = _file_system(spark, path)
    fs.mkdirs(file.getParent())
    if fs.getScheme() != "file":
        return fs.createNewFile(file)
    jvm = spark.sparkContext._jvm
    try:
        jvm.java.nio.file.Files.createFile(jvm.java.io.File(urlparse(path).path).toPath(), spark.sparkContext._gateway.new_array(
            jvm.java.nio.file.attribute.FileAttribute, 0))
        return True
    except Py4JJavaError as taken:
        if "FileAlreadyExists" not in str(taken.java_exception):
            raise
        return False


def _names(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _file_system(spark, folder)
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()) if fs.exists(path) else []


def lease_blocks(spark: SparkSession, root: str, key: str, n: int, block: int = BLOCK) -> list[int]:
    """First ids of ``n`` blocks that belong to batch ``key`` alone; those it claimed in an earlier attempt come first."""
    own = _names(spark, f"{root}/leased/{key}")[:n]
    while len(own) < n:
        number = max(_names(spark, f"{root}/leases"), default=-1) + 1
        while not claim(spark, f"{root}/leases/{number}"):
            number += 1
        if FIRST_IDX + (number + 1) * block - 1 > LAST_IDX:
            raise ValueError(f"ids above {LAST_IDX} are not allowed")
        claim(spark, f"{root}/leased/{key}/{number}")
        own.append(number)
    return [FIRST_IDX + number * block for number in own]


def number_rows(rows: DataFrame, root: str, key: str, before: str | None, block: int = BLOCK) -> DataFrame:
    """``rows`` with ``idx`` from what batch ``before`` of the same stream left over and from new blocks."""
    spark = rows.sparkSession
    placed = stage(rows.withColumn("__at", F.monotonically_increasing_id()), "unnumbered")
    task = F.shiftright("__at", _TASK_BITS)
    counts = {r[0]: r[1] for r in placed.groupBy(task).count().collect()}  # one number per task
    total, starts = 0, [0] * (max(counts, default=-1) + 2)
    for t in range(len(starts)):
        starts[t] = total
        total += counts.get(t, 0)
    left = read_batch(spark, f"{root}/lease_state", before, "next long, end long").first() if before else None
    first, spare = (left["next"], min(left["end"] - left["next"], total)) if left else (0, 0)
    blocks = lease_blocks(spark, root, key, -(-(total - spare) // block), block)
    place = F.get(F.lit(starts).cast("array<long>"), task.cast("int")) + F.col("__at").bitwiseAND((1 << _TASK_BITS) - 1)
    beyond = F.col("__place") - spare
    idx = F.when(F.col("__place") < spare, F.lit(first) + F.col("__place")).otherwise(
        F.get(F.lit(blocks or [0]).cast("array<long>"), F.expr(f"int((__place - {spare}) div {block})")) + F.pmod(beyond, F.lit(block)))
    used = total - spare
    state = ((first + spare, left["end"]) if left else (0, 0)) if used <= 0 else (blocks[-1] + (used - 1) % block + 1, blocks[-1] + block)
    write_batch(spark.createDataFrame([state], _STATE), f"{root}/lease_state", key)
    return placed.withColumn("__place", place).withColumn("idx", idx.cast("int")).drop("__at", "__place")


def forget(spark: SparkSession, root: str, key: str) -> None:
    """Drop the state of a batch that no later one asks for."""
    drop_batch(spark, f"{root}/lease_state", key)
